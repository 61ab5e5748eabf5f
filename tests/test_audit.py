import pytest
from pyspark.sql import functions as F

from waferlens.sources import audit, tables


def test_counts_of_one_pass_and_a_failure(spark, tmp_path):
    told = []
    log = audit.AuditLog(spark, str(tmp_path / "log"), told.append)
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            passes.add(len(b))
            yield b

    rows = spark.createDataFrame([(i, None if i % 10 == 0 else i) for i in range(100)], "id long, v long").mapInPandas(seen, "id long, v long")
    sink = tables.Sink(str(tmp_path / "out"))
    got = log.run("load", rows, sink.write, refused=F.col("v") < 30, metrics={"most": F.max("id")})
    # Of 0 to 29 the three nulls are not refused.
    assert got == {"rows_in": 100, "rows_out": 73, "rows_refused": 27, "most": 99}
    assert spark.read.parquet(sink.path).count() == 73
    assert passes.value == 100
    with pytest.raises(Exception, match="already exists"):
        log.run("again", rows, lambda r: sink.write(r, mode="error"))
    assert log.run("nothing", rows.filter("id < 0"), sink.write)["rows_out"] == 0
    runs = {r.JOB: r for r in log.read().collect()}
    assert (runs["load"].STATUS, runs["load"].ROWS_IN, runs["load"].ROWS_OUT, runs["load"].ROWS_REFUSED) == ("OK", 100, 73, 27)
    assert runs["again"].STATUS == "FAILED" and runs["again"].ROWS_IN is None and runs["again"].MESSAGE
    assert (runs["nothing"].ROWS_IN, runs["nothing"].ROWS_OUT) == (0, 0)
    assert all(r.STARTED <= r.ENDED for r in runs.values())
    assert [(t["taskId"], t["status"]) for t in told] == [("load", "OK"), ("again", "FAILED"), ("nothing", "OK")]
