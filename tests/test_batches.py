"""Labelled batches: replies, attempts, filters, encodings and an HTTP loader."""

import json
import os
import subprocess
import sys
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from waferlens.sources import batches


@pytest.fixture(scope="module")
def rows(spark):
    batches.register(spark)
    kinds = "id long, name string, price double, due date, at timestamp, sure boolean, paid decimal(9,2)"
    df = spark.range(2500).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("n é"), F.col("id") % 50)).alias("name"), (F.col("id") / 3).alias("price"), F.expr("date_add(date'2024-01-01', cast(id % 90 as int))").alias("due"), F.timestamp_seconds(F.col("id") * 1000 + 0.25).alias("at"), (F.col("id") % 2 == 0).alias("sure"), (F.col("id") / 100).cast("decimal(9,2)").alias("paid"))
    assert [f"{f.name} {f.dataType.simpleString()}" for f in df.schema] == [x.replace("long", "bigint") for x in kinds.split(", ")]
    return df.repartition(5)


def _same(a, b):
    assert a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("encoding", ["json", "separated"])
def test_round_trip_and_bounds(spark, rows, tmp_path, encoding):
    path = str(tmp_path / "t")
    rows.write.format(batches.NAME).options(batch_rows=200, encoding=encoding).mode("append").save(path)
    _same(spark.read.format(batches.NAME).load(path), rows)
    (job,) = batches.FolderLoader(path).published()
    assert max(b["rows"] for b in job["batches"]) == 200 and len(job["batches"]) == len(list(Path(path, "prepared").iterdir()))
    rows.limit(3).write.format(batches.NAME).options(encoding=encoding, fields="name, id").mode("overwrite").save(path)
    replaced = spark.read.format(batches.NAME).load(path)
    assert replaced.columns == ["name", "id"] and replaced.count() == 3


def test_filters_reach_the_batches(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows.repartitionByRange(5, "id").write.format(batches.NAME).options(batch_rows=100).mode("append").save(path)
    read = spark.read.format(batches.NAME).load(path)
    for where in ("id = 77", "id > 2400", "id <= 3 and name is not null", "name in ('n é1', 'n é7') and id < 900", "name = 'n é3' and price > 5", "id <=> 4", "name is null", "not id > 5", "sure and id >= 2490", "name > 'n é4' and due = date'2024-01-05'"):
        _same(read.filter(where), rows.filter(where))
    assert "Filter" not in read.filter("id > 2400")._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
    reader = batches.BatchReader({"path": path}, read.schema)
    left = list(reader.pushFilters([batches.GreaterThan(("id",), 2400), batches.EqualTo(("price",), 1.0)]))
    assert [type(f) for f in left] == [batches.EqualTo]
    assert sum(len(p.batches) for p in reader.partitions()) <= 2
    assert len(batches.BatchReader({"path": path, "split_bytes": 1}, read.schema).partitions()) > 20


def test_replies():
    assert batches.accepted({"Status": "Success"}) and batches.accepted({"Status": "Publish Timeout"})
    assert batches.accepted({"Status": "Label Already Exists", "ExistingJobStatus": "FINISHED"}) and not batches.accepted({"Status": "Label Already Exists", "ExistingJobStatus": "CANCELLED"})
    assert not batches.accepted({"Status": "Fail", "Message": "x"})
    replies = iter([ConnectionError("lost"), {"Status": "Fail"}, {"Status": "Success", "n": 1}])

    def load():
        r = next(replies)
        if isinstance(r, Exception):
            raise r
        return r

    assert batches.sent(load, 2, 0.0)["n"] == 1
    with pytest.raises(batches.LoadRefused, match="too late"):
        batches.sent(lambda: {"Status": "Fail", "Message": "too late"}, 1, 0.0)


def test_a_refused_job_publishes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="not loaded after 1 attempts"):
        rows.write.format(batches.NAME).options(lose_replies=9, retries=0).mode("append").save(path)
    assert batches.FolderLoader(path).published() == [] and list(Path(path, "prepared").iterdir()) == []


def test_separator_in_a_value_and_nested_columns_are_errors(spark, tmp_path):
    with pytest.raises(Exception, match="separator"):
        spark.createDataFrame([("a@b",)], "x string").write.format(batches.NAME).option("encoding", "separated").mode("append").save(str(tmp_path / "a"))
    with pytest.raises(Exception, match="nested"):
        spark.createDataFrame([([1],)], "x array<int>").write.format(batches.NAME).mode("append").save(str(tmp_path / "b"))


def test_empty_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows.limit(0).write.format(batches.NAME).mode("append").save(path)
    assert spark.read.format(batches.NAME).load(path).count() == 0


def test_failing_task_attempts_load_once(tmp_path):
    """In a session of its own that tries tasks three times: every task's first attempt fails after some of its batches were sent."""
    script = f"""
from pyspark import TaskContext
from pyspark.sql import SparkSession
from waferlens.sources import batches
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.execution.arrow.maxRecordsPerBatch", "100").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
batches.register(spark)
plain = batches.FolderLoader.load
def failing(self, label, body):
    reply = plain(self, label, body)
    if TaskContext.get().attemptNumber() == 0 and label.endswith("-2"):
        raise MemoryError("the executor is lost")
    return reply
def write(self, iterator, own=batches.BatchWriter.write):
    batches.FolderLoader.load = failing
    return own(self, iterator)
batches.BatchWriter.write = write
import cloudpickle
cloudpickle.register_pickle_by_value(batches)
from pyspark import cloudpickle as inner
inner.register_pickle_by_value(batches)
df = spark.range(3000).repartition(3)
df.write.format(batches.NAME).option("batch_rows", 100).mode("append").save({str(tmp_path / "t")!r})
read = spark.read.format(batches.NAME).load({str(tmp_path / "t")!r})
attempts = {{b["label"].split("-")[2] for j in batches.FolderLoader({str(tmp_path / "t")!r}).published() for b in j["batches"]}}
print("ROWS", read.count(), read.distinct().count(), min(map(int, attempts)) > 0)
"""
    script = script.replace("import cloudpickle\ncloudpickle.register_pickle_by_value(batches)\n", "")
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1])})
    assert "ROWS 3000 3000" in done.stdout, done.stdout + done.stderr[-3000:]


def test_http_loader(spark, rows, tmp_path):
    """A service that loses the first reply to every batch and publishes at the second request."""
    prepared, loaded, asked = {}, {}, []

    class Service(BaseHTTPRequestHandler):
        def do_PUT(self):
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            label = self.headers["label"]
            asked.append((self.path, self.headers["Authorization"], self.headers["partitions"]))
            if self.path.endswith("_2pc"):
                loaded[label] = prepared.get(label)
                reply = {"Status": "Success"}
            elif label in prepared:
                reply = {"Status": "Label Already Exists", "ExistingJobStatus": "PREPARED"}
            else:
                prepared[label] = body
                reply = {"Status": "Fail", "Message": "busy"}
            text = json.dumps(reply).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(text)))
            self.end_headers()
            self.wfile.write(text)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/api/db/t/_stream_load"
        rows.select("id", "name").coalesce(2).write.format(batches.NAME).options(batch_rows=500, user="u", password="p", partitions="p20240101", wait=0.01).mode("append").save(url)
    finally:
        server.shutdown()
    sent = [json.loads(x) for body in loaded.values() for x in body.decode().splitlines()]
    assert sorted(r["id"] for r in sent) == list(range(2500)) and len(loaded) == len(prepared)
    assert {a[1] for a in asked if not a[0].endswith("_2pc")} == {"Basic dTpw"} and {a[2] for a in asked if not a[0].endswith("_2pc")} == {"p20240101"}
