import random

import pytest
from pyspark.sql import functions as F

from waferlens.operators import numbering, relation


@pytest.fixture
def many_parts(spark):
    """So that small tables spread over tasks."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def _rows(spark, n=3000):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), i, rng.choice([None, *range(20)]), rng.random()) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, id long, v int, w double").repartition(7), rows


def test_numbers_follow_the_order_over_many_tasks(spark, many_parts):
    df, rows = _rows(spark)
    got = numbering.numbered(df, [F.desc("v"), "id"], "N")
    assert got.columns == ["g", "id", "v", "w", "N"]
    want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
    assert [r.id for r in got.orderBy("N").collect()] == [r[1] for r in want]
    assert sorted(r.N for r in got.collect()) == list(range(1, len(rows) + 1))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_placed_rows_lie_in_several_tasks(spark, many_parts):
    df, _ = _rows(spark)
    assert numbering.placed(df, ["id"]).select("_part").distinct().count() > 1


def test_numbers_within_groups_with_a_null_key_and_a_hot_one(spark, many_parts):
    df, rows = _rows(spark)
    got = {(r.g, r.id): r.N for r in numbering.numbered_within(df, ["g"], ["id"], "N").collect()}
    for g in ("a", "b", "c", None):
        for n, i in enumerate(sorted(r[1] for r in rows if r[0] == g), 1):
            assert got[g, i] == n
    assert len(got) == len(rows)


def test_empty_tables_and_columns_numbered_anew(spark):
    df, _ = _rows(spark, 10)
    assert numbering.numbered(df.filter("id < 0"), ["id"], "N").collect() == []
    again = numbering.numbered(numbering.numbered(df, ["id"], "N"), [F.desc("id")], "N")
    assert [r.N for r in again.orderBy("id").collect()] == list(range(10, 0, -1))


def test_rows_alike_in_the_order_get_different_numbers(spark, many_parts):
    df, _ = _rows(spark)
    assert numbering.numbered(df.withColumn("v", F.lit(1)), ["v"], "N").select("N").distinct().count() == 3000


def test_relation_of_a_group_over_many_tasks_is_that_of_one_task(spark, many_parts):
    df, _ = _rows(spark)
    df = df.withColumn("y", F.col("v") * 2 + F.col("w"))
    several = {r.g: r for r in relation.relation(df, ["g"], "v", "y", ["id"]).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for r in relation.relation(df.coalesce(1), ["g"], "v", "y", ["id"]).collect():
        assert several[r.g].PAIRS == r.PAIRS and several[r.g].WEIGHT == pytest.approx(r.WEIGHT, abs=1e-9)
        assert r.WEIGHT > 0.9
