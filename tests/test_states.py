import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waferlens.operators import states


def _samples(spark, n=20_000):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i % 12 + 1, i % 60, rng.choice([None, float("nan"), *[rng.gauss(1e6, 2.0) for _ in range(8)]])) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, day int, s int, VAL double")
    return df.withColumn("TIME_STAMP", F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.col("s").cast("decimal(8,6)"))).drop("s"), rows


def test_merged_states_equal_one_pass(spark):
    df, rows = _samples(spark)
    parts = states.states(df, ["g", "day"])
    got = {r.g: r for r in states.features(states.merged(parts, ["g"]), ["g"]).collect()}
    assert set(got) == {"a", "b", None}
    for g, r in got.items():
        x = np.sort([v for k, _, _, v in rows if k == g and v is not None and v == v])
        assert r.N == len(x)
        assert r.AVERAGE == pytest.approx(x.mean(), rel=1e-13) and r.STD_VAL == pytest.approx(x.std(), rel=1e-9)
        assert (r.MIN_VAL, r.MAX_VAL) == (x[0], x[-1])
        for name, q in states.QUANTILES.items():
            assert abs(np.searchsorted(x, r[name]) / len(x) - q) < 0.01


def test_merging_in_steps_is_merging_at_once(spark):
    df, _ = _samples(spark, 5000)
    parts = states.states(df, ["g", "day"])
    steps = states.merged(states.merged(parts.withColumn("half", F.col("day") % 2), ["g", "half"]), ["g"])
    once = {r.g: r for r in states.merged(parts, ["g"]).collect()}
    for r in steps.collect():
        assert (r.N, r.MIN_VAL, r.MAX_VAL, r.START_TIME) == tuple(once[r.g][c] for c in ("N", "MIN_VAL", "MAX_VAL", "START_TIME"))
        assert r.MEAN == pytest.approx(once[r.g].MEAN, rel=1e-13) and r.M2 == pytest.approx(once[r.g].M2, rel=1e-9)


def test_constants_spread_nothing_and_single_samples_have_no_sample_spread(spark):
    df = spark.createDataFrame([("c", 1, 1e9 / 7)] * 5 + [("c", 2, 1e9 / 7)] * 3 + [("one", 1, 4.0), ("none", 1, None)], "g string, day int, VAL double").withColumn("TIME_STAMP", F.lit("2024-01-01").cast("timestamp"))
    parts = states.merged(states.states(df, ["g", "day"]), ["g"])
    assert {r.g: r.STD_VAL for r in states.features(parts, ["g"]).collect()} == {"c": pytest.approx(0, abs=1e-6), "one": 0.0}
    assert {r.g: r.STD_VAL for r in states.features(parts, ["g"], population=False).collect()}["one"] is None
    assert states.merged(states.states(df.filter("false"), ["g", "day"]), ["g"]).collect() == []


def test_a_day_loaded_again_replaces_itself_and_ranges_read_their_days(spark, tmp_path):
    df, rows = _samples(spark, 3000)
    table = states.StateTable(str(tmp_path / "t"), ("g",))
    table.load(df)
    table.load(df.filter("day in (2, 3)").filter("g = 'a'"))
    want = sum(v is not None and v == v and 2 <= d < 5 and (d == 4 or g == "a") for g, d, _, v in rows)
    read = table.read(spark, "2024-01-02", "2024-01-05")
    assert read.agg(F.sum("N")).first()[0] == want
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DAY" in plan
