"""Values related side by side against each alone and against plain folds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waferlens.operators import numbering, relation


@pytest.fixture(autouse=True)
def several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _rows(spark, n=400):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3)) + 5
    x[rng.random((n, 3)) < [0.0, 0.3, 0.6]] = np.nan
    x[7] = np.nan
    y = 2 * np.nan_to_num(x[:, 0]) + rng.normal(size=n)
    y[11] = np.nan
    # A hot group that several tasks hold, small ones, a null key, and a value that a group lacks altogether.
    rows = [(None if i % 40 == 3 else "hot" if i % 4 else f"g{i % 24}", f"u{i:03d}", *[None if np.isnan(v) and i % 2 else float(v) for v in (*x[i, :2], np.nan if i % 24 == 8 else x[i, 2], y[i])]) for i in range(n)]
    return spark.createDataFrame(rows, "g string, id string, a double, b double, c double, y double")


def test_values_side_by_side_equal_each_alone(spark):
    df = _rows(spark)
    several = relation.relations(df, ["g"], {"A": "a", "B": "b", "C": "c"}, "y", ["id"], "NAME")
    got = {(r.g, r.NAME): (r.PAIRS, r.WEIGHT) for r in several.collect()}
    want = {}
    for n in "abc":
        known = df.filter(f"{n} is not null and not isnan({n})")
        want |= {(r.g, n.upper()): (r.PAIRS, r.WEIGHT) for r in relation.relation(known, ["g"], n, "y", ["id"]).collect()}
    assert got.keys() == want.keys() and len(got) > 15 and any(0 < w < 1 for _, w in got.values())
    assert ("g8", "C") not in got and (None, "A") in got
    for k, (pairs, weight) in want.items():
        assert got[k] == (pairs, pytest.approx(weight, abs=1e-9)), k


def test_rows_move_once_and_are_not_joined(spark, monkeypatch):
    seen, sums = [], relation._fold_sums
    monkeypatch.setattr(relation, "_fold_sums", lambda rows, *a: seen.append((rows, sums(rows, *a))) or seen[-1][1])
    relation.relations(_rows(spark), ["g"], {"A": "a", "B": "b"}, "y", ["id"], "NAME")
    rows, found = seen[0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "MapInArrow" in plan
    assert "id" not in rows.columns and rows.select("_part").distinct().count() > 1


def test_places_count_only_rows_that_have_the_value(spark):
    df = spark.createDataFrame([(i, None if i % 3 else float(i)) for i in range(90)], "id int, v double")
    rows = numbering.placed_values(df, ["id"], ["v"], ["id"]).orderBy("id").collect()
    seen = {}
    for r in rows:
        assert r._at - r._gap0 == seen.get(r._part, 0)
        seen[r._part] = seen.get(r._part, 0) + (r.v is not None)


def test_folds_are_contiguous():
    for c in range(1, 60):
        k = 2 if c <= 5 else 3 if c <= 21 else 5
        want = np.concatenate([np.full(len(p), f) for f, p in enumerate(np.array_split(np.arange(c), k))]) if c != 3 else np.array([0, 1, 1])
        assert (relation._fold(np.arange(c), np.full(c, c)) == want).all(), c


def test_an_empty_table_has_no_relation(spark):
    empty = _rows(spark).filter(F.lit(False))
    assert relation.relations(empty, ["g"], {"A": "a"}, "y", ["id"], "NAME").collect() == []


def test_facts_are_made_once(spark, data, monkeypatch):
    from waferlens import catalog
    from waferlens.plans import pipelines

    seen, moved, placed = [], [], numbering.placed_values
    correlate = pipelines.correlate
    monkeypatch.setattr(pipelines, "correlate", lambda source, facts, *a: seen.append(facts) or correlate(source, facts, *a))
    monkeypatch.setattr(numbering, "placed_values", lambda df, *a: moved.append(df._jdf.queryExecution().executedPlan().toString()) or placed(df, *a))
    catalog.corr_wat(spark, data)
    assert seen[0]._jdf.queryExecution().optimizedPlan().toString().count("l_extendedprice#") and seen[0]._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    assert len(moved) == 1 and "Aggregate" not in moved[0] and "Exchange" not in moved[0]
