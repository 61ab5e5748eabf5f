"""Statistics side by side against rows for each, and principal components from products of matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waferlens import catalog
from waferlens.operators import models, scores
from waferlens.sources import views


def test_statistics_side_by_side_equal_rows(spark, data):
    wide = views.inline_wide(spark, data, views.conf_wafer(spark, data).select("NAME"))
    keys = ["WAFER_ID", "PRODG1", "OPE_NO"]
    got = {(*[r[k] for k in keys], n): [r[f"{n}#{s}"] for s in views.STATS] for r in wide.collect() for n in views.NAMES}
    want = {(*[r[k] for k in keys], r.PARAMETRIC_NAME): [r[s] for s in views.STATS] for r in views.inline(spark, data).collect()}
    assert got.keys() == want.keys()
    assert np.array([got[k] for k in want], float) == pytest.approx(np.array(list(want.values()), float), rel=1e-12, abs=1e-12, nan_ok=True)


def test_statistics_of_gaps():
    nan = float("nan")
    found = views._statistics(np.array([3.0, nan, 1.0, 2.0, 10.0, nan]), np.array([0, 0, 0, 2, 2, 3]), 4)
    assert found["MEDIAN"] == pytest.approx([2.0, nan, 6.0, nan], nan_ok=True) and found["PERCENTILE_25"] == pytest.approx([1.5, nan, 4.0, nan], nan_ok=True)
    assert found["STD_DEV"] == pytest.approx([2**0.5, nan, 32**0.5, nan], nan_ok=True) and found["MAX_VAL"] == pytest.approx([3.0, nan, 10.0, nan], nan_ok=True)
    assert np.isnan(views._statistics(np.array([nan]), np.array([0]), 1)["AVERAGE"]).all()


def _tables(spark):
    """Groups with gaps, a constant, a feature that most units lack, few units, and a null key, long and side by side."""
    r = np.random.default_rng(5)
    names, rows = [f"f{j}" for j in range(9)], []
    for g, n in (("a", 70), ("b", 45), ("small", 7), (None, 8)):
        x = 1e6 + r.normal(size=(n, 9)) * [9, 7, 5, 4, 3, 2, 1, 0.5, 0.2] @ np.linalg.qr(r.normal(size=(9, 9)))[0]
        x[r.random((n, 9)) < 0.1], x[:, 8] = np.nan, 4.0
        x[:, 7] = np.where(r.random(n) < 0.8, np.nan, x[:, 7])
        rows += [(g, f"u{i:02d}", *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(x)] + [(g, "none", *[None] * 9)]
    wide = spark.createDataFrame(rows, "G string, UNIT string, " + ", ".join(f"{n} double" for n in names))
    return wide, wide.select("G", "UNIT", F.expr("stack(9, " + ", ".join(f"'{n}', {n}" for n in names) + ") as (FEATURE, RESULT)")), names


@pytest.mark.parametrize("options", [{}, {"variance": 0.8}, {"missing": 0.7, "normalise": False}, {"doubled": True}])
def test_components_from_matrices_equal_those_from_pairs(spark, monkeypatch, options):
    wide, long, names = _tables(spark)
    # Groups are handed on and put together again, each part around its own shift.
    monkeypatch.setattr(models, "HELD_GROUPS", 2)
    parts = wide.repartition(5)
    assert parts.rdd.getNumPartitions() == 5
    got = {(r.G, r.FEATURE, round(r.IMPORTANCE, 6)) for r in models.pca_wide(parts, ["G"], names, **options).collect()}
    want = {(r.G, r.FEATURE, round(r.IMPORTANCE, 6)) for r in models.pca_features(long, ["G"], **options).collect()}
    assert got == want and {g for g, *_ in got} == {"a", "b", "small"}


def test_unit_means_side_by_side_equal_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame([("w1", 0, "g", 1.0, None), ("w1", 0, "g", 4.0, nan), ("w2", 1, "g", nan, None), ("w3", 1, None, 1.0, 1.0), (None, 1, "g", 1.0, 1.0), ("w4", 1, "g", None, 2.0)], "WAFER_ID string, label int, G string, a double, b double")
    assert sorted(scores.wide_means(df, ["G"], ["a", "b"]).select("WAFER_ID", "a", "b").collect()) == [("w1", 2.5, None), ("w4", None, 2.0)]


@pytest.mark.parametrize("name", ["pca_topfeat", "pca_by_variance"])
def test_no_row_per_pair_of_features(spark, data, name):
    plan = catalog.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "MapInArrow" in plan
