"""Facts are dealt by unit once; what has the unit among its keys needs no other exchange, and no group's rows meet in one task."""

import re

from waferlens import catalog
from waferlens.functions import predicates as fp
from waferlens.operators import models, scores, shape
from waferlens.sources import views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def dealt_by(df):
    """Columns of every exchange by hash."""
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan(df))]


def test_unit_statistics_need_one_exchange_by_unit(spark, data):
    long = shape.unpivot_stats(views.inline(spark, data), ["WAFER_ID", "PRODG1", "OPE_NO", "PARAMETRIC_NAME"], views.STATS)
    assert [x for x in dealt_by(long) if "WAFER_ID" in x] == ["WAFER_ID"]
    means = scores.feature_means(catalog.labelled(spark, data), ["OPE_NO", "EQP_NAME"])
    assert [x for x in dealt_by(means) if "WAFER_ID" in x] == ["WAFER_ID"]


def test_a_mapping_is_not_shuffled_to(spark, data):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for exists in (True, False):
            found = fp.with_mapping(views.uva(spark, data), catalog._mapping(spark), "PARAMETRIC_NAME", [1, 2], exists)
            assert "BroadcastHashJoin" in plan(found) and "SortMergeJoin [PARAMETRIC_NAME" not in plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components_need_no_window(spark, data):
    cells = models.filled_matrix(catalog._units(spark, data), ["OPE_NO"], missing=0.9)
    assert "Window" not in plan(cells)
