"""What a task sorts or holds does not grow with the tables."""

import pytest

from waferlens import catalog
from waferlens.operators import counts
from waferlens.plans import pipelines
from waferlens.sources import views


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tasks_of_the_facts_follow_their_rows(spark, data, monkeypatch):
    monkeypatch.setattr(views, "TASK_ROWS", 500, raising=False)
    rows = views.passes(spark, data)
    assert rows.rdd.getNumPartitions() == -(-spark.read.parquet(f"{data}/lineitem.parquet").count() // 500)


def test_units_are_looked_up_without_sorting_facts(spark, data, no_broadcast):
    facts, conf = views.inline(spark, data), views.conf_wafer(spark, data)
    for df in (catalog.labelled(spark, data), pipelines.labelled(facts, conf, "U1"), catalog._units(spark, data), pipelines._with_base(facts, views.anomaly(spark, data))):
        assert "ShuffledHashJoin [WAFER_ID" in _plan(df) and "SortMergeJoin [WAFER_ID" not in _plan(df)


def test_units_are_not_dealt_by_group_to_find_uneven_ones(spark, data, no_broadcast):
    rows = catalog.labelled(spark, data)
    uneven = pipelines._uneven(counts.commonality(rows, ["OPE_NO"]), ["OPE_NO"], 0.0)
    assert "BroadcastHashJoin [OPE_NO" in _plan(rows.join(uneven, ["OPE_NO"], "left_semi"))


def test_a_hot_group_is_not_joined_by_its_key_alone(spark):
    from waferlens.operators import balance

    rows = [("g", f"w{i:03d}", 6, [float(i % 7), float(i)]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "G string, WAFER_ID string, K int, v array<double>")
    blocks = vectors.selectExpr("G", "array(WAFER_ID) units", "v x", "2 width").repartition(5)
    centres = vectors.filter("WAFER_ID < 'w006'").selectExpr("G", "cast(v[1] as int) CENTRE", "v")
    own, _ = balance._assigned(blocks, centres, ["G"], "G string")
    assert "Join" not in _plan(own) and "Exchange hashpartitioning(G" not in _plan(own)
    found = {r.WAFER_ID: (r.CENTRE, r.D) for r in own.collect()}
    assert found["w003"] == (3, 0.0) and found["w059"] == (5, (59 % 7 - 5) ** 2 + 54.0**2)


def test_fits_read_written_means_and_sort_no_class(spark, data, monkeypatch):
    from waferlens.operators import models

    seen = []
    monkeypatch.setattr(models, "group_importances", lambda rows, keys, groups: seen.append(rows) or rows)
    catalog.rf_importance(spark, data)
    assert "Join" not in _plan(seen[0]) and seen[0].count() == seen[0].select("OPE_NO", "UNIT", "label", "FEATURE").distinct().count()
    rows = spark.createDataFrame([("u1", 1, "a", 2.0), ("u2", 1, "b", 4.0), ("u3", 0, "a", 8.0), ("u3", 0, "b", 6.0)], "UNIT string, label int, FEATURE string, RESULT double")
    table = models.feature_table(rows, ["a", "b"])
    assert "Window" not in _plan(table)
    assert {r.UNIT: list(r.features) for r in table.collect()} == {"u1": [2.0, 4.0], "u2": [2.0, 4.0], "u3": [8.0, 6.0]}
