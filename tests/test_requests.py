import json
from datetime import datetime

import numpy as np
import plain_two_samples as plain
import pytest
from pyspark.sql import functions as F

from waferlens.functions import columns as fc
from waferlens.functions import hypothesis_tests as ht
from waferlens.functions import predicates as fp
from waferlens.operators import counts, models
from waferlens.plans import etl, pipelines
from waferlens.plans.request import RequestError, parse
from waferlens.sources import tables


def _text(algorithm="uva", **params):
    return json.dumps({"requestId": "r", "algorithm": algorithm, "requestParam": {"uploadId": "U", **params}})


def test_defaults_and_switches():
    assert parse(_text()).keys == ("PRODG1", "PRODUCT_ID", "OPE_NO", "EQP_NAME", "CHAMBER_NAME")
    r = parse(_text(flagMergeAllProdg1="1", flagMergeAllChamber="1", mergeProductId=[["a", "b"]], mergeEqp=[["e", "f"]]))
    assert r.keys == ("OPE_NO", "EQP_NAME") and dict(r.merges) == {"EQP_NAME": (("e", "f"),)}
    assert parse(_text(operNo=["1,2", "3"])).filters["OPE_NO"] == ("1", "2", "3")


@pytest.mark.parametrize(("name", "want"), [("inline_by_wafer", ("inline", "wafer")), ("wat_by_site", ("wat", "site")), ("inline_by_anything", ("inline", "zone")), ("correlation_by_zone", ("correlation", "zone"))])
def test_algorithm_names(name, want):
    r = parse(_text(name, inline={}))
    assert (r.source, r.granularity) == want


@pytest.mark.parametrize("text", ["{", _text("nothing"), json.dumps({"algorithm": "uva"}), _text("correlation_by_wafer")])
def test_faulty_requests(text):
    with pytest.raises(RequestError):
        parse(text)


def test_keyword_wild_cards_are_literal_otherwise(spark):
    df = spark.createDataFrame([("a_b",), ("axb",), ("50%",), ("500",), (None,)], "v string")
    assert [r.v for r in df.filter(fp.keyword("v", ["a_*"])).collect()] == ["a_b"]
    assert [r.v for r in df.filter(fp.keyword("v", ["*%"])).collect()] == ["50%"]
    assert df.filter(fp.keyword("v", [])).count() == 5
    assert df.filter(fp.excludes("v", ["a", "b"])).count() == 2  # a null name does not pass


def test_number_is_lenient(spark):
    df = spark.createDataFrame([("1.5",), ("12ab",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(fc.number("v")).collect()] == [1.5, None, None, None]


def test_merge_rules_apply_in_order(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    rows = fc.merge_columns(df, {"v": [["a", "b"], ["a,b", "c"]]})
    assert {r.v for r in rows.collect()} == {"a,b,c"}
    with pytest.raises(ValueError):
        fc.merge_columns(df, {"x": [["a"]]}, strict=True)


def test_no_group_with_both_classes(spark):
    df = spark.createDataFrame([("g", "w", 0, "p", 1.0)], "G string, WAFER_ID string, label int, PARAMETRIC_NAME string, RESULT double")
    with pytest.raises(RequestError):
        pipelines.score_groups(df, ["G"], "r")


def test_row_order_does_not_matter(spark, data):
    from waferlens.sources import views

    request = parse(json.dumps({"requestId": "r", "algorithm": "uva", "requestParam": {"uploadId": "U1", "groupByList": ["OPE_NO"]}}))
    facts, conf = views.uva(spark, data), views.conf_wafer(spark, data)
    a, b = (pipelines.uva(f, conf, request).select("INDEX_NO", "PARAMETRIC_NAME", F.round("WEIGHT", 9)).sort("INDEX_NO").collect() for f in (facts, facts.orderBy(F.rand(3))))
    assert a == b


def test_properties_and_sinks(spark, tmp_path):
    assert tables.read_properties(["a = 1", "# b = 2", "", "c=x=y"]) == {"a": "1", "c": "x=y"}
    df = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int")
    sink = tables.Sink(str(tmp_path / "t"))
    sink.replace_slices(df, "day")
    sink.replace_slices(spark.createDataFrame([("d2", 9)], "day string, v int"), "day")
    assert {(r.day, r.v) for r in spark.read.parquet(sink.path).collect()} == {("d1", 1), ("d2", 9)}
    tables.separated_text(str(tmp_path / "c")).write(df)
    assert sorted(r.value for r in tables.read_text(spark, str(tmp_path / "c")).collect()) == ["d1@1", "d2@2"]
    tables.Sink(str(tmp_path / "h"), "csv", options={"header": "true"}).write(df)
    assert {(r.day, r.v) for r in tables.read_csv(spark, str(tmp_path / "h"), "day string, v int").collect()} == {("d1", 1), ("d2", 2)}
    assert tables.notify(None, "t", "SUCCESS") == {"taskId": "t", "status": "SUCCESS", "message": ""}
    assert [r.day for r in tables.empty_partitions(spark.createDataFrame([("d1",), ("d3",)], "day string"), df, "day").collect()] == ["d3"]


def test_sinks_append_order_fields_partition_and_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("d1", 1, "x"), ("d2", 2, "y")], "day string, v int, extra string")
    sink = tables.Sink(str(tmp_path / "a"), fields=("v", "day"))
    sink.write(df)
    sink.write(df)
    got = spark.read.parquet(sink.path)
    assert got.columns == ["v", "day"] and sorted((r.v, r.day) for r in got.collect()) == [(1, "d1"), (1, "d1"), (2, "d2"), (2, "d2")]
    sink.write(df.limit(1), mode="overwrite")
    assert spark.read.parquet(sink.path).count() == 1
    parts = tables.Sink(str(tmp_path / "p"), rows_per_file=1)
    parts.write(df, partition_by=("day",))
    assert "PartitionFilters: [isnotnull(day" in spark.read.parquet(parts.path).filter("day = 'd2'")._jdf.queryExecution().toString()
    df.createOrReplaceTempView("renamed_rows")
    assert tables.read_as(spark, "SELECT day, v FROM renamed_rows", ["A", "B"]).columns == ["A", "B"]
    row = tables.audit_row(spark, "job", "OK", 2, "a", "b").first()
    assert (row.JOB, row.STATUS, row.ROWS_OUT) == ("job", "OK", 2)
    source = tables.TableSource(spark, str(tmp_path))
    df.write.parquet(str(tmp_path / "facts.parquet"))
    source.register("facts")
    assert source.query("SELECT sum(v) AS s FROM facts").first().s == 3


def test_tables_over_jdbc(spark, tmp_path):
    """Written, appended and read through the embedded database that Spark ships, whole, split by a column, and as a pushed-down query."""
    where = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(100).selectExpr("id", "id % 3 as g", "cast(id as string) as extra")
    sink = tables.Sink(str(tmp_path / "unused"), "jdbc", fields=("g", "id"), options={**where, "dbtable": "facts"})
    sink.write(df.filter("id < 60"))
    sink.write(df.filter("id >= 60"))
    source = tables.TableSource(spark, jdbc=where)
    whole, split = source.table("facts"), source.table("facts", "id", ("0", "100"), 4)
    assert [c.lower() for c in whole.columns] == ["g", "id"]
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() == 4
    assert sorted(r[1] for r in split.collect()) == sorted(r[1] for r in whole.collect()) == list(range(100))
    assert "PushedFilters: [*IsNotNull(g), *EqualTo(g" in source.table("facts").filter("g = 1")._jdf.queryExecution().toString()
    assert sorted(r[0] for r in source.query('SELECT "id" FROM facts WHERE "g" = 2').collect()) == list(range(2, 100, 3))


def test_several_requests_in_one_table(spark, data):
    from waferlens.sources import views

    uva = parse(_text(uploadId="U1", groupByList=["OPE_NO"]))
    chi2 = parse(json.dumps({"requestId": "r2", "algorithm": "uva", "requestParam": {"uploadId": "U1", "groupByList": ["OPE_NO"], "model": "chi2"}}))
    found = {"uva": views.uva(spark, data), "conf_wafer": views.conf_wafer(spark, data)}
    both = pipelines.run_all([uva, chi2], found).collect()
    single = pipelines.run(uva, found).collect()
    assert {r.REQUEST_ID for r in both} == {"r", "r2"} and len(both) == 2 * len(single)
    assert sorted(r.INDEX_NO for r in both if r.REQUEST_ID == "r2") == list(range(1, len(single) + 1))
    with pytest.raises(RequestError):
        pipelines.run_all([], found)


def test_too_few_bad_units_are_refused(spark):
    schema = "WAFER_ID string, label int, v int"
    rows = [("a", 0, 1), ("b", 1, 2), ("b", 1, 3)]
    with pytest.raises(Exception, match="too few bad units: 1"):
        counts.enough_bad(spark.createDataFrame(rows, schema)).collect()
    with pytest.raises(Exception, match="too few bad units: 0"):
        counts.enough_bad(spark.createDataFrame([], schema)).count()
    more = spark.createDataFrame([*rows, ("c", 1, 4)], schema)
    assert sorted(counts.enough_bad(more).collect()) == sorted(more.collect())


def test_day_ranges():
    now = datetime(2024, 5, 10, 14, 30)
    day = [datetime(2024, 5, d) for d in range(1, 13)]
    assert etl.day_range("20240501", "20240503", now) == (day[0], day[3])
    assert etl.day_range(None, None, now) == (day[8], day[9])  # yesterday
    assert etl.day_range("20240501", "20240512", now) == (day[0], day[9])  # not past today's midnight
    assert etl.day_range("not a day", "20240508", now) == (day[8], day[8])


@pytest.mark.parametrize("model", ["rf", "decisionTree", "svc", "logistic"])
def test_estimators_find_the_telling_feature(spark, model):
    r = np.random.default_rng(3)
    rows = [("g", f"u{i}", i % 2, f, float(r.normal((i % 2) * 4 * (f == "b") - 2 * (f == "b"), 1))) for i in range(30) for f in ("a", "b")]
    rows += [("one class", f"u{i}", 0, f, float(i)) for i in range(3) for f in ("a", "b")] + [("one feature", f"u{i}", i % 2, "a", float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "G string, UNIT string, label int, FEATURE string, RESULT double")
    got = {(q.G, q.FEATURE): q for q in models.group_importances(df, ["G"], df.select("G").distinct().collect(), model).collect()}
    assert set(got) == {("g", "a"), ("g", "b"), ("one class", "a"), ("one class", "b"), ("one feature", "a")}
    assert got["g", "b"].IMPORTANCE > 2 * got["g", "a"].IMPORTANCE and got["g", "b"].AUC > 0.9
    assert {got[k].IMPORTANCE for k in got if k[0] != "g"} == {0.0}


def test_predicates_of_groups_and_names(spark):
    df = spark.createDataFrame([("a", "x"), ("b", ""), ("c", "NA"), ("d", None)], "g string, n string")
    assert [r.g for r in df.filter(fp.named("n")).collect()] == ["a"]
    groups = spark.createDataFrame([("a",), ("a",), ("c",)], "g string")
    assert sorted(r.g for r in fp.in_groups(df, groups, ["g"]).collect()) == ["a", "c"]
    assert [r.x for r in df.select(fp.label_from_lists("g", good=["a"]).alias("x")).collect()] == [0, 1, 1, 1]
    assert [r.x for r in df.select(fp.label_from_lists("g", bad=["a"]).alias("x")).collect()] == [1, 0, 0, 0]


@pytest.mark.parametrize("name", ["nonsense", "ANOVA"])
def test_unknown_models_are_errors(name):
    with pytest.raises(RequestError):
        parse(_text(model=name))


def test_models_change_the_scores(spark):
    r = np.random.default_rng(2)
    rows = [("g", f"w{i}", i % 2, p, float(r.normal(1 + (i % 2) * w, 1))) for i in range(40) for p, w in (("a", 2), ("b", 0.5), ("c", 0))]
    df = spark.createDataFrame(rows, "G string, WAFER_ID string, label int, PARAMETRIC_NAME string, RESULT double")
    found = {m: {q.PARAMETRIC_NAME: q.WEIGHT for q in pipelines.score_groups(df, ["G"], "r", model=m).collect()} for m in ("anova", "chi2", "mutual_info", "logistic")}
    assert all(max(w, key=w.get) == "a" for w in found.values()), found
    assert len({round(w["a"], 6) for w in found.values()}) == len(found)
    assert all(sum(w.values()) == pytest.approx(1) for w in found.values())


def test_stats_without_both_classes_fail(spark):
    df = spark.createDataFrame([("g", "w", 0, "p", 1.0)], "G string, WAFER_ID string, label int, PARAMETRIC_NAME string, S double")
    request = parse(_text("wat_by_wafer"))
    with pytest.raises(Exception, match="both good and bad"):
        pipelines.score_stats(df, ["G"], ["S"], request).collect()


def test_empty_group_list_is_no_grouping():
    assert parse(_text("wat_by_wafer", groupByList=[])).keys == () and parse(_text("wat_by_wafer")).keys != ()


def test_correlation_filters_by_upload(spark):
    part = parse(_text("correlation_by_wafer", process={"groupByList": ["EQP_NAME"], "correlation_filter_upload_id": "A"})).parts["process"]
    facts = spark.createDataFrame([("w1", "e"), ("w2", "e")], "WAFER_ID string, EQP_NAME string")
    units = spark.createDataFrame([("w1", "A"), ("w2", "B")], "NAME string, UPLOAD_ID string")
    assert [r.WAFER_ID for r in pipelines.correlation_rows("process", facts, part, units).collect()] == ["w1"]
    with pytest.raises(RequestError):
        pipelines.correlation_rows("process", facts, part)


def test_hypothesis_tests_known_values():
    # Reference values worked out with an independent statistics package.
    assert ht.t_p(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert ht.f_p(4.0, 2, 12) == pytest.approx(0.046656, abs=1e-5)
    u, p = plain.mann_whitney(np.array([1.0, 2, 3]), np.array([4.0, 5, 6]))
    assert (u, p) == (0.0, pytest.approx(0.1))
    assert ht.mann_whitney(3, 3, 6.0, 0) == (0.0, pytest.approx(0.1))
    assert plain.shapiro(np.array([1.0, 2, 3])) == pytest.approx(1.0, abs=1e-6)
    r = np.random.default_rng(0)
    assert plain.shapiro(r.normal(size=50)) > 0.05 > plain.shapiro(r.exponential(size=50))
    assert plain.ladder(np.array([1.0, 2, 3]), np.array([3.0, 4, 0]))[0] == "student"


@pytest.mark.parametrize("by_mean", [False, True])
def test_ladder_of_sums_equals_ladder_of_samples(spark, by_mean):
    """Sizes around every branch: short samples, ties, constants, skew, unequal spread, a far offset, one class only."""
    r = np.random.default_rng(7)
    pairs = {"one": ([4.0], [5.0, 6.0]), "same": ([2.0] * 4, [2.0] * 5), "constants": ([1.0] * 4, [2.0] * 4), "tied": ([1.0, 1, 2, 9, 9, 9, 50], [1.0, 2, 2, 2, 60, 9, 9])}
    for n, m in ((3, 3), (4, 5), (5, 9), (6, 6), (8, 40), (11, 12), (30, 7), (60, 200)):
        pairs |= {f"normal {n} {m}": (r.normal(0, 1, n), r.normal(0.5, 1, m)), f"wide {n} {m}": (r.normal(0, 1, n), r.normal(0, 9, m)), f"skew {n} {m}": (r.exponential(1, n) ** 3, r.exponential(1, m)), f"far {n} {m}": (r.normal(1e6, 1, n), r.normal(1e6, 1, m))}
    rows = [(g, c, float(v)) for g, both in pairs.items() for c, own in enumerate(both) for v in own]
    df = spark.createDataFrame([*rows, ("lonely", 0, 1.0), ("tied", 1, None), (None, 0, 1.0), (None, 1, 2.0)], "G string, label int, V double")
    got = {q.G: (q.TEST, q.STATISTIC, q.IMPORTANCE) for q in models.two_sample_tests(df, ["G"], "V", by_mean=by_mean).collect()}
    assert set(got) == {*pairs, None}
    assert {q[0] for q in got.values()} == {"student", "welch", "mann_whitney"}
    for g, (x, y) in pairs.items():
        test, statistic, p = plain.ladder(np.array(x), np.array(y), by_mean=by_mean)
        assert got[g] == (test, pytest.approx(statistic, rel=1e-6, abs=1e-9), pytest.approx(1 - p, abs=1e-6)), g


def test_streaming_features(spark, data, tmp_path):
    from waferlens.streaming import run_features as rf

    source = str(tmp_path / "in")
    spark.read.parquet(f"{data}/events.parquet").select("ts", "event_type", "value").repartition(3).write.parquet(source)
    feats = rf.windowed_features(rf.read_samples(spark, source, "ts timestamp, event_type string, value double"), ["event_type"], delay="1000 days")
    rf.write_features(feats, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    query = feats.writeStream.outputMode("complete").format("memory").queryName("feats").trigger(availableNow=True).start()
    query.awaitTermination(120)
    want = spark.read.parquet(source).groupBy(F.window("ts", "1 day").start.alias("START_TIME"), "event_type").count()
    assert spark.table("feats").count() == want.count()


def test_rows_of_several_date_ranges(spark):
    text = {"requestId": "r", "algorithm": "uva", "requestParam": {"uploadId": "U", "dateRange": [{"start": "2024-01-02", "end": "2024-01-04"}, {"start": "2024-01-08"}, {"end": "2023-12-31"}]}}
    rows = spark.sql("SELECT explode(sequence(timestamp'2023-12-30', timestamp'2024-01-10', interval 1 day)) AS START_TIME")
    got = pipelines.selected(rows, parse(json.dumps(text))).collect()
    assert sorted(r.START_TIME.strftime("%m%d") for r in got) == ["0102", "0103", "0108", "0109", "0110", "1230"]
    for dates in ([], {}, None):
        text["requestParam"]["dateRange"] = dates
        assert pipelines.selected(rows, parse(json.dumps(text))).count() == 12


def test_parameters_side_by_side_answer_as_rows_do(spark, data):
    from waferlens.sources import views

    wide = views.passes(spark, data).withColumn("l_tax", F.when(F.col("RUN_ID") % 3 > 0, F.col("l_tax")))
    wide = wide.unionByName(wide.filter("RUN_ID % 5 = 0").withColumn("l_discount", F.col("l_discount") + 1))  # equal but for one value
    long, conf = views.parameters_apart(wide), views.conf_wafer(spark, data)
    for params in ({"model": "chi2"}, {"model": "anova", "prodg1": "Brand#1*"}, {"model": "chi2", "parametricName": "QTY*,TAX*"}, {"model": "mutual_info"}):
        request = parse(json.dumps({"requestId": "r", "algorithm": "uva", "requestParam": {"uploadId": "U1", "groupByList": ["OPE_NO", "EQP_NAME"], **params}}))
        names = ["OPE_NO", "EQP_NAME", "PARAMETRIC_NAME", "GOOD_NUM", "BAD_NUM"]
        a, b = ({tuple(r[n] for n in names): r.WEIGHT for r in pipelines.uva(f, conf, request, parameters=p).collect()} for f, p in ((long, None), (wide, views.NAMES)))
        assert a.keys() == b.keys() and a == pytest.approx(b, abs=1e-9)


def test_unit_means_are_scored_without_another_exchange_of_units(spark, data, monkeypatch):
    from waferlens.sources import views

    request = parse(json.dumps({"requestId": "r", "algorithm": "uva", "requestParam": {"uploadId": "U1", "groupByList": ["OPE_NO"], "model": "chi2"}}))
    plans = []
    kept = pipelines.written
    monkeypatch.setattr(pipelines, "written", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or kept(df, name))
    monkeypatch.setattr(pipelines, "balanced_scores", lambda *a: pytest.fail("no group is uneven here"))
    out = pipelines.uva(views.passes(spark, data), views.conf_wafer(spark, data), request, parameters=views.NAMES)
    assert out.count() == 12 and [n for n, _ in plans] == ["unit_means", "moments"]
    # Facts are dealt by unit once; moments leave a task as one row a group.
    assert all(x.count("hashpartitioning(WAFER_ID") == (n == "unit_means") and "PARAMETRIC_NAME" not in x for n, x in plans)
