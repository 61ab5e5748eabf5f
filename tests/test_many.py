import json

import pytest
from pyspark.sql import functions as F

from waferlens import catalog
from waferlens.plans import many, pipelines
from waferlens.plans.request import parse
from waferlens.sources import views


def _text(name, **params):
    return json.dumps({"requestId": name, "algorithm": "uva", "requestParam": {"uploadId": "U1", "groupByList": ["OPE_NO"], **params}})


def test_one_plan_answers_as_single_runs_do(spark, data):
    facts, conf = views.uva(spark, data), views.conf_wafer(spark, data)
    texts = [
        _text("a"),
        _text("b", prodg1="Brand#1*,Brand#23", dateRange={"start": "1993-03-05 12:00:00", "end": "1996-01-01"}),
        _text("c", groupByList=["OPE_NO", "EQP_NAME"], tool=["EQP1", "EQP2,EQP3"], eqp="EQP0", parametricName="*#ALL#MEAN"),
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {}
    for r in many.uva(facts, conf, many.request_table(rows)).collect():
        got.setdefault(r.REQUEST_ID, {})[r.OPE_NO, r.EQP_NAME, r.PARAMETRIC_NAME] = r
    assert set(got) == {"a", "b", "c"}
    for t in texts:
        request = parse(t)
        want = pipelines.run(request, {"uva": facts, "conf_wafer": conf}).collect()
        own = got[request.request_id]
        assert len(own) == len(want)
        for w in want:
            g = own[w.OPE_NO, w.EQP_NAME if "EQP_NAME" in request.keys else None, w.PARAMETRIC_NAME]
            assert (g.GOOD_NUM, g.BAD_NUM) == (w.GOOD_NUM, w.BAD_NUM) and g.WEIGHT == pytest.approx(w.WEIGHT, abs=1e-9)
        assert sorted(r.INDEX_NO for r in own.values()) == list(range(1, len(own) + 1))
        assert max(own.values(), key=lambda r: r.WEIGHT).WEIGHT == min(own.values(), key=lambda r: r.INDEX_NO).WEIGHT


def test_tables_say_what_they_refuse(spark):
    texts = [_text("a"), _text("b", uploadId=None), _text("c", model="rf"), _text("d", mergeEqp=[["EQP1", "EQP2"]]), _text("e", groupByList=["LOT_ID"]), json.dumps({"requestId": "f", "algorithm": "defect", "requestParam": {"uploadId": "U1"}}), _text("g", dateRange={"start": "soon"})]
    rows = {r.REQUEST_ID: r for r in many.request_table(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert {n: r.REFUSED for n, r in rows.items()} == {"a": None, "b": "uploadId is missing", "c": "another model", "d": "merge rules", "e": "unknown group key", "f": "another algorithm", "g": "malformed date"}


def test_keys_ranges_and_keywords_are_parsed(spark):
    text = _text("a", groupByList=None, flagMergeAllProdg1="1", operNo=["A,N", "R"], prodg1="x%_*,y", dateRange=[{"start": "2024-01-01", "end": ""}, {"end": "2023-01-01"}])
    r = many.request_table(spark.createDataFrame([(text,)], "text string")).first()
    assert r.KEYS == ["OPE_NO", "EQP_NAME", "CHAMBER_NAME"]
    assert r["_is_OPE_NO"] == ["A", "N", "R"] and r["_is_PRODG1"] == ["y"] and r["_like_PRODG1"] == ["x\\%\\_%"]
    assert [(x.start and x.start.year, x.end and x.end.year) for x in r.RANGES] == [(2024, None), (None, 2023)]


def test_facts_without_a_time_and_requests_without_a_match(spark, data):
    facts, conf = views.uva(spark, data), views.conf_wafer(spark, data)
    undated = facts.withColumn("START_TIME", F.lit(None).cast(facts.schema["START_TIME"].dataType))
    texts = [_text("open"), _text("dated", dateRange={"start": "1993-01-01"}), _text("none", dateRange={"start": "2050-01-01"})]
    requests = many.request_table(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert {r.REQUEST_ID for r in many.uva(undated, conf, requests).select("REQUEST_ID").distinct().collect()} == {"open"}
    assert {r.REQUEST_ID for r in many.uva(facts, conf, requests).select("REQUEST_ID").distinct().collect()} == {"open", "dated"}


def test_fifty_requests_are_generated(spark, data):
    assert many.request_table(catalog.request_texts(spark, data)).filter("REFUSED is null").select("REQUEST_ID").distinct().count() == 50


def _asked(spark, texts):
    return many._numbered(many.request_table(spark.createDataFrame([(t,) for t in texts], "text string")))


def test_a_fact_is_copied_for_each_chunk_of_requests_and_not_for_each_request(spark, monkeypatch):
    monkeypatch.setattr(many, "CHUNK", 3)
    spans = [{}, {"start": "2024-01-01 06:00:00"}, {"end": "2024-01-01 06:00:00"}, [{"start": "2024-01-01 01:00:00", "end": "2024-01-01 07:00:00"}, {"start": "2024-01-02"}], {"start": "2030-01-01"}]
    words = [{}, {"prodg1": "a*"}, {"prodg1": "a1,b1", "operNo": "N"}]
    params = [{"dateRange": s, **w} for s in spans for w in words]
    asked = _asked(spark, [_text(f"r{n:02d}", **p) for n, p in enumerate(params)])
    times = [None, "2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-01 05:59:59", "2024-01-01 06:00:00", "2024-01-01 07:00:00", "2024-01-03 00:00:00"]
    rows = [(f"{n}", "U1", t, g, o) for n, (t, g, o) in enumerate((t, g, o) for t in times for g in ("a1", "b1", None) for o in ("N", "A"))]
    facts = spark.createDataFrame(rows, "ID string, UPLOAD_ID string, t string, PRODG1 string, OPE_NO string").withColumn("START_TIME", F.col("t").cast("timestamp")).drop("t")

    def wants(p, t, g, o):
        spans = p["dateRange"] if isinstance(p["dateRange"], list) else [p["dateRange"]]
        timely = any((not s) if t is None else s.get("start", "") <= t < s.get("end", "9") for s in spans)
        family = "prodg1" not in p or (g or "").startswith("a") or (p["prodg1"] == "a1,b1" and g == "b1")
        return timely and family and ("operNo" not in p or o == "N")

    got = many.wanted(facts, asked)
    assert got.groupBy("ID", "_chunk").count().filter("count > 1").isEmpty()
    found = {(r.ID, f"r{r._chunk * 3 + bit:02d}") for r in got.collect() for bit in range(3) if r._set >> bit & 1}
    assert found == {(i, f"r{n:02d}") for i, _, t, g, o in rows for n, p in enumerate(params) if wants(p, t, g, o)}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_last_runs_by_bits(spark, kind):
    sets = {("w1", "A", "C1", 1): [7, 1], ("w1", "A", "C1", 2): [2, 4 | 2], ("w1", "A", "C1", 3): [8], ("w1", "A", "C2", 1): [1 | -(2**63)], ("w2", "A", "C1", 5): [3]}
    rows = [("U1", 0, w, 0, o, c, r, s) for (w, o, c, r), own in sets.items() for s in own]
    df = spark.createDataFrame(rows, "UPLOAD_ID string, _chunk long, WAFER_ID string, label int, OPE_NO string, CHAMBER_ID string, RUN_ID long, _set long").withColumn("RUN_ID", F.col("RUN_ID").cast(kind))
    out = many.last_wanted(df)
    assert {(r.WAFER_ID, r.CHAMBER_ID, int(r.RUN_ID), r._set) for r in out.collect()} == {("w1", "C1", 3, 8), ("w1", "C1", 2, 2), ("w1", "C1", 2, 6), ("w1", "C1", 1, 1), ("w1", "C2", 1, 1 | -(2**63)), ("w2", "C1", 5, 3)}
    news = {}
    for r in out.collect():
        for bit in range(64):
            news[r.WAFER_ID, bit] = news.get((r.WAFER_ID, bit), 0) + (r._new >> bit & 1)
    assert {k for k, n in news.items() if n} == {("w1", 0), ("w1", 1), ("w1", 2), ("w1", 3), ("w1", 63), ("w2", 0), ("w2", 1)} and set(news.values()) == {0, 1}


def test_wide_facts_answer_as_long_ones_do(spark, data):
    wide = views.passes(spark, data).withColumn("l_tax", F.when(F.col("RUN_ID") % 3 > 0, F.col("l_tax")))
    wide = wide.unionByName(wide.filter("RUN_ID % 5 = 0").withColumn("l_discount", F.col("l_discount") + 1))  # equal but for one value
    texts = [_text("a", groupByList=["OPE_NO", "EQP_NAME"]), _text("b", prodg1="Brand#1*", dateRange=[{"end": "1994-01-01"}, {"start": "1996-01-01"}])]
    requests = many.request_table(spark.createDataFrame([(t,) for t in texts], "text string"))
    conf, names = views.conf_wafer(spark, data), ["REQUEST_ID", "OPE_NO", "EQP_NAME", "PARAMETRIC_NAME", "GOOD_NUM", "BAD_NUM"]
    a, b = ({tuple(r[n] for n in names): r.WEIGHT for r in many.uva(f, conf, requests, p).collect()} for f, p in ((views.parameters_apart(wide).filter("RESULT is not null"), None), (wide, views.NAMES)))
    assert a.keys() == b.keys() and a == pytest.approx(b, abs=1e-9)
