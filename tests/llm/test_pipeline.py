"""Each stage against plain Python on its own input."""

import re

import pytest

import corpus_pipeline
from waferlens.llm import jaccard, secrets
from waferlens.llm.common import cut


@pytest.fixture(scope="module")
def stages(spark, data):
    docs, out = spark.read.parquet(f"{data}/documents.parquet"), {}
    for name, f in corpus_pipeline.STAGES:
        docs = cut(f(spark, docs, data), name)
        out[name] = docs
    return out


def _rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_schema_is_kept(stages, docs):
    for name, df in list(stages.items())[:-1]:
        assert df.columns == docs.columns, name


def test_quality_keeps_clean_documents(stages, docs, labels):
    kept, truth = _rows(stages["quality"]), {r.doc_id: r.quality for r in labels.collect()}
    assert kept.items() <= _rows(docs).items()
    good = [k for k, q in truth.items() if q == 1]
    bad = [k for k, q in truth.items() if q == 0]
    assert sum(k in kept for k in good) >= 0.97 * len(good) and sum(k in kept for k in bad) <= 0.2 * len(bad)


def test_one_document_of_each_group_stays(stages):
    """Groups by the rule of the stage: five-word shingle sets with a Jaccard similarity of 0.8 or more, directly or over others."""
    before, after = _rows(stages["quality"]), _rows(stages["near_dedup"])
    sets = {k: set(jaccard.shingle_set(t).tolist()) for k, t in before.items()}
    up = {k: k for k in before}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(before)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert set(after) == {k for k in ids if root(k) == k} and after.items() <= before.items()


def test_secrets_are_gone(stages):
    before, after = stages["near_dedup"], stages["secrets"]
    assert before.count() == after.count()
    assert secrets.scan(after).filter("n_access + n_hex > 0").count() == 0
    spans = {r.doc_id: r.spans for r in secrets.scan(before).collect()}
    old, new = _rows(before), _rows(after)
    assert {k for k in old if old[k] != new[k]} == {k for k, s in spans.items() if s}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_mix_and_packing_hold_all_words(stages):
    mixed, packed = stages["mixing"], stages["packing"]
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed.collect())
    whole = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in stages["secrets"].collect())
    assert abs(words - whole) <= 0.02 * whole
    assert packed.filter("piece = 0").count() == mixed.count()
    assert packed.filter("octet_length(ids) <> 4 * length or crc32(ids) <> ids_crc32").count() == 0


def test_repeated_and_nameless_documents(spark, hard_docs, data):
    df = hard_docs.select("doc_id", "text", "lang", "source", "n_chars")
    out = corpus_pipeline.near_dedup_stage(spark, df, data).collect()
    ids = sorted(r.doc_id for r in out if r.doc_id is not None)
    assert ids == sorted(set(ids)) and {6} <= set(ids) and 7 not in ids and len(out) - len(ids) == 2
    empty = df.limit(0)
    for name, f in corpus_pipeline.STAGES:
        got = f(spark, empty, data)
        assert got.count() == 0, name


def test_stages_take_hard_rows_with_clashing_columns(spark, hard_docs, data):
    """Each stage on nulls, repeats, very long texts and names that operators use inside; reruns agree."""
    rows = hard_docs.count()
    before = {"quality": rows, "near_dedup": None, "secrets": rows, "mixing": None}
    for name, f in corpus_pipeline.STAGES[:-1]:
        got = f(spark, hard_docs, data)
        assert got.columns == hard_docs.columns, name
        found = got.count()
        assert found <= rows if before[name] is None or name == "quality" else found == rows, name
    once, twice = (sorted(map(str, corpus_pipeline.near_dedup_stage(spark, hard_docs.repartition(n), data).collect())) for n in (1, 3))
    assert once == twice
    packed = corpus_pipeline.packing_stage(spark, hard_docs, data)
    assert packed.filter("piece = 0").count() == rows
