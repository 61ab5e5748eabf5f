"""The pipeline's near-duplicate stage against brute-force Jaccard similarity."""

import random

import numpy as np

import corpus_pipeline
from waferlens.llm import jaccard


def _expected(texts):
    sets = {k: jaccard.shingle_set(t) for k, t in texts.items()}
    ids = sorted(texts)
    up = {k: k for k in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            if 5 * len(x & y) >= 4 * len(x | y):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {k for k in ids if root(k) == k}


def _stage(spark, data, texts):
    df = spark.createDataFrame([(k, t, "en", "a", len(t or "")) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    return [r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, df, data).collect()]


def test_stage_drops_all_near_copies(spark, data, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = _stage(spark, data, texts)
    assert sorted(got) == sorted(_expected(texts)) and 1 in got and 177 not in got


def test_near_copies_around_the_bound(spark, data):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    texts = {}
    for group in range(12):
        base = rng.choices(words, k=120)
        for copy in range(8):
            own = list(base)
            for _ in range(copy // 2):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts[100 * group + copy] = " ".join(own[: len(own) - rng.randrange(25)])
    # One group far larger than the rest, texts without words and short ones.
    base = rng.choices(words, k=60)
    for copy in range(60):
        own = list(base)
        own[rng.randrange(60)] = f"x{copy}"
        texts[5000 + copy] = " ".join(own)
    texts |= {9001: "", 9002: None, 9003: " \n", 9004: "two words", 9005: "Two  words", 9006: "two words more"}
    got = _stage(spark, data, texts)
    want = _expected(texts)
    assert sorted(got) == sorted(want) and 20 < len(want) < len(texts) - 60


def test_bound_is_met_exactly():
    a = np.arange(9, dtype=np.uint64)
    assert jaccard.similar(a, a[:8]) and jaccard.similar(np.arange(10, dtype=np.uint64), a[:8]) and not jaccard.similar(np.arange(11, dtype=np.uint64), a[:8])
