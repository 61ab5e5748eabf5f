from compare import same
from pyspark.sql import functions as F

from waferlens.llm import registry, rules

SENTENCE = "The mill of the old town is near to the river and it was closed for years"


def _plain_repeats(text):
    words = text.split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})


def test_query_equals_sql(spark, data, duck):
    same(registry.op12_quality_rules(spark, data).toPandas(), duck.execute(rules.oracle()).df())


def test_one_projection_without_user_functions(spark, data):
    plan = registry.op12_quality_rules(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Generate" not in plan and plan.count("regexp_extract_all") == 1


def test_good_documents_stay_and_bad_ones_go(spark, data, labels):
    found = registry.op12_quality_rules(spark, data).join(labels, "doc_id").filter("quality is not null and not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in found.collect()}
    assert kept[1] >= 0.98 and kept.get(0, 0.0) <= 0.1


def test_repeated_words(spark):
    texts = ["a b c d e", "a b c d e a b c d e", "x a b c d e y a b c d e f a b c d e", "a " * 40, "a b c d", "1 2 3 4 5 6 7 1 2 3 4 5 6 9 2 3 4 5 6 7", "p q r s t u v w"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.n_repeat_words for r in rules.judge(df).collect()}
    assert found == {i: _plain_repeats(t) for i, t in enumerate(texts)}


def test_each_rule_fires_alone(spark):
    bad = {
        "few_words": "only four words here", "repeated_words": SENTENCE + " " + SENTENCE, "short_words": " ".join("abcdefghijklmnop"), "long_words": " ".join(f"{'the' if k else ''}{chr(97 + k) * 30}" for k in range(12)),
        "symbols": SENTENCE.replace(" ", " * ", 9), "shouting": SENTENCE.replace(" ", "! "), "capitals": SENTENCE.upper(), "letters": " ".join(f"10{k}7" for k in range(20)) + " the old mill",
        "stop_words": " ".join(f"{a}{b}{a}rk" for a in "bcdfghjk" for b in "aeioubdx"), "duplicate_lines": "\n".join(["mill"] * 5 + [SENTENCE]), "list_lines": "\n".join(f"- {w} the" for w in SENTENCE.split()), "cut_lines": "\n".join(f"{w} and..." for w in SENTENCE.split()[:9]),
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(bad.values())], "doc_id long, text string")
    found = {r.doc_id: r.failed.split(",") for r in rules.judge(df).collect()}
    assert all(name in found[i] for i, name in enumerate(bad)), found
    assert set(bad) == {r.name for r in (*rules.BASE_RULES, *rules.RULES)}
    assert rules.judge(spark.createDataFrame([(1, SENTENCE)], "doc_id long, text string")).first().kept


def test_hard_rows_and_empty(spark, hard_docs, no_docs):
    found = rules.judge(hard_docs).collect()
    assert len(found) == hard_docs.count() and rules.judge(no_docs).collect() == []
    for r in found:
        if r.doc_id in (2, 3, 4):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (0, 0, 0, 0, 0, True, False)
        if r.doc_id == 5:
            assert r.n_words == 60_000 and r.n_repeat_words == 60_000 and not r.kept
