import random

from plain_spelling import variants, vocabulary
from pyspark.sql import functions as F

from waferlens.llm import registry, spelling


def _found(df):
    rows = df.collect()
    found = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_plain_search(spark, data, docs):
    expected = variants(vocabulary([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert _found(registry.op13_spelling_variants(spark, data)) == expected and any(v[2] for v in expected.values())


def test_dense_words_equal_plain_search(spark):
    """Two letters and lengths of 7 to 9: runs of equal letters, every node with two children, most words with many near ones."""
    rng = random.Random(5)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))): rng.choice([2, 3, 25, 300, 4000]) for _ in range(300)}
    words |= {"a" * k: 10**k for k in range(7, 12)} | {"é" + "a" * k: 7 for k in range(7, 10)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    near = {r.word: (r.n_near, r.best.w) for r in spelling.near_words(df).collect()}
    expected = variants(words)
    assert {w: near.get(w, (0, None))[0] for w in words} == {w: v[1] for w, v in expected.items()}
    assert all(near[w][1] == v[2] for w, v in expected.items() if v[2])


def test_pairs_are_found_once(spark):
    words = spark.createDataFrame([(w, 2) for w in ("aabbccdd", "aabbcdd", "abbccdd", "aabbccd", "aabbccddd", "xabbccdd")], "word string, n long")
    targets, siblings = spelling.merged(words, spelling.heavy_paths(words))
    known = targets.join(words.select(F.col("word").alias("target")), "target")
    assert known.groupBy(F.least("word", "target").alias("u"), F.greatest("word", "target").alias("v")).count().filter("count > 1").isEmpty()


def test_variants_of_a_word_stay_few(spark):
    """A word passes at most log2(words) light edges, however long it is."""
    words = spark.createDataFrame([("p" * 400 + f"{k:07b}".replace("0", "a").replace("1", "b"), 2) for k in range(128)], "word string, n long")
    targets, siblings = spelling.merged(words, spelling.heavy_paths(words))
    assert targets.count() <= 3 * 7 * 128 and siblings.count() <= 7 * 128


def test_forms_are_followed_to_the_root(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(9)] + [("x", "w3")]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert found == {w: "w9" for w, _ in chain}


def test_hard_rows_hot_prefix_and_empty(spark, hard_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in hard_docs.select("doc_id", "text").collect()]
    assert _found(spelling.variants(hard_docs)) == variants(vocabulary(rows))
    assert spelling.variants(no_docs).collect() == []
    texts = [(1, "Überlang überlang ÜBERLANG überlanx " * 3), (1, "Überlang überlang ÜBERLANG überlanx " * 3), (2, " ".join(f"prefix{chr(97 + k % 26)}{chr(97 + k // 26)} " * 2 for k in range(600)))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").select("*", F.lit("clash").alias("word"), F.lit("clash").alias("n"), F.lit("clash").alias("_run"))
    assert _found(spelling.variants(docs)) == variants(vocabulary(texts))
