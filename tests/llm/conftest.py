import pytest

#: Names that operators use inside.
CLASHES = ("id", "body", "h", "bucket", "fp", "u", "v", "n", "node", "rank", "size", "shard", "spans", "parts", "copies", "text_key", "score", "label", "_id", "_key", "words", "order1", "component", "head")


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing names."""
    long_text = "The quick brown fox; " * 15_000
    rows = [
        (1, "plain words here and there", "en", "a", 26), (2, None, None, None, None), (3, "", "en", "b", 0), (4, " \n\t ", "de", "b", 4), (5, long_text, "en", "a", len(long_text)),
        (6, "same text twice", "en", "b", 15), (6, "same text twice", "en", "b", 15), (7, "same text twice", "fr", None, 15), (None, "no id at all", "en", "a", 12), (None, None, None, None, None),
        (8, 'token = "abcdef123456" É \U0001f600 Licensed under the MIT License', "en", "a", 60), (9, "password: abc", "en", "b", 13), (10, "x", "en", "c", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, data):
    return spark.read.parquet(f"{data}/labels.parquet")
