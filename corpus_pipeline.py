"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a table; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferlens.llm import mixing, packing, quality, secrets, simhash
from waferlens.llm.common import cut


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on this input, does not reject.

    Null and empty texts are scored like any other; null ids, repeated rows and
    ties keep their rows or go alike; an empty table gives an empty one; other
    columns are kept whatever their names.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    packed = docs.select("doc_id", "text", "n_chars", F.struct(*docs.columns).alias("kept"))  # as one column, so that no name clashes
    return quality.score(packed, model, keep=("kept",)).filter(F.col("score") >= quality.THRESHOLD).select("kept.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Texts are near duplicates when five-word shingles give a Jaccard
    similarity of 0.8 or more, directly or over others.  Rows that share an
    id are one document, of which one row stays, the same on every run; rows
    without an id cannot be told apart by one and all stay.  Null and empty
    texts are alike and near copies of each other; very long ones are compared
    whole; an empty table gives an empty one; names may clash.
    """
    found = simhash.near_copies(docs).filter("doc_id is not null")
    ids = found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n"))
    # What to drop is written, so that its size is known when the join is planned.
    odd = cut(ids.filter("not stays or n > 1").select(F.col("doc_id").alias("odd_id"), "stays"), "odd")
    alone = docs.join(odd, docs["doc_id"] == odd["odd_id"], "left_anti")
    repeated = odd.filter("stays")
    rows = docs.join(repeated, docs["doc_id"] == repeated["odd_id"], "left_semi").select(F.col("doc_id").alias("_id"), F.struct(F.xxhash64("text"), F.octet_length("text"), F.xxhash64(*docs.columns)).alias("_order"), F.struct(*docs.columns).alias("_row"))
    return alone.unionByName(rows.groupBy("_id").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every reported secret replaced; ``n_chars`` follows the text.

    Null texts stay null, with the ``n_chars`` they came with; very long ones
    are redacted whole; repeated rows and null ids keep their rows; an empty
    table gives an empty one; other columns are kept whatever their names.
    """
    kind = docs.schema["n_chars"].dataType
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: sources at their target shares, documents left out, cut at a block or repeated as the quotas say.

    A null source is a source of its own; documents without words add nothing
    and are left out; repeated rows count one by one, null ids too; an empty
    table gives an empty one.
    """
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids, sequences and places.

    Null and empty texts give a piece with the end id alone; very long ones
    are cut; repeated rows and null ids are packed one by one; an empty table
    gives an empty one; other columns are ignored whatever their names.
    """
    return packing.pack_documents(docs, with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Learned scores, hash fingerprints and packing have no SQL form; the tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
