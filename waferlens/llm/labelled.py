"""Bounded samples of labelled documents, and the fixed held-out folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, rows: int, id_col: str = "doc_id", columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """At most ``rows`` documents with a 0/1 label outside the held-out fold, the same ones on every run.

    Ids labelled both ways are left out; of repeated ids one row is taken.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & (fold("_id", parts) != held_out))
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
        .filter("_label = _most")
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
        .select("_id", "_label")
    )
    # At most ``rows`` ids and labels: the bound of the broadcast.
    found = docs.select(F.col(id_col).alias("_id"), *columns).join(F.broadcast(known), "_id")
    return found.groupBy("_id", "_label").agg(F.min(F.struct(*columns)).alias("_row")).select("_id", F.col("_label").alias("label"), "_row.*")
