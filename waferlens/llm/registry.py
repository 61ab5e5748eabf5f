"""Queries of the corpus operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, fingerprints, itq, licenses, mixing, packing, quality, rules, secrets, simhash, spelling, tokenstore, toxicity


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/labels.parquet")


def op1_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan(_docs(spark, d))


def op2_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return itq.near_duplicates(spark.read.parquet(f"{d}/embeddings.parquet"))


def op3_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(_docs(spark, d))


def op4_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, d))


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.classify(_docs(spark, d), _labels(spark, d))


def op6_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, d))


def op7_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.classify(_docs(spark, d), _labels(spark, d))


def op8_source_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sizes(_docs(spark, d))


def op9_token_store(spark: SparkSession, d: str) -> DataFrame:
    return tokenstore.store_round_trip(_docs(spark, d))


def op10_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_docs(spark, d))


def op11_centroids(spark: SparkSession, d: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{d}/embeddings.parquet"))


def op12_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.judge(_docs(spark, d))


def op13_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.variants(_docs(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_embedding_near_dedup, op3_license_scan, op4_best_fit_packing, op5_toxicity, op6_simhash_near_dedup, op7_quality, op8_source_mix, op9_token_store, op10_fingerprints, op11_centroids, op12_quality_rules, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": secrets.oracle(), "op3_license_scan": licenses.oracle(), "op8_source_mix": mixing.oracle(), "op11_centroids": centroids.oracle(), "op12_quality_rules": rules.oracle()}
