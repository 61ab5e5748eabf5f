"""From scores to normalised, ranked weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered


def _attached(rows: DataFrame, totals: DataFrame, per: Sequence[str]) -> DataFrame:
    """``rows`` with their totals: one row for all, or one for each value of ``per``."""
    return rows.join(totals, list(per)) if per else rows.crossJoin(F.broadcast(totals))


def _share(rows: DataFrame, raw: Column, per: Sequence[str] = ()) -> DataFrame:
    """WEIGHT: ``raw`` over its sum over all rows (of the same ``per``), by an aggregate rather than a window over everything."""
    rows = rows.withColumn("_raw", raw)
    total = rows.groupBy(*per).agg(F.sum("_raw").alias("_total"))
    return _attached(rows, total, per).withColumn("WEIGHT", F.coalesce(F.try_divide("_raw", "_total"), F.lit(0.0))).drop("_raw", "_total")


def _auc_total(rows: DataFrame, keys: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """The sum over groups of the mean AUC: one row, or one for each value of ``per``."""
    return rows.groupBy(*keys).agg(F.avg("AUC").alias("_a")).groupBy(*per).agg(F.sum("_a").alias("_auc"))


def weights_by_bad_and_auc(rows: DataFrame, keys: Sequence[str], bad_total: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """Share of bad units x share of AUC x importance, normalised.  ``bad_total`` is one row, or one for each value of ``per``, by which weights are normalised then."""
    full = _attached(_attached(rows, _auc_total(rows, keys, per), per), bad_total, per)
    raw = F.try_divide(F.col("BAD_NUM"), F.col("BAD_TOTAL")) * F.try_divide("AUC", "_auc") * F.col("IMPORTANCE")
    return _share(full, raw, per).drop("_auc", "BAD_TOTAL")


def weights_fdc(rows: DataFrame, keys: Sequence[str], bad_total: DataFrame) -> DataFrame:
    """As above; where the AUCs sum to nothing they are left out."""
    full = rows.crossJoin(F.broadcast(_auc_total(rows, keys))).crossJoin(F.broadcast(bad_total))
    bad = F.try_divide(F.col("BAD_NUM"), F.col("BAD_TOTAL"))
    raw = F.when(F.col("_auc") > 0, bad * F.col("AUC") / F.col("_auc") * F.col("IMPORTANCE")).otherwise(bad * F.col("IMPORTANCE"))
    return _share(full, raw).drop("_auc", "BAD_TOTAL")


def weights_auc_ratio(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of AUC x importance, normalised; importance alone where the AUCs sum to nothing."""
    full = rows.crossJoin(F.broadcast(_auc_total(rows, keys)))
    return _share(full, F.when(F.col("_auc") > 0, F.col("AUC") / F.col("_auc") * F.col("IMPORTANCE")).otherwise(F.col("IMPORTANCE"))).drop("_auc")


def weights_small(rows: DataFrame) -> DataFrame:
    return _share(rows, F.col("IMPORTANCE"))


def weights_positive_auc(rows: DataFrame, keys: Sequence[str], bad_total: DataFrame) -> DataFrame:
    """Early form: groups with an AUC above 0 only; importance alone if there are none."""
    some = rows.agg(F.coalesce(F.bool_or(F.col("AUC") > 0), F.lit(False)).alias("_some"))
    kept = rows.crossJoin(F.broadcast(some)).filter("AUC > 0 or not _some").drop("_some")
    return weights_fdc(kept.withColumn("AUC", F.greatest("AUC", F.lit(0.0))), keys, bad_total)


def positive_only(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Weights above 0, normalised anew, as percent and numbered from 1."""
    kept = _share(rows.filter("WEIGHT > 0").withColumnRenamed("WEIGHT", "_w"), F.col("_w")).drop("_w")
    return ranked(kept.withColumn("WEIGHT_PERCENT", F.col("WEIGHT") * 100), order)


def reliable(rows: DataFrame, least_auc: float) -> DataFrame:
    """Groups whose AUC is at least ``least_auc``."""
    return rows.filter(F.col("AUC") >= least_auc)


def top_share(rows: DataFrame, keys: Sequence[str], share: float = 0.6, tie: Sequence[str] = ("PARAMETRIC_NAME",)) -> DataFrame:
    """The int(share n) most important rows of each group; a group of one keeps it.  Rows without an importance, or with one below 0, go first."""
    w = Window.partitionBy(*keys)
    ranked = rows.filter("IMPORTANCE >= 0").withColumn("_n", F.count("*").over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.desc("IMPORTANCE"), *tie)))
    return ranked.filter(F.col("_r") <= F.when(F.col("_n") > 1, F.floor(F.col("_n") * share)).otherwise(1)).drop("_n", "_r")


def boost(results: DataFrame, scores: DataFrame, target: str = "WEIGHT") -> DataFrame:
    """``target`` times an outside score, 1 where there is none; a null step or tool matches a null one."""
    s = scores.select(F.col("PARAMETRIC_NAME").alias("_p"), F.col("OPE_NO").alias("_o"), F.col("EQP_NAME").alias("_e"), "SCORE")
    on = (F.col("PARAMETRIC_NAME") == F.col("_p")) & F.col("OPE_NO").eqNullSafe(F.col("_o")) & F.col("EQP_NAME").eqNullSafe(F.col("_e"))
    return results.join(s, on, "left").withColumn(target, F.col(target) * F.coalesce("SCORE", F.lit(1.0))).drop("_p", "_o", "_e", "SCORE")


def ranked(results: DataFrame, order: Sequence[Column | str], column: str = "INDEX_NO") -> DataFrame:
    """1..n in ``order``, by ranges."""
    return numbered(results, order, column)


def decorated(results: DataFrame, request_id: str) -> DataFrame:
    """Percent, request and rank."""
    rows = results.withColumn("WEIGHT_PERCENT", F.col("WEIGHT") * 100).withColumn("REQUEST_ID", F.lit(request_id))
    ties = [c for c in rows.columns if c not in ("WEIGHT", "WEIGHT_PERCENT", "REQUEST_ID")]
    return ranked(rows, [F.desc("WEIGHT"), *ties])
