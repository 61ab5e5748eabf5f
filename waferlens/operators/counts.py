"""Good and bad units per group, the universe of scored parameters, and tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def commonality(df: DataFrame, keys: Sequence[str], labelled: bool = True) -> DataFrame:
    """Distinct units per group: GOOD_NUM and BAD_NUM, or GOOD_NUM alone without labels.

    Units are made distinct first, so each shuffled row is one unit of a
    group and no set of units is built per group.
    """
    if not labelled:
        return df.filter("WAFER_ID is not null").select(*keys, "WAFER_ID").distinct().groupBy(*keys).agg(F.count("*").alias("GOOD_NUM"))
    units = df.filter("WAFER_ID is not null").select(*keys, "WAFER_ID", "label").distinct()
    return units.groupBy(*keys).agg(*sizes())


def sizes() -> list[Column]:
    """GOOD_NUM and BAD_NUM of rows that are one unit each."""
    return [F.count(F.when(F.col("label") == c, 1)).alias(n) for c, n in enumerate(("GOOD_NUM", "BAD_NUM"))]


def universe(df: DataFrame, keys: Sequence[str], stats: bool = False, measured_only: bool = True, labelled: bool = True) -> DataFrame:
    """Every parameter (and statistic) of every group with its units."""
    rows = df.filter("RESULT is not null") if measured_only else df
    return commonality(rows, [*keys, "PARAMETRIC_NAME", *(["STATS"] if stats else [])], labelled)


def fixed_universe(df: DataFrame, keys: Sequence[str], parameters: Sequence[str]) -> DataFrame:
    """The same parameters for every group."""
    return commonality(df, keys).withColumn("PARAMETRIC_NAME", F.explode(F.array(*map(F.lit, parameters))))


def enough_bad(rows: DataFrame, least: int = 2) -> DataFrame:
    """``rows``; a query over them fails where fewer than ``least`` different bad units are among them."""
    total = bad_total(rows)
    message = F.concat(F.lit("too few bad units: "), F.col("BAD_TOTAL").cast("string"))
    checked = total.select(F.when(F.col("BAD_TOTAL") >= least, 1).otherwise(F.raise_error(message)).alias("_enough"))
    return rows.crossJoin(F.broadcast(checked)).filter("_enough = 1").drop("_enough")


def bad_total(df: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """One row, or one for each value of ``per`` that has a bad unit."""
    return df.filter("label = 1").groupBy(*per).agg(F.count_distinct("WAFER_ID").alias("BAD_TOTAL"))


def tier(good: str = "GOOD_NUM", bad: str = "BAD_NUM", least: int = 3) -> Column:
    """big: both classes at least ``least``; small: both at all; else none."""
    g, b = F.col(good), F.col(bad)
    return F.when((g >= least) & (b >= least), "big").when((g > 0) & (b > 0), "small").otherwise("none")


def tiers(counts: DataFrame) -> DataFrame:
    return counts.withColumn("TIER", tier())


def tiers_strict(counts: DataFrame) -> DataFrame:
    """big: both over 3; where any group is big, small ones count as none."""
    g, b = F.col("GOOD_NUM"), F.col("BAD_NUM")
    raw = F.when((g > 3) & (b > 3), "big").when((g >= 1) & (b >= 1), "small").otherwise("none")
    rows = counts.withColumn("_t", raw)
    any_big = rows.agg(F.coalesce(F.bool_or(F.col("_t") == "big"), F.lit(False)).alias("_any"))  # one row
    return rows.crossJoin(F.broadcast(any_big)).select(*counts.columns, F.when(F.col("_any") & (F.col("_t") == "small"), "none").otherwise(F.col("_t")).alias("TIER"))


def tiers_early(counts: DataFrame) -> DataFrame:
    """big: both at least 3; small: a bad unit and two units at all."""
    g, b = F.col("GOOD_NUM"), F.col("BAD_NUM")
    return counts.withColumn("TIER", F.when((g >= 3) & (b >= 3), "big").when((b >= 1) & (g + b >= 2), "small").otherwise("none"))


def screen(counts: DataFrame) -> DataFrame:
    """Groups with over one bad and over two units; a single group passes as it is."""
    total = counts.agg(F.count("*").alias("_n"))  # one row
    rows = counts.crossJoin(F.broadcast(total))
    return rows.filter((F.col("_n") == 1) | ((F.col("BAD_NUM") > 1) & (F.col("GOOD_NUM") + F.col("BAD_NUM") > 2))).drop("_n")
