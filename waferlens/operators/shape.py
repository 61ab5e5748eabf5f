"""Reshaping of measurement tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import row_mean, site_array, vector_stats


def latest_run(df: DataFrame, keys: Sequence[str] = ("WAFER_ID", "OPE_NO", "CHAMBER_ID"), run: str = "RUN_ID") -> DataFrame:
    """Distinct rows of each key's highest run; rows with a null key or run go."""
    return last_runs(df, keys, run).distinct()


def last_runs(df: DataFrame, keys: Sequence[str] = ("WAFER_ID", "OPE_NO", "CHAMBER_ID"), run: str = "RUN_ID") -> DataFrame:
    """Rows of each key's highest run, equal ones too; rows with a null key or run go."""
    whole = Window.partitionBy(*keys)
    known = df.na.drop(subset=[*keys, run])
    return known.withColumn("_last", F.max(run).over(whole)).filter(F.col(run) == F.col("_last")).drop("_last")


def parameters_apart(df: DataFrame, parameters: Mapping[str, str]) -> DataFrame:
    """Wide facts, with a column for each parameter (name: column), as a row per parameter."""
    fixed = [c for c in df.columns if c not in parameters.values()]
    return df.select(*fixed, F.inline(F.array(*[F.struct(F.lit(n).alias("PARAMETRIC_NAME"), F.col(c).cast("double").alias("RESULT")) for n, c in parameters.items()])))


def distinct_sums(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rows that differ in ``values`` only become one: of each the sum of its distinct values, and their number (``value#n``).

    It counts what would be distinct in a table with a row per value.
    """
    fixed = [c for c in df.columns if c not in values]
    # -0.0 + 0.0 is 0.0, as it is for DISTINCT.
    sets = df.groupBy(*fixed).agg(*[F.collect_set(F.col(v).cast("double") + 0.0).alias(v) for v in values])

    def total(v: str) -> Column:
        whole = F.aggregate(F.array_sort(v), F.lit(0.0), lambda s, x: s + x)
        return F.when(F.size(v) < 2, F.get(v, F.lit(0))).otherwise(whole)

    return sets.select(*fixed, *[c for v in values for c in (total(v).alias(v), F.size(v).alias(f"{v}#n"))])


def summed_means(df: DataFrame, keys: Sequence[str], values: Sequence[str], *more: Column) -> DataFrame:
    """Means of ``distinct_sums`` rows per ``keys``, null where there is no value, and the aggregates ``more``."""
    sums = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for v in values for c in (v, f"{v}#n")], *more)
    means = {v: F.when(F.col(f"{v}#n") > 0, F.col(v) / F.col(f"{v}#n")) for v in values}
    return sums.withColumns(means).drop(*[f"{v}#n" for v in values])


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should leave no ties."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def unpivot_stats(df: DataFrame, ids: Sequence[str], stats: Sequence[str], gaps: bool = False) -> DataFrame:
    """One row per statistic that is there; with ``gaps`` also of those that are not."""
    # By a generator: how rows are dealt over tasks stays known, unlike after unpivot, so keys among ``ids`` need no other exchange.
    kind = {df.schema[s].dataType for s in stats}
    values = [F.col(s) if len(kind) == 1 else F.col(s).cast("double") for s in stats]
    rows = df.select(*ids, F.inline(F.array(*[F.struct(F.lit(s).alias("STATS"), v.alias("RESULT")) for s, v in zip(stats, values, strict=True)])))
    return rows if gaps else rows.filter("RESULT is not null")


def fill_statistics(long: DataFrame, keys: Sequence[str], share: float = 0.7) -> DataFrame:
    """Statistics that lack more than ``share`` of a group's rows go; gaps of the others take the statistic's mean in the group."""
    by = [*keys, "STATS"]
    found = long.groupBy(*by).agg(F.avg(F.col("RESULT").isNull().cast("double")).alias("_share"), F.avg("RESULT").alias("_mean"))
    kept = found.filter(F.col("_share") <= share).drop("_share")
    return long.join(kept, by).withColumn("RESULT", F.coalesce("RESULT", "_mean")).drop("_mean").select(*long.columns)


def site_statistics(df: DataFrame, ids: Sequence[str], sites: Sequence[str]) -> DataFrame:
    rows = df.select(*ids, site_array(sites).alias("_v"))
    return rows.select(*ids, *[c.alias(n) for n, c in vector_stats(F.col("_v")).items()])


def site_features(df: DataFrame, ids: Sequence[str], good: Sequence[str], bad: Sequence[str], gaps: bool = False) -> DataFrame:
    """Each row becomes two: statistics of its good sites (label 0) and of its bad ones (label 1), long; one scan."""
    sides = F.inline(F.array(*[F.struct(F.lit(n).alias("label"), site_array(c).alias("_v")) for n, c in enumerate((good, bad))]))
    rows = df.select(*ids, sides)
    wide = rows.select(*ids, "label", *[c.alias(n) for n, c in vector_stats(F.col("_v")).items()])
    return unpivot_stats(wide, [*ids, "label"], list(vector_stats(F.lit(None))), gaps)


def zone_features(df: DataFrame, ids: Sequence[str], zones: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Statistics per zone with the zone's label.  At least two labels, no empty zone and no shared site are asked for."""
    used = [s for z in zones.values() for own in z.values() for s in own]
    if len(zones) < 2 or not all(own for z in zones.values() for own in z.values()) or len(used) != len(set(used)):
        raise ValueError("name two labels or more, zones that have sites, and each site once")
    parts = [F.struct(F.lit(label).alias("LABEL"), F.lit(zone).alias("ZONE"), site_array(own).alias("_v")) for label, z in zones.items() for zone, own in z.items()]
    rows = df.select(*ids, F.inline(F.array(*parts)))
    return rows.select(*ids, "LABEL", "ZONE", *[c.alias(n) for n, c in vector_stats(F.col("_v")).items()])


def zone_means(df: DataFrame, ids: Sequence[str], zones: Mapping[str, Sequence[str]]) -> DataFrame:
    """A column per zone: the mean of its sites that have a value."""
    return df.select(*ids, *[row_mean(own).alias(zone) for zone, own in zones.items()])


def fill_sites(df: DataFrame, sites: Sequence[str], by: str = "AVERAGE") -> DataFrame:
    return df.withColumns({s: F.coalesce(s, by) for s in sites})


def pivot_first(df: DataFrame, key: str, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Names become columns; of repeated ones the least value, so that the result is the same on every run."""
    return df.groupBy(key).pivot(name, list(names)).agg(F.min(value))


def missing_rows(universe: DataFrame, scored: DataFrame, keys: Sequence[str], value: str = "WEIGHT") -> DataFrame:
    """Scores for the whole universe; 0 where there is none."""
    return universe.join(scored.select(*keys, value), list(keys), "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def sparse_columns(df: DataFrame, columns: Sequence[str], share: float = 0.7) -> DataFrame:
    """One row: the share of nulls and the mean of each column, by which to drop or fill it."""
    return df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_share") for c in columns], *[F.avg(c).alias(f"{c}_mean") for c in columns])


def fill_or_drop(df: DataFrame, columns: Sequence[str], share: float = 0.7) -> DataFrame:
    """Columns with more nulls than ``share`` go, the others' nulls become the column's mean (a one-row aggregate decides)."""
    row = sparse_columns(df, columns, share).first()
    keep = [c for c in columns if row[f"{c}_share"] is not None and row[f"{c}_share"] <= share]
    rest = [c for c in df.columns if c not in columns or c in keep]
    return df.select(*rest).na.fill({c: row[f"{c}_mean"] for c in keep if row[f"{c}_mean"] is not None})
