"""Row filters as columns: never concatenated into SQL text, so pushed down and free of quoting faults."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyword(column: str, values: Sequence[str] | None) -> Column:
    """Any of the values; ``*`` is a wild card; no values means no restriction."""
    if not values:
        return F.lit(True)
    wild = [v for v in values if "*" in v]
    exact = [v for v in values if "*" not in v]
    parts = [F.col(column).like(v.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")) for v in wild]
    return reduce(or_, [*parts, *([F.col(column).isin(*exact)] if exact else [])])


def time_range(column: str, start: str | None = None, end: str | None = None, closed: bool = False) -> Column:
    """From ``start`` on and before ``end`` (up to it if ``closed``); either may be open."""
    c, parts = F.col(column), []
    if start:
        parts.append(c >= F.lit(start).cast("timestamp"))
    if end:
        parts.append(c <= F.lit(end).cast("timestamp") if closed else c < F.lit(end).cast("timestamp"))
    return reduce(and_, parts, F.lit(True))


def widened_range(column: str, start: str, end: str, before: int = 0, after: int = 0) -> Column:
    """From ``before`` hours before ``start`` on, and before ``after`` hours after ``end``; the bounds are constants, so the filter still reaches the scan."""
    lower = F.lit(start).cast("timestamp") - F.make_dt_interval(hours=F.lit(before))
    upper = F.lit(end).cast("timestamp") + F.make_dt_interval(hours=F.lit(after))
    return (F.col(column) >= lower) & (F.col(column) < upper)


def all_of(parts: Iterable[Column]) -> Column:
    return reduce(and_, parts, F.lit(True))


def any_of(parts: Iterable[Column]) -> Column:
    return reduce(or_, parts)


def excludes(column: str, words: Sequence[str]) -> Column:
    """No word occurs in the value; null values do not pass."""
    return ~F.col(column).rlike("|".join(words))


def named(column: str) -> Column:
    """Neither null, empty nor 'NA'."""
    return F.col(column).isNotNull() & ~F.col(column).isin("", "NA")


def label_from_config(column: str = "LABEL") -> Column:
    return F.when(F.col(column) == "GOOD", 0).otherwise(1)


def label_from_flag(column: str = "GB_FLAG") -> Column:
    return F.when(F.col(column) == "good", 0).otherwise(1)


def label_from_lists(column: str, good: Sequence[str] = (), bad: Sequence[str] = ()) -> Column:
    """0 for good, 1 for bad values (wild cards allowed), null for neither; with one list only the rest has the other label."""
    if not good and not bad:
        raise ValueError("name good values, bad values or both")
    if not bad:
        return F.when(keyword(column, good), 0).otherwise(1)
    if not good:
        return F.when(keyword(column, bad), 1).otherwise(0)
    return F.when(keyword(column, good), 0).when(keyword(column, bad), 1)


def drop_sparse(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """Rows with at least int(share * n) values that are there; a share of 0 drops only rows without any."""
    return df.na.drop(thresh=max(1, int(share * len(columns))), subset=list(columns))


def in_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the groups: a semi-join, whatever the number of groups."""
    return df.join(groups.select(*keys).distinct(), list(keys), "left_semi")


def with_mapping(df: DataFrame, mapping: DataFrame, column: str, item_types: Sequence[int], exists: bool = True) -> DataFrame:
    """Rows whose value the mapping has (or has not) under these item types.  The mapping has a row per parameter; by a shuffle all facts of a parameter would meet in one task."""
    of = mapping.filter(F.col("ITEM_TYPE").isin(*item_types)).select(column).distinct()
    return df.join(F.broadcast(of), column, "left_semi" if exists else "left_anti")
