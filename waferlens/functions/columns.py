"""Cleaning and scalar expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number(column: str) -> Column:
    """The value as a double; text that is none, and NaN, become null."""
    value = F.expr(f"try_cast(`{column}` AS DOUBLE)")
    return F.when(~F.isnan(value), value)


def merged(column: Column, rules: Sequence[Sequence[str]], sep: str = ",") -> Column:
    """Any value of a rule becomes the rule's values joined; later rules see what earlier ones made."""
    for values in rules:
        column = F.when(column.isin(*values), F.lit(sep.join(values))).otherwise(column)
    return column


def merge_columns(df: DataFrame, rules: Mapping[str, Sequence[Sequence[str]]], strict: bool = False, sep: str = ",") -> DataFrame:
    """Merge rules by column; a column that is not there is skipped, or an error if ``strict``."""
    for name, own in rules.items():
        if name not in df.columns:
            if strict:
                raise ValueError(f"no column {name}")
            continue
        df = df.withColumn(name, merged(F.col(name), own, sep))
    return df


def item(column: str, at: int, sep: str = "#") -> Column:
    """The n-th part of a compound name; null where there is none."""
    return F.get(F.split(column, sep), F.lit(at))


def row_mean(columns: Sequence[str]) -> Column:
    """Mean over columns of what is neither null nor NaN; null if nothing is."""
    good = F.filter(F.array(*columns), lambda x: x.isNotNull() & ~F.isnan(x))
    return F.try_divide(F.aggregate(good, F.lit(0.0), lambda a, x: a + x), F.size(good).cast("double"))


def vector_stats(values: Column) -> dict[str, Column]:
    """Statistics of an array of doubles without nulls; deviation of one value is 0, everything null without any."""
    n = F.size(values)
    some = F.when(n > 0, values)
    mean = F.aggregate(some, F.lit(0.0), lambda a, x: a + x) / n
    squares = F.aggregate(F.transform(some, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x)
    ordered = F.array_sort(some)

    def quantile(q: float) -> Column:
        at = (n - 1) * F.lit(q)
        low = F.floor(at).cast("int")
        a, b = F.get(ordered, low), F.get(ordered, F.least(low + 1, n - 1))
        return a + (b - a) * (at - low)

    return {
        "MAX_VAL": F.array_max(some), "MIN_VAL": F.array_min(some), "MEDIAN": quantile(0.5), "AVERAGE": mean,
        "STD_DEV": F.when(n > 1, F.sqrt(squares / (n - 1))).when(n == 1, F.lit(0.0)), "PERCENTILE_25": quantile(0.25), "PERCENTILE_75": quantile(0.75),
    }


def site_array(columns: Sequence[str]) -> Column:
    """Values of the sites that have one."""
    return F.filter(F.array(*columns), lambda x: x.isNotNull() & ~F.isnan(x))


def wafer_id(foup: str, slot: str) -> Column:
    """Lot part and two-digit slot."""
    return F.concat(F.substring(foup, 1, 6), F.lit("-"), F.lpad(F.col(slot).cast("string"), 2, "0"))


def wafer_id_by_form(wafer: str, lot: str) -> Column:
    """One id form of three ways to write it; null for any other."""
    w, head = F.col(wafer), F.substring(lot, 1, 6)
    return (
        F.when(w.rlike("^[@#][0-9]{2}$"), F.concat(head, F.lit("-"), F.substring(wafer, 2, 2)))
        .when(w.rlike("^[0-9]{2}$"), F.concat(head, F.lit("-"), F.substring(wafer, 1, 2)))
        .when((F.length(w) == 9) & (head == F.substring(wafer, 1, 6)) & (F.substring(wafer, 7, 1) == "-"), w)
    )


def step_name(column: str) -> Column:
    return F.replace(F.upper(column), F.lit("_"), F.lit("+"))


def to_second(column: str) -> Column:
    """The time without its fraction of a second."""
    return F.date_trunc("second", column)


def minutes(seconds: str) -> Column:
    return F.round(F.col(seconds) / 60, 2)


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly these columns and types; what is missing is null."""
    return df.select(*[(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in schema.items()])
