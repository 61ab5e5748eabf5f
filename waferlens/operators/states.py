"""Stored statistics that can be merged: of several days, runs or products, without reading samples again.

A state is a row of count, mean, sum of squared deviations, extremes, first
time and a quantile sketch.  States merge in any order and grouping, and what
they merge to is a state.  Null and NaN values are not counted; a group of them
alone has no state.  Quantiles have a small rank error (under 1 % at the
default size); the other columns are exact up to rounding.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import Sink

QUANTILES = {"PERCENTILE_25": 0.25, "MEDIAN": 0.5, "PERCENTILE_75": 0.75}
#: A sketch's size: more is more exact.  It bounds a state to a few kilobytes whatever it has seen.
SKETCH_SIZE = 400


def states(samples: DataFrame, keys: Sequence[str], value: str = "VAL", time: str = "TIME_STAMP", size: int = SKETCH_SIZE) -> DataFrame:
    """A state per ``keys``, made map-side before the shuffle."""
    v = F.col(value).cast("double")
    return samples.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*keys).agg(
        F.count(v).alias("N"), F.avg(v).alias("MEAN"), (F.var_pop(v) * F.count(v)).alias("M2"), F.min(v).alias("MIN_VAL"), F.max(v).alias("MAX_VAL"), F.min(time).alias("START_TIME"),
        F.kll_sketch_agg_double(v, F.lit(size)).alias("SKETCH"),
    )


def merged(parts: DataFrame, keys: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """One state per ``keys``, null ones too, of the states in ``parts``.

    Deviations are taken about the merged mean (from counts and means alone),
    so that no large squares cancel; sketches merge map-side first.
    """
    rows = parts.withColumn("_k", F.struct(F.lit(0), *keys))  # a struct, so that null keys meet
    group = Window.partitionBy("_k")
    means = rows.select("_k", "N", "MEAN").withColumn("_m", F.sum(F.col("N") * F.col("MEAN")).over(group) / F.sum("N").over(group))
    between = means.groupBy("_k").agg(F.first("_m").alias("MEAN"), F.sum(F.col("N") * (F.col("MEAN") - F.col("_m")) * (F.col("MEAN") - F.col("_m"))).alias("_between"))
    got = rows.groupBy("_k").agg(
        F.sum("N").alias("N"), F.sum("M2").alias("_within"), F.min("MIN_VAL").alias("MIN_VAL"), F.max("MAX_VAL").alias("MAX_VAL"), F.min("START_TIME").alias("START_TIME"),
        F.kll_merge_agg_double("SKETCH", F.lit(size)).alias("SKETCH"),
    )
    both = got.join(between, "_k")
    return both.select(*[F.col(f"_k.{k}") for k in keys], "N", "MEAN", (F.col("_within") + F.col("_between")).alias("M2"), "MIN_VAL", "MAX_VAL", "START_TIME", "SKETCH")


def features(parts: DataFrame, keys: Sequence[str], population: bool = True) -> DataFrame:
    """The run statistics that states stand for."""
    spread = F.sqrt(F.try_divide(F.col("M2"), F.col("N") if population else F.col("N") - 1))
    at = F.kll_sketch_get_quantile_double("SKETCH", F.array(*map(F.lit, QUANTILES.values())))
    rows = parts.withColumn("_q", at)
    quantiles = [F.col("_q")[i].alias(n) for i, n in enumerate(QUANTILES)]
    return rows.select(*keys, "N", "START_TIME", F.col("MEAN").alias("AVERAGE"), spread.alias("STD_VAL"), "MIN_VAL", *quantiles, "MAX_VAL", (F.col("MAX_VAL") - F.col("MIN_VAL")).alias("RANGE1"))


@dataclass(frozen=True)
class StateTable:
    """States of ``keys`` by DAY in a shared folder; days are loaded one by one or many at once, and again without harm."""

    path: str
    keys: tuple[str, ...]

    def load(self, samples: DataFrame, value: str = "VAL", time: str = "TIME_STAMP") -> None:
        """Replace the days that ``samples`` has rows of; each must be whole there.  Days without a row in it stay as they are."""
        rows = samples.withColumn("DAY", F.date_format(time, "yyyy-MM-dd"))
        # Small days share a task, large ones are split.
        Sink(self.path).replace_slices(states(rows, ["DAY", *self.keys], value, time).hint("rebalance", "DAY"), "DAY")

    def read(self, spark: SparkSession, start: str | None = None, end: str | None = None) -> DataFrame:
        """States of the days in [start, end), from their folders alone; DAY is a date.  A table that nothing was loaded into is an error."""
        rows = spark.read.parquet(self.path)
        if start is not None:
            rows = rows.filter(F.col("DAY") >= F.lit(start).cast("date"))
        return rows if end is None else rows.filter(F.col("DAY") < F.lit(end).cast("date"))
