"""Run data: unpivoting, de-duplication, features, tool trees and defect maps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import step_name, wafer_id_by_form
from ..operators import states


def day_range(start: str | None = None, end: str | None = None, now: datetime | None = None) -> tuple[datetime, datetime]:
    """From ``start`` (yyyymmdd) on, before the day after ``end``; either is yesterday where it is missing or faulty, and a range does not reach past ``now``'s midnight."""
    now = now or datetime.now()
    today = now.replace(hour=0, minute=0, second=0, microsecond=0)

    def day(text: str | None) -> datetime:
        try:
            return datetime.strptime(text or "", "%Y%m%d")
        except ValueError:
            return today - timedelta(days=1)

    after = day(end) + timedelta(days=1)
    return day(start), after if after <= now else today


def by_day(rows: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows of [start, end) with their DAY: all days are one job, each a key to group or partition by."""
    inside = (F.col(column) >= F.lit(str(start)).cast("timestamp")) & (F.col(column) < F.lit(str(end)).cast("timestamp"))
    return rows.filter(inside).withColumn("DAY", F.to_date(column))


def unpivot_runs(runs: DataFrame, variables: Sequence[str], step: str | None = "STEP") -> DataFrame:
    """One row per sample and variable that has a value; STEP is the run's step, or ALL_RUN."""
    name = step_name(step) if step else F.lit("ALL_RUN")
    rows = runs.select("TOOL_ID", "RUN_ID", "TIME_STAMP", name.alias("STEP"), *variables)
    return rows.unpivot(["TOOL_ID", "RUN_ID", "TIME_STAMP", "STEP"], list(variables), "COLUMN_NAME", "VAL").filter("VAL is not null")


def first_samples(samples: DataFrame) -> DataFrame:
    """One sample per tool, run, variable and time; of several, the least step, then value."""
    w = Window.partitionBy("TOOL_ID", "RUN_ID", "COLUMN_NAME", "TIME_STAMP").orderBy("STEP", "VAL")
    return samples.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def run_features(samples: DataFrame, population: bool = True) -> DataFrame:
    """Statistics of each variable over a run's step."""
    v = F.col("VAL")
    return samples.groupBy("TOOL_ID", "RUN_ID", "STEP", "COLUMN_NAME").agg(
        F.min("TIME_STAMP").alias("START_TIME"), F.avg(v).alias("AVERAGE"), (F.stddev_pop(v) if population else F.stddev_samp(v)).alias("STD_VAL"), F.min(v).alias("MIN_VAL"),
        *[F.percentile(v, F.lit(q)).alias(n) for n, q in (("PERCENTILE_25", 0.25), ("MEDIAN", 0.5), ("PERCENTILE_75", 0.75))], F.max(v).alias("MAX_VAL"), (F.max(v) - F.min(v)).alias("RANGE1"),
    )


def step_variable(runs: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Per tool the variable with the most distinct values; of equals the first by name."""
    long = runs.unpivot(["TOOL_ID"], list(variables), "COLUMN_NAME", "VAL").filter("VAL is not null").distinct()
    counts = long.groupBy("TOOL_ID", "COLUMN_NAME").agg(F.count("*").alias("DISTINCT_NUM"))
    w = Window.partitionBy("TOOL_ID").orderBy(F.desc("DISTINCT_NUM"), "COLUMN_NAME")
    return counts.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def tool_tree(tools: DataFrame) -> DataFrame:
    """Each tool with its parent."""
    child, parent = tools.alias("c"), tools.alias("p")
    return child.join(parent, F.col("c.PARENT_TOOL_ID") == F.col("p.ID")).select(F.col("c.ID").alias("TOOL_ID"), F.col("c.NAME").alias("CHAMBER_NAME"), F.col("p.NAME").alias("EQP_NAME"))


def context_value(contexts: DataFrame, meta: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A context value whose column differs by tool: ``meta`` (TOOL_ID, NAME, COLUMN_NAME) says which."""
    values = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])
    where = meta.filter(F.col("NAME") == name).select("TOOL_ID", "COLUMN_NAME")
    return contexts.join(where, "TOOL_ID").withColumn(name, F.element_at(values, F.col("COLUMN_NAME"))).drop("COLUMN_NAME")


def defect_coordinates(defects: DataFrame, wafers: DataFrame, recipes: DataFrame) -> DataFrame:
    """Defect positions relative to the wafer's centre, in metres; joined by inspection time as the source system does, so a time with several wafers repeats its defects."""
    rows = defects.join(wafers.drop("WAFER_KEY"), "INSPECTION_TIME").join(recipes, "RECIPE_KEY")

    def axis(a: str):
        return (F.col(f"WAFER_{a}") / 1000 - F.col(f"CENTER_{a}") / 1000) / 1000 - (F.col(f"CENTER_{a}") - F.col(f"ORIGIN_{a}")) / 1000000

    return rows.select(axis("X").alias("X"), axis("Y").alias("Y"), (F.col("SIZE_D") / 1000).alias("DIAMETER"), "WAFER_KEY", "INSPECTION_TIME")


def wafer_keys(summary: DataFrame, wanted: DataFrame) -> DataFrame:
    """Keys of wafers whose id, in any of its forms, is wanted."""
    named = summary.withColumn("WAFER_ID", wafer_id_by_form("WAFER_ID", "LOT_ID"))
    return named.join(wanted.select("WAFER_ID").distinct(), "WAFER_ID", "left_semi").select("WAFER_KEY", "WAFER_ID")


def named_samples(samples: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Samples under their parameter's name; text parameters and counters of steps go."""
    numeric = dictionary.filter((F.col("DATA_TYPE") != "String") & ~F.upper("PARAMETRIC_NAME").rlike("STEP|COUNT"))
    return samples.join(numeric.select("TOOL_ID", "COLUMN_NAME", "PARAMETRIC_NAME").distinct(), ["TOOL_ID", "COLUMN_NAME"])


def defect_lots(defects: DataFrame, summary: DataFrame) -> DataFrame:
    """Each defect with its lot and unit id, null where its key is not known."""
    lots = summary.select("WAFER_KEY", F.substring("LOT_ID", 1, 6).alias("LOT_ID"), F.concat(F.substring("LOT_ID", 1, 6), F.substring(F.substring("LOT_ID", 9, 1_000), 1, 3)).alias("WAFER_ID"))
    return defects.join(lots, "WAFER_KEY", "left")


def base_vector(facts: DataFrame, parameter: str, units: DataFrame) -> DataFrame:
    """Distinct unit and value pairs of one parameter, for listed units."""
    rows = facts.filter(F.col("PARAMETRIC_NAME") == parameter).join(units, "WAFER_ID", "left_semi")
    return rows.select(F.col("WAFER_ID").alias("NAME"), F.col("RESULT").alias("VAL")).distinct()


def product_amounts(rows: DataFrame, per_batch: int) -> DataFrame:
    """Rows per product and the batch in which products of about ``per_batch`` rows together are run, in product order."""
    sizes = rows.groupBy("PRODUCT_ID").agg(F.count("*").alias("N"))
    w = Window.orderBy("PRODUCT_ID").rowsBetween(Window.unboundedPreceding, -1)  # one row a product
    return sizes.withColumn("BATCH", F.floor(F.coalesce(F.sum("N").over(w), F.lit(0)) / per_batch).cast("long"))


def product_features(parts: DataFrame, contexts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Run statistics of each product over all its runs, from the runs' states: no sample is read again.  A run of several products counts for each."""
    own = contexts.select("TOOL_ID", "RUN_ID", "PRODUCT_ID").distinct()
    return states.features(states.merged(parts.join(own, ["TOOL_ID", "RUN_ID"]), ["PRODUCT_ID", *keys]), ["PRODUCT_ID", *keys])


def placed_features(features: DataFrame, contexts: DataFrame, tools: DataFrame) -> DataFrame:
    """Run features with the run's product (by tool and run) and the tool's names."""
    placed = features.join(contexts.select("TOOL_ID", "RUN_ID", "PRODUCT_ID").distinct(), ["TOOL_ID", "RUN_ID"])
    return placed.join(tools.select("TOOL_ID", "CHAMBER_NAME", "EQP_NAME"), "TOOL_ID")
