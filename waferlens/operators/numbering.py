"""Numbers of ordered rows, in all or within groups, without a task that sees all of them or a whole group.

Rows are dealt over tasks by ranges of their order and written sorted, each
with its task and its place there.  Counts per task, or per group and task,
say how many rows stand before: as many rows as there are tasks, or groups and
their tasks.  Rows that are equal in the order stay in one task, so an order
needs ties broken where many rows may be alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written

#: Spark's increasing ids hold the task above this bit and the row within the task below it.
_ROW_BITS = 33


def placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` written in ``order``, with ``_part`` (the range's task) and ``_at`` (the place there, from 0)."""
    at = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(rows.withColumns({"_part": F.shiftright(at, _ROW_BITS), "_at": at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}), "placed")


def placed_values(df: DataFrame, order: Sequence[Column | str], values: Sequence[str], others: Sequence[str]) -> DataFrame:
    """``others`` and ``values`` of ``df`` written in ``order``, with ``_part`` and ``_at`` as ``placed`` has them and, for each of the values (numbered from 0), ``_gap0`` and so on: how many earlier rows of the task lack it.

    What only orders the rows is not written, and gaps take no room where there is none.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).select(*others, *values, F.spark_partition_id().alias("_part"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _at bigint, " + ", ".join(f"_gap{i} bigint" for i in range(len(values)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, gaps = 0, [0] * len(values)
        for batch in batches:
            found = [pa.array(np.arange(at, at + batch.num_rows))]
            for i, v in enumerate(values):
                missing = batch.column(v).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                found.append(pa.array(gaps[i] + np.cumsum(missing) - missing))
                gaps[i] += int(missing.sum())
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "_at", *[f"_gap{i}" for i in range(len(values))]])

    return written(rows.mapInArrow(run, kinds), "placed")


def numbered(df: DataFrame, order: Sequence[Column | str], column: str, start: int = 1) -> DataFrame:
    """``df`` with ``column``: consecutive longs in ``order``, from ``start``.  An empty table stays one."""
    rows = placed(df, order)
    parts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row that lists all tasks, then each with the sum of those before it.
    listed = parts.agg(F.array_sort(F.collect_list(F.struct("_part", "_n"))).alias("p"))
    sums = F.transform("p", lambda x, i: F.struct(x["_part"].alias("_part"), F.aggregate(F.slice("p", 1, i), F.lit(0).cast("long"), lambda s, y: s + y["_n"]).alias("_before")))
    before = listed.select(F.inline(sums))
    return rows.join(F.broadcast(before), "_part").withColumn(column, F.col("_before") + F.col("_at") + start).drop("_part", "_at", "_before")


def group_parts(rows: DataFrame, *aggregates: Column) -> DataFrame:
    """Of ``placed`` rows with a group ``_k``: a row per group and task with ``aggregates``, ``_n``, and ``_shift``, which makes ``_at`` the place in the group, from 0."""
    parts = rows.groupBy("_k", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"), *aggregates)
    earlier = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).drop("_first")


def numbered_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], column: str, start: int = 1) -> DataFrame:
    """``df`` with ``column``: consecutive longs in ``order`` within each group of ``keys``; null keys are a group too."""
    key = F.struct(F.lit(0), *keys)  # a struct, so that null keys meet
    rows = placed(df, [*keys, *order]).withColumn("_k", key)
    # By group and task: a hot group's rows meet the rows of many parts.
    both = rows.join(group_parts(rows).drop("_n"), ["_k", "_part"])
    return both.withColumn(column, F.col("_shift") + F.col("_at") + start).select(*[c for c in df.columns if c != column], column)
