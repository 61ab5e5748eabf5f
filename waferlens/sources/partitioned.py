"""Partitioned catalog tables: rows appended or refilled by partition, and partitions that the catalog lists without rows dropped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quoted(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class PartitionedTable:
    """A Parquet table of the session's catalog, partitioned by ``keys``; ``location`` is a folder that the cluster shares."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]

    @classmethod
    def create(cls, spark: SparkSession, name: str, schema: StructType, keys: Sequence[str], location: str) -> PartitionedTable:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet PARTITIONED BY ({parts}) LOCATION {_quoted(location)}")
        return cls(spark, name, tuple(keys))

    def _ordered(self, df: DataFrame) -> DataFrame:
        # Rows go in by place; a table has its partition columns last.
        return df.select(*self.spark.table(self.name).columns)

    def append(self, df: DataFrame) -> None:
        self._ordered(df).write.insertInto(self.name)

    def refill(self, df: DataFrame) -> None:
        """Idempotent reload: partitions that ``df`` has rows of are replaced, the others stay."""
        # An insert takes the mode from the session, not from the writer.
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            self._ordered(df).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(key, before)

    def add(self, **values: object) -> None:
        """List a partition before it has rows."""
        self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION ({self._spec(values)})")

    def _spec(self, values: dict[str, object]) -> str:
        return ", ".join(f"`{k}` = {_quoted(v)}" for k, v in values.items())

    def partitions(self) -> DataFrame:
        """The partitions that the catalog lists, a column each key."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name}")
        parts = F.split("partition", "/")
        kinds = {f.name: f.dataType for f in self.spark.table(self.name).schema.fields}
        # Names come escaped as in a path.
        value = [F.expr(f"url_decode(replace(substring_index(element_at(split(partition, '/'), {i + 1}), '=', -1), '+', '%2B'))").cast(kinds[k]).alias(k) for i, k in enumerate(self.keys)]
        return listed.filter(F.size(parts) == len(self.keys)).select(*value)

    def empty(self) -> DataFrame:
        """Listed partitions that no row is in; the rows are counted by partition columns alone."""
        held = self.spark.table(self.name).select(*self.keys).distinct()
        return self.partitions().join(held, list(self.keys), "left_anti")

    def drop_empty(self) -> int:
        """Drop the partitions without rows; how many went.  Their keys, a row each, come to the driver in portions."""
        rows = self.empty().collect()
        for at in range(0, len(rows), 200):
            specs = ", ".join(f"PARTITION ({self._spec(r.asDict())})" for r in rows[at : at + 200])
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")
        return len(rows)
