"""Table sources and result sinks.

A source names its tables once; queries see DataFrames only, so filters and
column choices reach the scan, be it Parquet or JDBC.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSource:
    """Reads named tables from a folder of Parquet, or over JDBC where ``jdbc`` options are given.

    A JDBC read with ``partitions`` splits on ``partition_column`` between
    bounds; without a column one connection reads all, which suits small
    configuration tables only.
    """

    spark: SparkSession
    folder: str = ""
    jdbc: dict[str, str] = field(default_factory=dict)

    def table(self, name: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 32) -> DataFrame:
        if not self.jdbc:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        reader = self.spark.read.format("jdbc").options(**self.jdbc).option("dbtable", name).option("fetchsize", "10000")
        if partition_column and bounds:
            reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", str(partitions))
        return reader.load()

    def query(self, sql: str) -> DataFrame:
        """A pushed-down query over JDBC; over Parquet, Spark SQL on views made with ``register``."""
        if not self.jdbc:
            return self.spark.sql(sql)
        return self.spark.read.format("jdbc").options(**self.jdbc).option("query", sql).option("fetchsize", "10000").load()

    def register(self, *names: str) -> None:
        for name in names:
            self.table(name).createOrReplaceTempView(name)


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, sep=sep)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_as(spark: SparkSession, sql: str, columns: list[str]) -> DataFrame:
    """A query with its columns renamed in order."""
    return spark.sql(sql).toDF(*columns)


def read_properties(lines: list[str]) -> dict[str, str]:
    """``key = value`` lines; blanks and comments are skipped, other lines too."""
    found = (re.fullmatch(r"\s*([^#\s=][^=]*?)\s*=\s*(.*?)\s*", x) for x in lines)
    return {m[1]: m[2] for m in found if m}


def zone_map(modes: DataFrame) -> dict[str, dict[str, dict[str, list[str]]]]:
    """Analysis -> label -> zone -> sites, from a configuration table of a few rows."""
    found: dict[str, dict[str, dict[str, list[str]]]] = {}
    for r in modes.select("ANALYSIS", "LABEL", "NAME", F.split("SITES", ",").alias("SITES")).collect():
        found.setdefault(r["ANALYSIS"], {}).setdefault(r["LABEL"], {})[r["NAME"]] = list(r["SITES"])
    return found


@dataclass(frozen=True)
class Sink:
    """Writes results as Parquet, JSON, CSV or over JDBC; ``fields`` fixes columns and their order."""

    path: str
    format: str = "parquet"
    fields: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)
    rows_per_file: int = 0

    def write(self, df: DataFrame, mode: str = "append", partition_by: tuple[str, ...] = ()) -> None:
        out = df.select(*self.fields) if self.fields else df
        writer = out.write.format(self.format).mode(mode).options(**self.options)
        if self.rows_per_file:
            writer = writer.option("maxRecordsPerFile", self.rows_per_file)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.path)

    def replace_slices(self, df: DataFrame, *keys: str) -> None:
        """Idempotent reload: the partitions that ``df`` holds are replaced, others stay."""
        out = df.select(*self.fields) if self.fields else df
        out.write.format(self.format).mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**self.options).partitionBy(*keys).save(self.path)


def separated_text(path: str, sep: str = "@", rows_per_file: int = 100_000) -> Sink:
    return Sink(path, "csv", options={"sep": sep}, rows_per_file=rows_per_file)


def audit_row(spark: SparkSession, job: str, status: str, rows: int, started: str, ended: str) -> DataFrame:
    """One row for an audit log."""
    return spark.createDataFrame([(job, status, rows, started, ended)], "JOB string, STATUS string, ROWS_OUT long, STARTED string, ENDED string")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares; only local Spark may do without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        # Driver and executors are one process here.
        folder = f"{tempfile.gettempdir()}/checkpoints"
    return f"{folder}/waferlens/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: what several consumers read is made once, and lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no plan reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def folders(df: DataFrame) -> list[str]:
    """The folders that a written table lies in."""
    return sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})


def qualified(spark: SparkSession, path: str) -> str:
    """A folder as tasks reach it through ``pyarrow.fs``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return re.sub(r"^file:/+", "file:///", where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString())


def empty_partitions(expected: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Expected partition keys that no fact has."""
    return expected.select(key).distinct().join(facts.select(key).distinct(), key, "left_anti")


def notify(callback: Callable[[dict], None] | None, task: str, status: str, message: str = "") -> dict:
    """Tell a caller's hook how a job ended; without one nothing is sent."""
    body = {"taskId": task, "status": status, "message": message}
    if callback is not None:
        callback(body)
    return body
