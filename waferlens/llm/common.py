"""What several corpus operators share: written intermediate tables and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more rows than half a shuffle partition's share, and than this, is dealt over slices of about as many.
KEY_ROWS = 1_000
#: The same for the ends of links, which are pairs of numbers; rounds over links keep their plans small.
LINK_ROWS = 50_000


def _folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        # Driver and executors are one process here.
        base = f"{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/waferlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.  Unset, it is an error unless Spark is local."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: later steps neither recompute it nor depend on one executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the folder of a table that ``cut`` returned, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.split("://")[-1].split(":")[-1].startswith(_folder(spark).split("://")[-1].split(":")[-1]):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once its results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def join_hot(large: DataFrame, small: DataFrame, key: str, rows: str, spread: Sequence[str], how: str = "inner", most: int | None = None, key_rows: int | None = None) -> DataFrame:
    """``large`` joined by ``key`` to ``small``, which has one row a key and in ``rows`` how often ``large`` has it.

    Rows of a key that occurs more than ``key_rows`` times (by default more
    than half a shuffle partition's share) are dealt over slices by a hash of
    the columns ``spread``, and the key's row of ``small`` is repeated in
    each, so no key fills one task.  Such keys number at most the rows of
    ``large`` / ``key_rows``, by default twice the shuffle partitions: the
    bound of what is broadcast.  ``most``, if known, bounds how often a key
    occurs; else it is looked up, and where no key is that frequent the join
    is a plain one.  ``rows`` goes.
    """
    if most is None:
        total, most = small.agg(F.coalesce(F.sum(rows), F.lit(0)), F.coalesce(F.max(rows), F.lit(0))).first()
        key_rows = key_rows or max(KEY_ROWS, total // (2 * int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    if most <= key_rows:
        return large.join(small.drop(rows), key, how)
    slices = F.ceil(F.col(rows) / key_rows).cast("int")
    hot = small.filter(F.col(rows) > key_rows).select(F.col(key).alias("_hot"), slices.alias("_slices"))
    dealt = large.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    dealt = dealt.withColumn("_slice", F.when(F.col("_slices").isNotNull(), F.pmod(F.xxhash64(*spread), F.col("_slices"))).otherwise(0).cast("int")).drop("_hot", "_slices")
    each = small.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))).drop(rows)
    return dealt.join(each, [key, "_slice"], how).drop("_slice")


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.select(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has two columns ``u`` and ``v`` of one comparable type.  Loops,
    nulls, repeats and both directions are allowed.  Returns ``node`` and
    ``component`` (the smallest node, itself included); an empty input gives
    an empty result.  Large-star and small-star rounds run as joins with
    grouped minima; a node with very many neighbours is dealt over slices
    (``join_hot``), and each round is written to the shared folder.
    """
    edges = (
        edges.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges = cut(edges, "edges")
    before = _signature(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        # u > v holds for every edge.  Large star: all larger neighbours of a node point to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("degree"))
        large = join_hot(both.filter("v > u"), least, "u", "degree", ["v"], most=2 * before[0], key_rows=LINK_ROWS).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and all its smaller neighbours point to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
        pairs = join_hot(large, low, "u", "degree", ["v"], most=2 * before[0], key_rows=LINK_ROWS).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after_edges = cut(pairs.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _signature(after_edges)
        edges = after_edges
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def component_heads(nodes: DataFrame, members: DataFrame, key: str, head: str) -> DataFrame:
    """``key`` and ``component_id`` (the least ``head`` of its component, nulls last) of every row of ``nodes`` (one row a key); a node without edges is its own component."""
    of = members.select(F.col("node").alias("_node"), "component")
    linked = cut(nodes.select(key, head).join(of, F.col(key) == F.col("_node"), "left").select(key, head, F.coalesce("component", key).alias("component")), "linked")
    least = linked.groupBy("component").agg(F.min(head).alias("component_id"), F.count("*").alias("_rows"))
    return join_hot(linked, least, "component", "_rows", [key]).select(key, "component_id")
