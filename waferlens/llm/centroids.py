"""Exact centroid clustering with Drake's adaptive bounds.

Every vector keeps an upper bound of the distance to its centroid, lower
bounds of the distances to its next nearest centroids in order, and one lower
bound for all that remain.  After centroids move, bounds move with them; a
vector is measured anew only as far down its list as its bounds no longer
certify the nearest, and against all centroids where even the last bound
doesn't.  How many bounds are kept follows from how many were needed in the
round before.  Coordinates are integers, distances of the result and sums are
exact, and bounds are widened by more than rounding can take, so the result is
that of plain Lloyd rounds.  A round is one pass over the table and one
aggregate; only centroids and sums, clusters by dimensions, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_table

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Coordinates beyond this are an error: squared distances would not fit 64 bits.
LARGEST = 1 << 26
#: Up to here products of float64 are exact integers, and distances go through matrix products.
_FLOAT_SAFE = 1 << 22
#: Bounds are widened by this share, far above rounding.
_SLACK = 1e-9
_STATE = "cluster int, upper double, near array<int>, lower array<double>, rest double, needed int, distance long"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer centroids, row by centroid."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < _FLOAT_SAFE:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1)


def _paired(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x - c) ** 2).sum(-1)


def _ranked(x: np.ndarray, c: np.ndarray, kept: int) -> tuple[np.ndarray, ...]:
    """From all distances: nearest, its squared distance, upper bound, next ``kept`` centroids, their lower bounds and that of the rest."""
    d = squared(x, c)
    order = np.argsort(d, axis=1, kind="stable")  # equal distances: the smaller number first
    first = order[:, 0]
    low = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64)) * (1 - _SLACK)
    rest = low[:, kept + 1] if kept + 1 < len(c) else np.full(len(x), np.inf)
    exact = d[np.arange(len(x)), first]
    return first, exact, np.sqrt(exact.astype(np.float64)) * (1 + _SLACK), order[:, 1 : kept + 1], low[:, 1 : kept + 1], rest


class Bounds:
    """Assignments and bounds of a batch of vectors."""

    def __init__(self, x: np.ndarray, centroids: np.ndarray, kept: int):
        self.x, self.kept = x, min(kept, len(centroids) - 1)
        self.cluster, self.exact, self.upper, self.near, self.lower, self.rest = _ranked(x, centroids, self.kept)
        self.needed = np.full(len(x), len(centroids))

    @classmethod
    def held(cls, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray, rest: np.ndarray) -> Bounds:
        self = cls.__new__(cls)
        self.x, self.cluster, self.upper, self.near, self.lower, self.rest, self.kept = x, cluster, upper, near, lower, rest, near.shape[1]
        self.exact = np.full(len(x), -1)
        self.needed = np.zeros(len(x), np.int64)
        return self

    def move(self, centroids: np.ndarray, shifts: np.ndarray, kept: int) -> None:
        """Follow centroids that moved by at most ``shifts``; afterwards ``cluster`` is exact and ``needed`` says how many listed centroids each vector looked at."""
        n, k = len(self.x), len(centroids)
        self.upper = (self.upper + shifts[self.cluster]) * (1 + _SLACK)
        bounds = np.concatenate([self.lower - shifts[self.near], (self.rest - shifts.max(initial=0.0))[:, None]], 1)
        bounds -= np.abs(bounds, where=np.isfinite(bounds), out=np.zeros_like(bounds)) * _SLACK
        # What stands further down the list bounds what stands above it, too.
        bounds = np.minimum.accumulate(bounds[:, ::-1], 1)[:, ::-1]
        # A tie could go to a smaller number: only a lesser upper bound certifies.
        loose = self.upper >= bounds[:, 0]
        at = np.flatnonzero(loose)
        if len(at):
            self.exact[at] = _paired(self.x[at], centroids[self.cluster[at]])
            self.upper[at] = np.sqrt(self.exact[at].astype(np.float64)) * (1 + _SLACK)
        certified = self.upper[:, None] < bounds
        level = np.where(certified.any(1), certified.argmax(1), self.kept + 1)
        self.needed = np.where(level > self.kept, k, level)
        self.lower, self.rest = bounds[:, : self.kept].copy(), bounds[:, self.kept].copy()
        for depth in range(1, self.kept + 1):
            at = np.flatnonzero(level == depth)
            if len(at):
                self._reorder(at, depth, centroids)
        at = np.flatnonzero(level > self.kept)
        if len(at):
            self.cluster[at], self.exact[at], self.upper[at], self.near[at], self.lower[at], self.rest[at] = _ranked(self.x[at], centroids, self.kept)
        if kept < self.kept:  # the bounds beyond become part of the rest
            self.rest = np.minimum(self.rest, self.lower[:, kept:].min(1)) if n else self.rest
            self.near, self.lower, self.kept = self.near[:, :kept], self.lower[:, :kept], kept

    def _reorder(self, at: np.ndarray, depth: int, centroids: np.ndarray) -> None:
        """Measure the centroid and the first ``depth`` listed ones and sort them; all others are farther than the nearest of them."""
        ids = np.concatenate([self.cluster[at, None], self.near[at, :depth]], 1)
        d = _paired(self.x[at][:, None, :], centroids[ids])
        order = np.lexsort((ids, d), axis=1)
        ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
        self.cluster[at], self.exact[at] = ids[:, 0], d[:, 0]
        self.upper[at] = np.sqrt(d[:, 0].astype(np.float64)) * (1 + _SLACK)
        self.near[at, :depth] = ids[:, 1:]
        # A measured centroid may lie beyond the bound of the unmeasured that follow; as a bound of the list it may not.
        after = self.lower[at, depth] if depth < self.kept else self.rest[at]
        low = np.minimum(np.sqrt(d[:, 1:].astype(np.float64)) * (1 - _SLACK), after[:, None])
        self.lower[at, :depth] = low


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), kind))


def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), width)


def _whole(docs_batch: pa.RecordBatch, centroids: np.ndarray, shifts: np.ndarray | None, kept: int, dims: int) -> pa.RecordBatch:
    """One batch of (vec_id, v, state...) through a round; ``shifts`` is None in the first."""
    x = _matrix(docs_batch.column(1), dims, np.int64)
    if shifts is None:
        b = Bounds(x, centroids, kept)
    else:
        _, _, cluster, upper, near, lower, rest = docs_batch.columns[:7]
        width = len(near[0]) if len(near) else 0
        b = Bounds.held(x, cluster.to_numpy().astype(np.int64), upper.to_numpy().copy(), _matrix(near, width, np.int64).copy(), _matrix(lower, width, np.float64), rest.to_numpy())
        b.move(centroids, shifts, kept)
    state = [pa.array(b.cluster, pa.int32()), pa.array(b.upper), _lists(b.near, pa.int32()), _lists(b.lower, pa.float64()), pa.array(b.rest), pa.array(b.needed, pa.int32()), pa.array(b.exact, pa.int64())]
    return pa.RecordBatch.from_arrays([docs_batch.column(0), docs_batch.column(1), *state], names=["vec_id", "v", "cluster", "upper", "near", "lower", "rest", "needed", "distance"])


def _pass(table: DataFrame, centroids: np.ndarray, shifts: np.ndarray | None, kept: int, dims: int, id_kind: str) -> DataFrame:
    sent = table.sparkSession.sparkContext.broadcast((centroids, shifts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, s = sent.value
        for batch in batches:
            if batch.num_rows:
                yield _whole(batch, c, s, kept, dims)

    return table.mapInArrow(run, f"vec_id {id_kind}, v array<int>, {_STATE}")


def _moved(state: DataFrame, centroids: np.ndarray, dims: int) -> tuple[np.ndarray, int]:
    """Exact floors of the clusters' means (an empty one stays), and the most bounds that a certified vector needed."""
    sums = state.groupBy("cluster").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("needed") < len(centroids), F.col("needed"))).alias("needed"), *[F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(dims)]
    ).collect()
    after = centroids.copy()
    for row in sums:
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return after, max([row["needed"] or 0 for row in sums], default=0)


def _named(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, v``: sound vectors as integers."""
    rows = vectors.select(F.col("vec_id").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    sound = (F.size("x") == dims) & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = F.transform("x", lambda c: F.floor(c * scale))
    large = F.exists("x", lambda c: F.abs(c) > LARGEST / scale)
    error = F.raise_error(F.lit(f"a component is beyond {LARGEST // scale}: squared distances would not fit 64 bits")).cast("array<int>")
    return rows.filter(F.coalesce(sound, F.lit(False))).select("vec_id", F.when(large, error).otherwise(scaled.cast("array<int>")).alias("v"))


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, kept: int = 4) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every sound row of (``vec_id, embedding``).

    A vector is sound with exactly ``dims`` components, none null or
    non-finite; others are left out.  ``kept`` is the number of bounds at the
    start, at most ``clusters - 1``.  Of equal distances the smaller number
    counts; repeated rows count as often as they occur; rows without an id
    are clustered but never start a centroid; with fewer rows than clusters
    there are as many centroids; components beyond 65,536 are an error; a
    table without sound vectors gives an empty one; other columns are ignored
    whatever their names.
    """
    spark = vectors.sparkSession
    id_kind = vectors.schema["vec_id"].dataType.simpleString()
    named = cut(_named(vectors, dims, scale), "vectors")
    starts = named.filter("vec_id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    if not starts:
        # Without an id nothing starts a centroid.
        drop_table(named)
        return spark.createDataFrame([], f"vec_id {id_kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["v"] for r in starts], np.int64)
    kept = max(1, min(kept, len(centroids) - 1)) if len(centroids) > 1 else 0
    least = min(kept, max(2, len(centroids) // 8))
    state, shifts = named, None
    for _ in range(rounds):
        after = cut(_pass(state, centroids, shifts, kept, dims, id_kind), "bounds")
        drop_table(state)
        state = after
        moved, needed = _moved(state, centroids, dims)
        # One bound more than the deepest certificate needed; never more than before, as those beyond are not known.
        kept = max(least, min(kept, needed + 1)) if shifts is not None else kept
        shifts = np.sqrt(_paired(moved.astype(np.float64), centroids.astype(np.float64))) * (1 + _SLACK)
        centroids = moved
    final = _pass(state, centroids, shifts, kept, dims, id_kind)
    texts = F.array(*[F.lit(",".join(map(str, c))) for c in centroids.tolist()])
    own = F.get(F.array(*[F.array(*map(F.lit, c)) for c in centroids.tolist()]), F.col("cluster"))
    exact = F.aggregate(F.zip_with("v", own, lambda a, b: (a.cast("long") - b) * (a.cast("long") - b)), F.lit(0).cast("long"), lambda a, x: a + x)
    done = cut(final.select("vec_id", "cluster", F.when(F.col("distance") >= 0, F.col("distance")).otherwise(exact).alias("distance")), "clusters")
    drop_table(state)
    # One row a cluster: the bound of the broadcast.
    of = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    total = of.agg(F.sum("own").alias("all"))
    sums = of.crossJoin(F.broadcast(total)).select(F.col("cluster").alias("_c"), F.col("own").cast("long").alias("cluster_inertia"), F.col("all").cast("long").alias("inertia"))
    return done.join(F.broadcast(sums), F.col("cluster") == F.col("_c")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.get(texts, F.col("cluster")), 256).alias("centroid_sha256"))


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    """Plain rounds over ``embeddings`` in DuckDB SQL: every vector against every centroid."""
    parts = [f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM e WHERE vec_id IS NOT NULL) ORDER BY h, v LIMIT {clusters})"""]
    for k in range(rounds + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (SELECT r, vec_id, v, c, d FROM (SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM e, c{k}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if k < rounds:
            parts.append(f"""
c{k + 1} AS MATERIALIZED (SELECT c, coalesce(n.m, o.m) AS m FROM c{k} o LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m
 FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(0, {dims})) AS i FROM a{k}) GROUP BY c, i) GROUP BY c) n USING (c))""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (c)
"""
