"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

For each vector length a rotation of the principal axes is learned so that
signs lose least; signs are the binary codes.  Codes are cut into substrings,
one hash table each; vectors whose substrings differ in a few bits at most in
any table are candidates, those whose whole codes are near are reranked by
cosine over the original vectors in double precision.  How wide substrings
are, how many tables there are and how many bits a probe reaches follows from
a label's rows and from how often a code bit flips at the threshold, measured
on the sample.  A pair counts only in the first table in which it meets, so
nothing is counted twice and no pairs are shuffled: a bucket gives sums of
links and a spanning forest.  Large buckets are cut into slices that meet
pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import component_heads, connected_components, cut, join_hot
from .simhash import by_group

THRESHOLD = 0.93
BITS = 64
SAMPLE_ROWS = 8000
#: Rows that a bucket should have; keys are as wide as that takes.
BUCKET_ROWS = 2048
SLICE_ROWS = 4096
#: The share of pairs at the threshold that tables may miss, and the longest reach of a probe.
MISSED, REACH = 1e-3, 2


def learn_rotation(x: np.ndarray, bits: int = BITS, rounds: int = 40, seed: int = 3, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean, projection (dimensions x bits) of unit vectors and the share of bits that flips at the threshold.

    Principal axes, then alternating sign codes and orthogonal Procrustes;
    vectors shorter than ``bits`` take several rotations from different
    starts, so that every code has all bits.
    """
    mean = x.mean(0)
    centred = x - mean
    _, _, axes = np.linalg.svd(centred.T @ centred)
    axes = axes[: min(bits, x.shape[1])].T
    v = centred @ axes
    rng, parts = np.random.default_rng(seed), []
    while sum(p.shape[1] for p in parts) < bits:
        rotation, _ = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(v @ rotation > 0, 1.0, -1.0).T @ v)
            rotation = (left @ right).T
        parts.append(axes @ rotation)
    w = np.concatenate(parts, 1)[:, :bits]
    return mean, w, _flips(x, mean, w, threshold, rng)


def random_rotation(dims: int, bits: int = BITS, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, float]:
    """For a length that the sample has too few vectors of: random directions, whose bits flip with the angle's share of a half turn on any data."""
    return np.zeros(dims), np.random.default_rng(dims).normal(size=(dims, bits)), float(np.arccos(threshold) / np.pi)


def _flips(x: np.ndarray, mean: np.ndarray, w: np.ndarray, threshold: float, rng: np.random.Generator) -> float:
    """The share of code bits that flips between a vector and a random neighbour at the threshold."""
    if x.shape[1] < 2:
        return 0.0
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    near = threshold * x + np.sqrt(1 - threshold**2) * y
    return float((((x - mean) @ w > 0) != ((near - mean) @ w > 0)).mean())


def missed(width: int, tables: int, reach: int, flips: float) -> float:
    """The share of pairs at the threshold that meet in no table: their substrings differ in more than ``reach`` bits in each."""
    met = sum(comb(width, k) * flips**k * (1 - flips) ** (width - k) for k in range(reach + 1))
    return (1 - met) ** tables


def tables_for(rows: int, flips: float, bucket_rows: int = BUCKET_ROWS) -> tuple[int, int, int]:
    """Width of a key, number of tables and reach of a probe for a label of so many rows: the fewest copies of a vector that miss at most ``MISSED``; narrower keys where no number of tables does."""
    width = max(0, (max(rows, 1) // bucket_rows).bit_length() - 1) if rows > bucket_rows else 0
    if rows > bucket_rows:
        width = max(1, width)
    while width:
        fits = []
        for reach in range(min(REACH, width) + 1):
            # A vector goes to its own bucket and to those within reach whose number is less, about half of them.
            copies = 1 + sum(comb(width, k) for k in range(1, reach + 1)) / 2
            fits += [(t * copies, (width, t, reach)) for t in range(1, BITS // width + 1) if missed(width, t, reach, flips) <= MISSED]
        if fits:
            return min(fits)[1]
        width -= 1
    return 0, 1, 0


def code_radius(flips: float, bits: int = BITS) -> int:
    """Bits in which codes at the threshold differ at most, but for about one pair in 10,000."""
    return min(bits, int(np.ceil(bits * flips + 4 * np.sqrt(bits * flips * (1 - flips)))) + 1)


def visits(codes: np.ndarray, width: int, tables: int, reach: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every table and mask of at most ``reach`` bits: the numbers of the buckets to go to, and who goes there.  Of two buckets the greater number visits the lesser."""
    out = []
    masks = [sum(1 << b for b in own) for k in range(reach + 1) for own in combinations(range(width), k)]
    for t in range(tables):
        home = (codes >> np.uint64(t * width)) & np.uint64((1 << width) - 1)
        for m in masks:
            there = home ^ np.uint64(m)
            out.append((there, there <= home))
    return out


def codes_of(x: np.ndarray, model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    """Unsigned 64-bit codes of unit vectors."""
    signs = (x - model[0]) @ model[1] > 0
    padded = np.zeros((len(x), 64), np.uint8)
    padded[:, : signs.shape[1]] = signs
    return np.packbits(padded, axis=1, bitorder="little").view("<u8").ravel()


def _units(x: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled by their largest entry first, so that no square overflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _node(label: Column, vector: Column) -> Column:
    return F.concat(F.hex(F.xxhash64(label, vector)), F.hex(F.xxhash64(F.lit("wide"), label, vector)))


def bucket_links(vectors: np.ndarray, codes: np.ndarray, sides: np.ndarray, cross: bool, part: int, table: int, width: int, reach: int, threshold: float, radius: int, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of a bucket whose cosine reaches the threshold, first met in this table; with ``cross``, of differing sides only.

    Of two visitors neither is at home here, so the pair meets elsewhere.
    """
    mask = np.uint64((1 << width) - 1)
    home = (codes >> np.uint64(table * width)) & mask == np.uint64(part)
    left, right = [], []
    for a in range(0, len(codes), step):
        for b in range(a, len(codes), step):
            xor = codes[a : a + step, None] ^ codes[None, b : b + step]
            near = np.bitwise_count(xor) <= radius
            near &= home[a : a + step, None] | home[None, b : b + step]
            if a == b:
                near = np.triu(near, 1)
            if cross:
                near &= sides[a : a + step, None] != sides[None, b : b + step]
            i, j = np.nonzero(near)
            if not len(i):
                continue
            x = xor[i, j]
            first = np.bitwise_count((x >> np.uint64(table * width)) & mask) <= reach
            for t in range(table):
                first &= np.bitwise_count((x >> np.uint64(t * width)) & mask) > reach
            i, j = i[first] + a, j[first] + b
            for k in range(0, len(i), 65536):
                p, q = i[k : k + 65536], j[k : k + 65536]
                hit = np.einsum("ij,ij->i", vectors[p], vectors[q]) >= threshold
                left.append(p[hit])
                right.append(q[hit])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        p, q = root(a), root(b)
        if p != q:
            up[max(p, q)] = min(p, q)
            kept.append((a, b))
    return kept


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, bucket_rows: int = BUCKET_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of (``vec_id, embedding, label``).

    Vectors of equal label, not null, and equal length link at a cosine of
    ``threshold`` or more; null, zero or non-finite vectors link with nothing
    and stand alone.  Equal vectors (repeated rows too) are one node, counted
    as often as they occur.  Rotations are learned from at most
    ``sample_rows`` vectors; all are indexed.  Tables and the code radius are
    set to miss about one in a thousand of the pairs at the threshold, fewer
    above it.  A null vec_id stands in a component of its own only if nothing
    there has an id.  An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    sound = F.coalesce(F.col("label").isNotNull() & F.col("v").isNotNull() & sound, F.lit(False))
    named = rows.select("vec_id", "label", "v", F.when(sound, _node(F.col("label"), F.col("v"))).alias("node"))
    classes = named.filter("node is not null").groupBy("node", "label").agg(F.first("v").alias("v"), F.min("vec_id").alias("head"), F.count("*").alias("n"))
    classes = cut(classes.withColumn("of", F.struct("label", F.size("v").alias("dims"))), "classes")
    sample = classes.select("node", "v").orderBy("node").limit(sample_rows).toPandas()["v"]  # node is a hash
    lengths = sample.map(len)
    models = {int(d): learn_rotation(_units(np.array([*map(np.asarray, sample[lengths == d])])), threshold=threshold) for d in lengths.unique() if (lengths == d).sum() >= 100}
    sent = spark.sparkContext.broadcast(models)
    # Vectors travel as they came: single precision stays half as wide and loses nothing.
    stored = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    sizes = classes.groupBy("of").agg(F.count("*").alias("alike"), F.count("*").alias("rows"))
    sized = join_hot(classes.select("node", "of", "v", "n"), sizes, "of", "rows", ["node"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.asarray(v, np.float64) for v in batch.column(1).to_pylist()]
            alike = batch.column(2).to_numpy()
            dims = np.array([len(v) for v in found])
            codes, places = np.zeros(len(found), np.uint64), [[] for _ in found]
            for d in np.unique(dims).tolist():
                model = sent.value.get(d) or random_rotation(d, threshold=threshold)
                at = np.flatnonzero(dims == d)
                codes[at] = codes_of(_units(np.array([found[i] for i in at])), model)
                for rows_alike in np.unique(alike[at]).tolist():
                    own = at[alike[at] == rows_alike]
                    width, tables, reach = tables_for(rows_alike, model[2], bucket_rows)
                    for k, (there, goes) in enumerate(visits(codes[own], width, tables, reach)):
                        table = k // (len(visits(codes[:0], width, tables, reach)) // tables)
                        for i, part in zip(own[goes].tolist(), there[goes].tolist(), strict=True):
                            places[i].append({"tab": table, "part": part})
            raw = pa.array([v.astype(stored).tobytes() for v in found], pa.binary())
            where = pa.array(places, pa.list_(pa.struct([("tab", pa.int32()), ("part", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), pa.array(dims, pa.int32()), batch.column(2), pa.array(codes.view(np.int64)), raw, batch.column(3), where], names=["node", "label", "dims", "alike", "code", "raw", "n", "places"])

    kind = vectors.schema["label"].dataType.simpleString()
    slim = sized.select("node", "v", "alike", "n", F.col("of.label").alias("label"))
    coded = cut(slim.mapInArrow(encode, f"node string, label {kind}, dims int, alike long, code long, raw binary, n long, places array<struct<tab:int,part:long>>"), "codes")
    bucket = ["label", "dims", "tab", "part"]
    keyed = coded.select("node", "label", "dims", "alike", "code", "raw", "n", F.explode("places").alias("p")).select("node", "label", "dims", "alike", "code", "raw", "n", "p.tab", "p.part")
    crowded = coded.select("label", "dims", F.explode("places").alias("p")).select("label", "dims", "p.tab", "p.part").groupBy(*bucket).count().filter(F.col("count") > slice_rows)
    large = cut(crowded.select(*bucket, F.ceil(F.col("count") / slice_rows).cast("int").alias("slices")), "large")
    keyed = keyed.join(large, bucket, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    keyed = keyed.withColumn("side", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda j: F.struct(F.least(j, F.col("side")).alias("lo"), F.greatest(j, F.col("side")).alias("hi")))
    group = [*bucket, "lo", "hi"]
    dealt = keyed.withColumn("cell", F.explode(cells)).select(*bucket, "cell.lo", "cell.hi", "node", "side", "alike", "code", "raw", "n")
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(now: tuple, held: list[tuple]) -> list[tuple[str, str | None, int]]:
            if len(held) < 2:
                return []
            _, dims, table, part, lo, hi = now
            nodes, sides, alike, codes, units, ns = zip(*held, strict=True)
            flips = (sent.value.get(dims) or random_rotation(dims, threshold=threshold))[2]
            width, _, reach = tables_for(alike[0], flips, bucket_rows)
            x = _units(np.frombuffer(b"".join(units), stored).reshape(len(held), -1))
            weights = np.array(ns, np.int64)
            i, j = bucket_links(x, np.array(codes, np.int64).view(np.uint64), np.array(sides), lo != hi, part, table, width, reach, threshold, code_radius(flips))
            if not len(i):
                return []
            links = np.bincount(i, weights[j], len(held)) + np.bincount(j, weights[i], len(held))
            out = [(nodes[k], None, int(links[k])) for k in np.flatnonzero(links).tolist()]
            return out + [(nodes[a], nodes[b], 0) for a, b in _forest(len(held), i, j)]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            u, v, c = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.string()), pa.array(v, pa.string()), pa.array(c, pa.int64())], names=["u", "v", "links"])

        yield from by_group(batches, 6, close, table)

    found = cut(dealt.mapInArrow(link, "u string, v string, links long"), "links")
    members = connected_components(found.filter("v is not null").select("u", "v"))
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    heads = component_heads(classes, members, "node", "head").join(classes.select("node", "n"), "node").join(counts, F.col("node") == F.col("u"), "left")
    results = cut(heads.select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", "n"), "results")
    # Rows without a sound vector have no node; each is a key of its own here.
    return join_hot(named.select("vec_id", F.coalesce("node", F.concat(F.lit("-"), F.col("vec_id").cast("string"))).alias("node")), results, "node", "n", ["vec_id"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
