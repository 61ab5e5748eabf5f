"""SimHash near-duplicates by a tiled exact comparison.

Fingerprints are computed in numpy inside tasks.  Distinct fingerprints are
sorted by population counts and cut into blocks; pairs of blocks whose
population counts differ beyond the radius are never shipped, and inside a
pair the same rule skips tiles.  Each pair of blocks gives a spanning forest
of its links, not all its pairs, so a dense group of copies stays linear in
rows while no document loses its component.

``near_duplicates`` links by the fingerprints alone.  ``near_copies`` takes
the components of the same comparison, with fingerprints of two words and a
wide radius, as candidates and verifies them by the exact Jaccard similarity
of the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import jaccard
from .common import component_heads, connected_components, cut, join_hot
from .shingles import majority, mixed, shingle_hashes

#: Most fingerprints of a block; with fewer blocks than tasks a cluster should have, blocks are smaller.
BLOCK_ROWS = 131_072
#: Bits of 128 that fingerprints of near copies may differ in.  At a similarity of 0.8 they differ in 19.4 on average (standard deviation 4.1).
COPY_RADIUS = 32
#: Bytes of shingle sets that a task verifies at a time, of either side.
SLICE_BYTES = 1 << 25
_QUARTERS = np.array([48, 32, 16, 0], dtype=np.uint64)


def fingerprint(text: str | None, words: int = 4) -> int:
    """64-bit SimHash: a bit is 1 if set in over half of the shingle hashes; zero without words."""
    return int(majority(shingle_hashes(text, words)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """One row per input row: ``id_col`` and ``fp`` (the fingerprint as a signed long)."""
    key = docs.schema[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=[id_col, "fp"])

    slim = docs.select(id_col, text_col)
    return slim.mapInArrow(run, f"`{id_col}` {key.dataType.simpleString()}, fp long")


def _quarters(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters of fingerprints (rows x words); two fingerprints differ in at least the sum of the counts' differences."""
    return np.bitwise_count((fps[:, :, None] >> _QUARTERS) & np.uint64(0xFFFF)).astype(np.int16).sum(1, dtype=np.int16)


def _order(fps: np.ndarray) -> np.ndarray:
    q = _quarters(fps.reshape(len(fps), -1))
    return fps[np.lexsort((q[:, 3], q[:, 2], q[:, 1], q[:, 0]))]


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        return np.fromiter(map(self.root, range(len(self.up))), np.int64, len(self.up))


def _boxes(values: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.arange(0, len(values), tile)
    return np.minimum.reduceat(values, cuts), np.maximum.reduceat(values, cuts)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of every pair of fingerprints (rows x words)."""
    found = np.bitwise_count(x[:, None, 0] ^ y[None, :, 0])
    for k in range(1, x.shape[1]):
        found = found + np.bitwise_count(x[:, None, k] ^ y[None, :, k])
    return found


def _alike(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Which sizes allow sets of the least similarity."""
    return (jaccard.BOTTOM * n[:, None] >= jaccard.TOP * m[None, :]) & (jaccard.BOTTOM * m[None, :] >= jaccard.TOP * n[:, None])


def near_pairs(a: np.ndarray, b: np.ndarray | None, radius: int, tile: int = 128, sizes: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in ``a``, in ``b``) of fingerprints at most ``radius`` bits apart, tile pair by tile pair; inside ``a`` where ``b`` is None.

    Tile pairs whose quarter population counts are further apart are skipped,
    and with ``sizes`` those whose set sizes rule the similarity out.
    """
    own = b is None
    right = a if own else b
    (lo_a, hi_a), (lo_b, hi_b) = _boxes(_quarters(a), tile), _boxes(_quarters(right), tile)
    if sizes is not None:
        n, m = sizes[0].astype(np.int64), sizes[1].astype(np.int64)
        (n_lo, n_hi), (m_lo, m_hi) = _boxes(n, tile), _boxes(m, tile)
    for i in range(len(lo_a)):
        fits = np.maximum(0, np.maximum(lo_b - hi_a[i], lo_a[i] - hi_b)).sum(1) <= radius
        if sizes is not None:
            fits &= (jaccard.BOTTOM * n_hi[i] >= jaccard.TOP * m_lo) & (jaccard.BOTTOM * m_hi >= jaccard.TOP * n_lo[i])
        if own:
            fits[:i] = False
        x = a[i * tile : (i + 1) * tile]
        for j in np.flatnonzero(fits).tolist():
            near = distances(x, right[j * tile : (j + 1) * tile]) <= radius
            if own and i == j:
                near = np.triu(near, 1)
            if not near.any():
                continue
            if sizes is not None:
                near &= _alike(n[i * tile : (i + 1) * tile], m[j * tile : (j + 1) * tile])
            p, q = np.nonzero(near)
            if len(p):
                yield p + i * tile, q + j * tile


def block_links(a: np.ndarray, b: np.ndarray | None, radius: int, tile: int = 128, sizes: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the links between two sorted blocks, or inside one (``b`` None), as pairs of places."""
    shift = 0 if b is None else len(a)
    forest = Forest(len(a) + (0 if b is None else len(b)))
    out, known, since = [], np.arange(len(forest.up)), 0
    for p, q in near_pairs(a, b, radius, tile, sizes):
        # Most pairs of a dense group are joined already; what was joined up to the last look is left out at once.
        fresh = known[p] != known[q + shift]
        for x, y in zip(p[fresh].tolist(), (q[fresh] + shift).tolist(), strict=True):
            since += 1
            if forest.join(x, y):
                out.append((x, y - shift))
        if since > 4 * tile * tile:
            known, since = forest.roots(), 0
    return out


def _span(at: Column, more: int) -> Column:
    return F.explode(F.sequence(at[0], at[1] + more)).alias("meet")


def _links(nodes: DataFrame, words: int, radius: int, key: str, block_rows: int) -> DataFrame:
    """Links ``u``, ``v`` (values of ``key``) of a spanning forest of the nodes at most ``radius`` bits apart.

    ``nodes`` has ``key`` (unique, long), the fingerprint's words
    ``f0..`` and, with two words, the set size ``n``.  Work is quadratic in
    nodes, as the tiled exact method is; memory is bounded by ``block_rows``.
    Blocks follow set sizes where there are any, else population counts.
    """
    sized = "n" in nodes.columns
    count = nodes.count()
    parts = max(-(-count // block_rows), min(12, -(-count // 4096)), 1)
    lanes = [f"f{k}" for k in range(words)]

    def pop(i: int) -> Column:
        return sum((F.bit_count(F.shiftrightunsigned(f, 48 - 16 * i).bitwiseAND(F.lit(0xFFFF))) for f in lanes), F.lit(0)).cast("int")

    sort = ["n"] if sized else []
    ranged = nodes.select(key, *lanes, *sort, *[pop(i).alias(f"p{i}") for i in range(4)]).repartitionByRange(parts, *sort, "p0", "p1", "p2", "p3", key)

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if rows is None:
            return
        rows = rows.sort_by([(c, "ascending") for c in [*sort, "p0", "p1", "p2", "p3"]])
        for i in range(0, rows.num_rows, block_rows):
            part = rows.slice(i, block_rows)
            fps = np.stack([part[f].to_numpy().view(np.uint64) for f in lanes], 1)
            q = _quarters(fps)
            n = part["n"].to_numpy() if sized else np.zeros(len(fps), np.int32)
            # Blocks that may meet share a value: a class of sizes (each 1.25 times the one before) or the first quarter's count.
            size = np.floor(np.log(np.maximum(n[[0, -1]], 1)) / np.log(jaccard.BOTTOM / jaccard.TOP)).astype(int).tolist() if sized else [int(q[:, 0].min()), int(q[:, 0].max())]
            keys = part[key].combine_chunks()
            yield pa.RecordBatch.from_pylist(
                [{"keys": keys.to_numpy().tobytes(), "fps": fps.tobytes(), "ns": n.astype("<i4").tobytes(), "block": f"{int(n[0]):012}{q[0].tolist()}{keys[0].as_py()!r}", "meet": size, "n": [int(n[0]), int(n[-1])], "lo": q.min(0).tolist(), "hi": q.max(0).tolist()}],
                schema=pa.schema([("keys", pa.binary()), ("fps", pa.binary()), ("ns", pa.binary()), ("block", pa.string()), ("meet", pa.list_(pa.int32())), ("n", pa.list_(pa.int32())), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32()))]),
            )

    blocks = cut(ranged.mapInArrow(cut_blocks, "keys binary, fps binary, ns binary, block string, meet array<int>, n array<int>, lo array<int>, hi array<int>"), "blocks")
    boxes = blocks.select("block", "meet", "n", "lo", "hi")
    reach = F.transform(F.array(F.lit(0), F.lit(1)), lambda i: F.get("meet", i) + (0 if sized else (2 * i - 1) * radius))
    left = boxes.select(F.col("block").alias("a"), F.col("n").alias("an"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), _span(reach, 2 if sized else 0))
    right = boxes.select(F.col("block").alias("b"), F.col("n").alias("bn"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), _span(F.col("meet"), 0))
    gap = sum((F.greatest(F.lit(0), F.col("blo")[i] - F.col("ahi")[i], F.col("alo")[i] - F.col("bhi")[i]) for i in range(4)), F.lit(0))
    alike = F.col("bn")[0] * jaccard.TOP <= F.col("an")[1] * jaccard.BOTTOM if sized else F.lit(True)
    # Blocks are in order of their least size, so that of two the larger one is found from the smaller.
    pairs = left.join(right, "meet").filter((F.col("a") <= F.col("b")) & (gap <= radius) & alike).select("a", "b").distinct()
    side = F.struct("keys", "fps", "ns")
    work = (
        pairs.join(blocks.select(F.col("block").alias("a"), side.alias("x")), "a")
        .join(blocks.select(F.col("block").alias("b"), side.alias("y")), "b")
        .select("a", "b", "x", "y")
        .repartition(max(parts * 2, 12), "a", "b")
    )

    def opened(side: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(side["keys"], "<i8"), np.frombuffer(side["fps"], np.uint64).reshape(-1, words), np.frombuffer(side["ns"], "<i4")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                (keys, x, n), (others, y, m) = opened(batch.column(2)[row].as_py()), opened(batch.column(3)[row].as_py())
                found = block_links(x, None if a == b else y, radius, sizes=(n, m) if sized else None)
                if found:
                    i, j = np.array(found).T
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i]), pa.array(others[j])], names=["u", "v"])

    return work.mapInArrow(compare, "u long, v long")


def fingerprint_links(distinct_fps: DataFrame, radius: int = 4, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints (column ``fp``) that differ in at most ``radius`` bits; they connect exactly what all links connect."""
    return _links(distinct_fps.select("fp", F.col("fp").alias("f0")), 1, radius, "fp", block_rows)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id reachable over links between
    fingerprints at most ``radius`` bits apart, equal ones included.  Null and
    empty texts have fingerprint zero and link like any other; very long ones
    are hashed whole; rows with a null id keep their row and count for a
    component only if it has no other id; repeated rows stay repeated; an
    empty table gives an empty one.  Other columns are ignored, whatever their
    names.
    """
    fps = cut(fingerprints(docs, id_col, text_col, words), "fingerprints")
    heads = cut(fps.groupBy("fp").agg(F.min(id_col).alias("head"), F.count("*").alias("rows")), "heads")
    members = connected_components(fingerprint_links(heads.select("fp"), radius))
    classes = component_heads(heads, members, "fp", "head").join(heads.select("fp", "rows"), "fp")
    return join_hot(fps, classes, "fp", "rows", [id_col]).select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, ``text_key``, ``key`` of the shingle set, its size ``n`` and its fingerprint in two words."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "text_key", "key", "n", "f0", "f1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, found = [], [], []
            for text in b.column(2).to_pylist():
                own = jaccard.shingle_set(text)
                keys.append(jaccard.set_key(own))
                sizes.append(len(own))
                found.append((majority(own), majority(mixed(own))))
            fps = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(fps[:, 0]), pa.array(fps[:, 1])], names=names)

    slim = docs.select(id_col, F.xxhash64(text_col).alias("text_key"), text_col)
    return slim.mapInArrow(run, f"`{id_col}` {kind}, text_key long, key binary, n int, f0 long, f1 long")


def _verify(radius: int, now: tuple, held: list[tuple]) -> list[tuple[int, int]]:
    """Links of similar sets that connect a group's cell: (number, side, fingerprint words, shingles) of each row."""
    if len(held) < 2:
        return []
    keys, sides, f0, f1, raw = zip(*held, strict=True)
    fps = np.array([f0, f1], np.int64).T.copy().view(np.uint64)
    sets = [np.frombuffer(r, np.uint64) for r in raw]
    sizes, side = np.array([len(s) for s in sets]), np.array(sides)
    order = np.argsort(sizes, kind="stable")
    fps, sizes, side = fps[order], sizes[order], side[order]
    forest, out, known, since = Forest(len(held)), [], np.arange(len(held)), 0
    for p, q in near_pairs(fps, None, radius, sizes=(sizes, sizes)):
        fresh = known[p] != known[q]
        if now[1] != now[2]:
            fresh &= side[p] != side[q]
        for x, y in zip(p[fresh].tolist(), q[fresh].tolist(), strict=True):
            since += 1
            i, j = int(order[x]), int(order[y])
            if forest.root(x) != forest.root(y) and jaccard.similar(sets[i], sets[j]):
                forest.join(x, y)
                out.append((keys[i], keys[j]))
        if since > 65536:
            known, since = forest.roots(), 0
    return out


def by_group(rows: Iterator[pa.RecordBatch], width: int, close: Callable[[tuple, list[tuple]], list], table: Callable[[list], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by their first ``width`` columns, closed group by group."""
    held: list[tuple] = []
    now: tuple | None = None
    for batch in rows:
        out: list = []
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:width] != now:
                if now is not None:
                    out += close(now, held)
                held, now = [], row[:width]
            held.append(row[width:])
        if out:
            yield table(out)
    if now is not None and (out := close(now, held)):
        yield table(out)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = COPY_RADIUS, slice_bytes: int = SLICE_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id_col`` and ``component_id`` of every row: the smallest id reachable over links of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

    Candidates are the components of the tiled comparison of 128-bit
    fingerprints within ``radius`` bits.  A component's sets meet in cells of
    at most ``slice_bytes`` a side, where pairs within the radius that nothing
    connects yet are verified on the whole sets; no link is taken unverified,
    and a link is lost only where its fingerprints differ in more bits (of
    similarity 0.8 about one in a thousand, above it fewer).  Equal sets are
    one node.  Null texts are empty, and texts without words are alike; very
    long ones are taken whole; rows with a null id keep their row; repeated
    rows stay repeated; an empty table gives an empty one; other columns are
    ignored.
    """
    rows = cut(_signatures(docs, id_col, text_col), "signatures")
    heads = rows.groupBy("key").agg(F.min(id_col).alias("head"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("f0").alias("f0"), F.first("f1").alias("f1"), F.min("text_key").alias("wanted"))
    # Sets are numbered; the numbers are written, so that they stay.
    heads = cut(heads.withColumn("id", F.monotonically_increasing_id()), "heads")
    coarse = connected_components(_links(heads.filter("n > 0").select("id", "f0", "f1", "n"), 2, radius, "id", block_rows))
    nodes = cut(coarse.join(heads, coarse["node"] == heads["id"]).select("id", "key", "component", "wanted", "n", "f0", "f1"), "nodes")
    slices = nodes.groupBy("component").agg(F.ceil(F.sum(F.col("n").cast("long") * 8) / slice_bytes).cast("int").alias("slices"), F.count("*").alias("rows"))
    nodes = cut(join_hot(nodes, slices, "component", "rows", ["id"]), "nodes")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                found = [jaccard.shingle_set(t) for t in b.column(0).slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(map(jaccard.set_key, found), pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())], names=["key", "shingles"])

    # One text of each set is fetched and stands for it; texts whose 64-bit hashes meet may bring a set twice.
    own = docs.select(F.col(text_col).alias("body")).withColumn("wanted", F.xxhash64("body"))
    own = own.join(nodes.select("wanted"), "wanted", "left_semi").select("body").distinct()
    held = own.mapInArrow(sets, "key binary, shingles binary").join(nodes.select("id", "key", "component", "slices", "f0", "f1"), "key")
    held = held.withColumn("side", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda j: F.struct(F.least(j, F.col("side")).alias("lo"), F.greatest(j, F.col("side")).alias("hi")))
    group = ["component", "lo", "hi"]
    dealt = held.withColumn("cell", F.explode(cells)).select("component", "cell.lo", "cell.hi", "id", "side", "f0", "f1", "shingles")
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found, strict=True)], names=["u", "v"])

        yield from by_group(batches, 3, lambda now, rows: _verify(radius, now, rows), table)

    members = connected_components(dealt.mapInArrow(verify, "u long, v long"))
    classes = component_heads(heads, members, "id", "head").join(heads.select("id", "key", "rows"), "id").drop("id")
    return join_hot(rows.select(id_col, "key"), classes, "key", "rows", [id_col]).select(id_col, "component_id")
