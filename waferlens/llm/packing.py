"""Packing tokenised documents into fixed-length sequences.

Documents longer than a sequence are cut into full pieces and one shorter
first piece; nothing else is ever cut.  Pieces below full length are dealt at
random into groups of bounded size.  Each group is filled in one pass, a few
pieces at a time, which leaves many bins underfull; a local search then moves
documents between underfull bins or exchanges one or two for up to two, always
raising the sum of squared fills, until bins empty and no exchange is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .tokens import shared_encoder

END_ID = 0
TEXTS_AT_ONCE = 256
#: Pieces that the first pass fills into bins at a time.
START_PIECES = 64


def pieces(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of every document's ids followed by the end id.

    Columns: ``doc_id, piece, start, length, ids_crc32, slot`` and, on
    request, ``ids`` (binary, unsigned 32-bit).  Null texts count as empty and
    give one piece with the end id alone.  ``slot`` in [0, 1) deals pieces to
    groups, repeated rows included.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        context = TaskContext.get()
        rng = np.random.default_rng(context.partitionId() if context else 0)
        full = 4 * capacity
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                rows: list[tuple] = []
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    first = len(ids) % full or full
                    a, b, piece = 0, first, 0
                    while a < len(ids):
                        own = ids[a:b]
                        rows.append((key, piece, a // 4, len(own) // 4, zlib.crc32(own), *((own,) if with_ids else ())))
                        a, b, piece = b, b + full, piece + 1
                columns = list(zip(*rows, strict=True))
                kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                arrays.insert(5, pa.array(rng.random(len(rows))))
                names = [id_col, "piece", "start", "length", "ids_crc32", "slot", *(["ids"] if with_ids else [])]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, slot double" + (", ids binary" if with_ids else "")
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def best_fit_decreasing(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Item numbers by bin; over a whole group only what the search is compared with.  Bins wait in stacks by the room they have left, and a bit mask tells which stacks hold any."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    bins: list[list[int]] = []
    for i in order:
        size = lengths[i]
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = waiting[room].pop()
            if not waiting[room]:
                mask &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            waiting[left].append(b)
            mask |= 1 << left
    return bins


def _sums(members: Sequence[int], lengths: Sequence[int]) -> dict[int, tuple[int, ...]]:
    """Every total of one or two members, with members that have it.  Distinct lengths of a bin are few, since they add up to its fill."""
    by: dict[int, list[int]] = {}
    for i in members:
        by.setdefault(lengths[i], []).append(i)
    sizes = sorted(by)
    found: dict[int, tuple[int, ...]] = {}
    for n, a in enumerate(sizes):
        for b in sizes[:n]:
            found[a + b] = (by[a][0], by[b][0])
        if len(by[a]) > 1:
            found[2 * a] = (by[a][0], by[a][1])
    return found | {a: (by[a][0],) for a in sizes}


class _Takers:
    """Bins by what they may give away (none, one or two members) and the room they have, so that an exchange is looked up."""

    def __init__(self, capacity: int) -> None:
        self.top = np.full(capacity + 1, -1, np.int64)  # most room of the bins that may give this total
        self.rooms = [0] * (capacity + 1)  # bit mask of the rooms there are
        self.bins: dict[tuple[int, int], dict[int, None]] = {}
        self.held: dict[int, tuple[int, list[int]]] = {}
        self.totals = np.arange(capacity + 1)

    def add(self, k: int, room: int, totals: list[int]) -> None:
        self.held[k] = room, totals
        for t in totals:
            self.bins.setdefault((t, room), {})[k] = None
            self.rooms[t] |= 1 << room
            if room > self.top[t]:
                self.top[t] = room

    def drop(self, k: int) -> None:
        room, totals = self.held.pop(k)
        for t in totals:
            own = self.bins[t, room]
            del own[k]
            if not own:
                del self.bins[t, room]
                self.rooms[t] ^= 1 << room
                self.top[t] = self.rooms[t].bit_length() - 1

    def find(self, given: int) -> int:
        """The least total that some bin can give away for ``given``, gaining by it; -1 if none can."""
        fits = self.top[:given] >= given - self.totals[:given]
        t = int(fits.argmax()) if given else 0
        return t if given and fits[t] else -1

    def tightest(self, given: int, t: int) -> int:
        fits = self.rooms[t] >> (given - t)
        return next(iter(self.bins[t, given - t + (fits & -fits).bit_length() - 1]))


def first_pass(lengths: Sequence[int], capacity: int, at_once: int = START_PIECES) -> list[list[int]]:
    """Item numbers by bin, ``at_once`` items at a time: where the search starts."""
    return [[at + i for i in b] for at in range(0, len(lengths), at_once) for b in best_fit_decreasing(lengths[at : at + at_once], capacity)]


def local_search(bins: list[list[int]], lengths: Sequence[int], capacity: int, made: dict[str, int] | None = None) -> list[list[int]]:
    """Empty the less full bins into fuller ones while the sum of squared fills rises.

    One or two members of a bin change places with none, one or two of a bin
    at least as full.  Ends when no such exchange is left between any two bins,
    or when the number of bins is the least possible.  ``made`` counts moves
    (nothing comes back), exchanges and emptied bins.
    """
    made = made if made is not None else {}
    made |= {k: made.get(k, 0) for k in ("moves", "exchanges", "emptied")}
    bins = [list(b) for b in bins]
    fills = [sum(lengths[i] for i in b) for b in bins]
    count, least = len(bins), -(-sum(fills) // capacity)
    moved = True
    while moved and count > least:
        moved = False
        takers = _Takers(capacity)
        live = sorted((k for k in range(len(bins)) if 0 < fills[k] < capacity), key=lambda k: fills[k])
        for k in live:
            takers.add(k, capacity - fills[k], [0, *_sums(bins[k], lengths)])
        # The least full bin first; one with no exchange left is no taker for fuller ones, so those in ``takers`` are at least as full as the current one.
        queue = [(fills[k], k) for k in live]
        while queue and count > least:
            fill, s = heappop(queue)
            if fill != fills[s] or s not in takers.held:
                continue
            takers.drop(s)
            while fills[s]:
                own = _sums(bins[s], lengths)
                gain, given, taken = 0, 0, 0
                for g in own:
                    t = takers.find(g)
                    if t >= 0 and g - t > gain:
                        gain, given, taken = g - t, g, t
                if not gain:
                    break
                k = takers.tightest(given, taken)
                takers.drop(k)
                give, take = own[given], _sums(bins[k], lengths)[taken] if taken else ()
                bins[s] = [i for i in bins[s] if i not in give] + list(take)
                bins[k] = [i for i in bins[k] if i not in take] + list(give)
                fills[s] -= gain
                fills[k] += gain
                if fills[k] < capacity:
                    takers.add(k, capacity - fills[k], [0, *_sums(bins[k], lengths)])
                    heappush(queue, (fills[k], k))
                moved = True
                made["exchanges" if take else "moves"] += 1
                made["emptied"] += not fills[s]
                count -= not fills[s]
    return [b for b in bins if b]


def pack_lengths(lengths: Sequence[int], capacity: int, made: dict[str, int] | None = None) -> list[list[int]]:
    return local_search(first_pass(lengths, capacity), lengths, capacity, made)


def pack(items: DataFrame, capacity: int = 2048, group_rows: int = 20_000, carried: Sequence[str] = ()) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have ``length`` (1 to ``capacity``) and ``slot``; ``slot`` goes.

    Also how its group's search went: ``group_least`` (the bound: its tokens
    over ``capacity``), ``group_start`` and ``group_bins`` (sequences before
    and after), ``group_moves`` and ``group_exchanges``; pieces of full length
    are in no group.  Groups never share a sequence, which costs at most one
    sequence a group beyond the sum of their bounds.  ``items`` should be a
    written table: it is read more than once.  Columns named in ``carried``,
    which may be large, do not pass through the search; they are joined to its
    result by ``_row``, a number of each row, which goes, too.
    """
    told = ("group_least", "group_start", "group_bins", "group_moves", "group_exchanges")
    kept = [c for c in items.columns if c != "slot" and c not in carried]
    short = F.col("length") < capacity
    groups = max(1, -(-items.filter(short).count() // group_rows))
    fields = [items.schema[c] for c in kept]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long, " + ", ".join(f"{c} long" for c in told)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].astype("int64").tolist()
        sequence, offset = np.zeros(len(group), "int64"), np.zeros(len(group), "int64")
        first = int(group["_group"].iloc[0]) << 32
        made: dict[str, int] = {}
        bins = pack_lengths(lengths, capacity, made)
        search = (-(-sum(lengths) // capacity), len(bins) + made["emptied"], len(bins), made["moves"], made["exchanges"])
        for k, members in enumerate(bins):
            at = 0
            for i in members:
                sequence[i], offset[i] = first + k, at
                at += lengths[i]
        return group[kept].assign(sequence_id=sequence, offset=offset, **dict(zip(told, search, strict=True)))

    dealt = items.filter(short).select(*kept, "slot").withColumn("_group", F.floor(F.col("slot") * groups).cast("long"))
    packed = dealt.groupBy("_group").applyInPandas(run, schema)
    if carried:
        packed = packed.join(items.filter(short).select("_row", *carried), "_row")
    full = items.filter(~short).select(*kept, *carried, (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *[F.lit(None).cast("long").alias(c) for c in told])
    order = [c for c in items.columns if c not in ("slot", "_row")] if carried else kept
    return packed.unionByName(full).select(*order, "sequence_id", "offset", *told)


def pack_documents(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place in it.

    Null and empty texts give one piece of one id; very long ones are cut into
    whole sequences and a shorter first piece; repeated rows are packed one by
    one, null ids too; columns besides the id and the text are ignored; an
    empty table gives an empty one.
    """
    found = pieces(docs, capacity, id_col, text_col, vocabulary, with_ids)
    if not with_ids:
        return pack(cut(found, "pieces"), capacity)
    return pack(cut(found.withColumn("_row", F.monotonically_increasing_id()), "pieces"), capacity, carried=("ids",))
