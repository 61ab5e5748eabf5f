"""Token ids in seekable zstandard files.

A file holds independent zstandard frames of whole documents' ids (unsigned
little-endian, 16 or 32 bits), then a skippable frame with one entry a
document, then the seek table of the public zstd seekable format: compressed
size, decompressed size and the low 32 bits of XXH64 for every frame, its
footer last.  Any zstd tool can decompress a file, and a reader fetches and
checks only the frames that hold what it was asked for.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, scratch_path
from .tokens import shared_encoder

END_ID = 2
FRAME_BYTES = 1 << 18
#: Bytes of text in a file.  Small inputs make smaller files, so that each core has some to write.
FILE_BYTES, LEAST_FILE_BYTES = 1 << 26, 1 << 20
TEXTS_AT_ONCE = 256
# Fixed values of the public zstd frame and seekable formats.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_MAGIC, CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frame", "<u4"), ("at", "<u4"), ("ids", "<u4")])
_FRAME = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark would read it by, so that tasks do not take a path of the cluster's store for one of their own disks."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub(r"^file:/+", "file:///", store.makeQualified(path).toString())


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(sink, docs: Iterable[tuple[int | None, bytes]], width: int = 2, level: int = 3) -> tuple[int, int]:
    """Write (doc_id, unsigned 32-bit ids) in the order given; returns the numbers of documents and of ids."""
    packer = zstandard.ZstdCompressor(level=level, write_checksum=False)
    frames: list[tuple[int, int, int]] = []
    index = bytearray()
    held: list[bytes] = []
    size = total = count = 0

    def flush() -> None:
        nonlocal size
        raw = b"".join(held)
        packed = packer.compress(raw)
        sink.write(packed)
        frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        held.clear()
        size = 0

    for key, ids in docs:
        wide = np.frombuffer(ids, "<u4")
        if width < 4 and len(wide) and int(wide.max()) >> (8 * width):
            raise ValueError(f"token id {int(wide.max())} does not fit {width} bytes")
        raw = wide.astype(f"<u{width}").tobytes()
        index += np.array([(key or 0, key is None, len(frames), size // width, len(raw) // width)], _DOC).tobytes()
        count += 1
        held.append(raw)
        size += len(raw)
        total += len(raw) // width
        if size >= FRAME_BYTES:
            flush()
    if held:
        flush()
    body = struct.pack("<B", width) + bytes(index)
    sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
    table = np.array(frames, _FRAME).tobytes() + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE_MAGIC)
    sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
    return count, total


class TokenFile:
    """Reads a seekable token file; only the frames that are asked for are fetched and decompressed."""

    def __init__(self, source) -> None:
        self._file = source
        end = source.size()
        source.seek(end - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        at = end - 9 - count * _FRAME.itemsize
        source.seek(at)
        self.frames = np.frombuffer(source.read(count * _FRAME.itemsize), _FRAME)
        self._starts = np.concatenate([[0], np.cumsum(self.frames["packed"].astype("i8"))])
        source.seek(int(self._starts[-1]))
        kind, size = struct.unpack("<II", source.read(8))
        body = source.read(size)
        if kind != SKIPPABLE_INDEX or (size - 1) % _DOC.itemsize:
            raise ValueError("no document index before the seek table")
        self.width = body[0]
        self.docs = np.frombuffer(body, _DOC, offset=1)

    def frame(self, k: int) -> bytes:
        self._file.seek(int(self._starts[k]))
        raw = zstandard.ZstdDecompressor().decompress(self._file.read(int(self.frames["packed"][k])), max_output_size=max(1, int(self.frames["size"][k])))
        if len(raw) != self.frames["size"][k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames["check"][k]:
            raise ValueError(f"frame {k} fails its checksum")
        return raw

    def read(self, rows: Iterable[int]) -> Iterator[np.ndarray]:
        """Ids of the documents at these places of the index; a frame is decompressed once for neighbours."""
        now, raw = -1, b""
        for row in rows:
            d = self.docs[row]
            if d["frame"] != now:
                now = int(d["frame"])
                raw = self.frame(now)
            yield np.frombuffer(raw, f"<u{self.width}", int(d["ids"]), int(d["at"]) * self.width)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode whole texts and write them in ascending id order (nulls first; equal ids in text order) as files of ``folder``.

    Ids take 16 bits where the vocabulary and ``end_id`` fit them, else 32.
    Returns the manifest: ``part, file, docs, ids`` and ``start`` (ids in all
    files before).  A retried task replaces its file in one step.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    width = 2 if max(shared_encoder(vocabulary).size, end_id + 1) <= 1 << 16 else 4
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(-(-size // file_bytes), min(-(-size // LEAST_FILE_BYTES), 4 * spark.sparkContext.defaultParallelism), 1)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("body"))
    ranged = slim.repartitionByRange(n, "id", F.xxhash64("body")).sortWithinPartitions("id", F.xxhash64("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary)
        end = np.array([end_id], "<u4").tobytes()

        def rows() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                    part = batch.slice(at, TEXTS_AT_ONCE)
                    for key, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                        yield key, ids + end

        context = TaskContext.get()
        store, path = _filesystem(folder)
        store.create_dir(path, recursive=True)
        name = f"tokens-{context.partitionId():06d}.zst"
        own = f"{path}/.{name}.{context.taskAttemptId()}"
        with store.open_output_stream(own) as sink:
            count, ids = write_file(sink, rows(), width)
        if not count:
            store.delete_file(own)
            return
        if store.get_file_info(f"{path}/{name}").is_file:  # of an attempt before; not every store moves over a file
            store.delete_file(f"{path}/{name}")
        store.move(own, f"{path}/{name}")
        yield pa.RecordBatch.from_pylist([{"part": context.partitionId(), "file": name, "docs": count, "ids": ids}])

    manifest = cut(ranged.mapInArrow(run, "part long, file string, docs long, ids long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files; ``start`` counts the ids of all documents before."""

    folder = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{path}/{row['file']}") as source:
                    tokens = TokenFile(source)
                    lengths = tokens.docs["ids"].astype("i8")
                    starts = row["start"] + np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype("i8")
                    frames = tokens.docs["frame"]
                    # Documents of a frame lie together: a frame is a batch.
                    for k in range(len(tokens.frames)):
                        a, b = int(np.searchsorted(frames, k)), int(np.searchsorted(frames, k, "right"))
                        crcs = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in tokens.read(range(a, b))]
                        ids = pa.array(tokens.docs["doc_id"][a:b], mask=tokens.docs["null"][a:b].astype(bool))
                        yield pa.RecordBatch.from_arrays([ids, pa.array(starts[a:b]), pa.array(lengths[a:b]), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("part", "file", "start")
    count = max(1, files.count())
    return files.repartitionByRange(count, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_round_trip(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write all documents and read them back.

    Null and empty texts are the end id alone; a very long text is one frame;
    repeated rows stay, equal ids follow their texts' hashes; null ids come
    first; other columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    return read_tokens(spark, folder, write_tokens(docs, folder, vocabulary=vocabulary))
