"""A Spark data source for loaders that take rows in labelled batches.

``df.write.format("labelled_batches")`` sends each task's rows in batches of
bounded size, one label a batch and task attempt, checks every reply and tries
again where none came; a loader that knows a label already does not load it
twice.  Nothing counts before the driver's commit, which publishes the
batches of the attempts that succeeded, all at once; other attempts' batches
are discarded.  ``spark.read.format("labelled_batches")`` reads what was
published, in parallel, and takes filters: by the batches' least and greatest
values, then by row.

The loader is a folder that driver and executors share, or an HTTP service
(writing only).  Options: ``path`` (folder or http address), ``batch_rows``,
``retries``, ``wait`` (seconds before the second attempt, doubled each time),
``encoding`` (json or separated), ``sep``, ``fields`` (columns in order),
``user`` and ``password``, ``lose_replies`` (a drill: so many replies to each
batch are lost after it was stored), ``split_bytes`` (of a read's partition).
"""

from __future__ import annotations

import base64
import datetime as dt
import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "labelled_batches"
#: Replies that mean a batch is loaded.
LOADED = ("Success", "Publish Timeout")
NULL = "\\N"


class LoadRefused(RuntimeError):
    """The loader did not take a batch."""


def accepted(reply: dict) -> bool:
    """Whether a reply says that the batch is there: loaded now, or by an attempt whose reply was lost."""
    known = reply.get("Status") == "Label Already Exists" and reply.get("ExistingJobStatus") in ("FINISHED", "PREPARED")
    return reply.get("Status") in LOADED or known


def sent(load: Callable[[], dict], retries: int, wait: float) -> dict:
    """The reply to a batch; a lost reply or a refusal is tried again ``retries`` times."""
    last = ""
    for attempt in range(retries + 1):
        if attempt:
            time.sleep(wait * 2 ** (attempt - 1))
        try:
            reply = load()
        except OSError as e:
            last = str(e)
            continue
        if accepted(reply):
            return reply
        last = str(reply.get("Message", reply))
    raise LoadRefused(f"not loaded after {retries + 1} attempts: {last}")


def _cell(value: object) -> object:
    if isinstance(value, dt.datetime | dt.date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, bytes | list | dict):
        raise TypeError("binary and nested columns are not supported")
    return value


def encoded(batch: pa.RecordBatch, encoding: str, sep: str) -> bytes:
    """JSON, one row a line, or separated text in which a null is ``\\N``."""
    rows = zip(*[map(_cell, c.to_pylist()) for c in batch.columns], strict=True)
    if encoding == "json":
        return "".join(json.dumps(dict(zip(batch.schema.names, r, strict=True)), ensure_ascii=False) + "\n" for r in rows).encode()
    lines = []
    for r in rows:
        texts = [NULL if v is None else str(v) for v in r]
        if any(sep in t or "\n" in t for t in texts):
            raise ValueError(f"a value holds the separator {sep!r} or a line break")
        lines.append(sep.join(texts))
    return ("\n".join(lines) + "\n").encode()


def decoded(body: bytes, schema: pa.Schema, encoding: str, sep: str) -> pa.RecordBatch:
    lines = body.decode().split("\n")[:-1]
    if encoding == "json":
        rows = [json.loads(x) for x in lines]
        columns = [[r.get(n) for r in rows] for n in schema.names]
    else:
        parts = [[None if v == NULL else v for v in x.split(sep)] for x in lines]
        columns = [[p[k] for p in parts] for k in range(len(schema.names))]
    return pa.RecordBatch.from_arrays([_column(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_timestamp(kind):
        values = [None if v is None else dt.datetime.fromisoformat(v) for v in values]
        return pa.array([v if v is None or v.tzinfo or not kind.tz else v.replace(tzinfo=dt.UTC) for v in values], kind)
    if pa.types.is_date(kind):
        return pa.array([None if v is None else dt.date.fromisoformat(v) for v in values], kind)
    if pa.types.is_decimal(kind):
        return pa.array([None if v is None else Decimal(v) for v in values], kind)
    if any(isinstance(v, str) for v in values) and not pa.types.is_string(kind):
        if pa.types.is_boolean(kind):
            return pa.array([None if v is None else v == "True" for v in values], kind)
        # A number of separated text; JSON has numbers as such.
        return pa.array([None if v is None else (float(v) if pa.types.is_floating(kind) else int(v)) for v in values], kind)
    return pa.array(values, kind)


def _stats(batch: pa.RecordBatch) -> dict[str, list]:
    """Least and greatest value of the columns whose order Spark and Arrow share."""
    found = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        if pa.types.is_integer(column.type) or pa.types.is_string(column.type):
            ends = pc.min_max(column)
            found[name] = [ends["min"].as_py(), ends["max"].as_py()]
    return found


@dataclass
class FolderLoader:
    """A loader over a shared folder: batches are files under ``prepared``, and a job's list under ``commits`` publishes its batches at once."""

    path: str
    lose_replies: int = 0
    lost: dict[str, int] = field(default_factory=dict)

    def _open(self) -> tuple[fs.FileSystem, str]:
        path = self.path
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def load(self, label: str, body: bytes) -> dict:
        store, root = self._open()
        file = f"{root}/prepared/{label}"
        if store.get_file_info(file).type != fs.FileType.NotFound:
            return {"Status": "Label Already Exists", "ExistingJobStatus": "PREPARED"}
        _put(store, file, body)
        if self.lost.get(label, 0) < self.lose_replies:
            self.lost[label] = self.lost.get(label, 0) + 1
            raise ConnectionError("drill: the reply was lost")
        return {"Status": "Success"}

    def publish(self, job: str, listed: dict) -> None:
        store, root = self._open()
        _put(store, f"{root}/commits/{time.time_ns():020d}-{job}.json", json.dumps(listed).encode())
        self.discard(job, {b["label"] for b in listed["batches"]})

    def discard(self, job: str, but: Iterable[str] = ()) -> None:
        """Delete a job's batches, except those that count."""
        store, root = self._open()
        kept = set(but)
        for info in store.get_file_info(fs.FileSelector(f"{root}/prepared", allow_not_found=True)):
            if info.base_name.startswith(f"{job}-") and info.base_name not in kept:
                store.delete_file(info.path)

    def published(self) -> list[dict]:
        """The jobs' lists from the last one that replaced all before."""
        store, root = self._open()
        names = sorted(i.path for i in store.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True)) if i.path.endswith(".json"))
        jobs = []
        for name in names:
            with store.open_input_stream(name) as f:
                jobs.append(json.loads(f.read()))
        last = max((k for k, j in enumerate(jobs) if j["replaces"]), default=0)
        return jobs[last:]

    def fetch(self, label: str) -> bytes:
        store, root = self._open()
        with store.open_input_stream(f"{root}/prepared/{label}") as f:
            return f.read()


def _put(store: fs.FileSystem, file: str, body: bytes) -> None:
    """Write beside the place and move there, so that nobody reads half a file."""
    store.create_dir(file.rsplit("/", 1)[0])
    own = f"{file}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(own) as f:
        f.write(body)
    store.move(own, file)


@dataclass
class HttpLoader:
    """A loader behind HTTP PUT that prepares a labelled batch and publishes it at a second request."""

    path: str
    user: str = ""
    password: str = ""
    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 300.0

    def _request(self, url: str, headers: dict[str, str], body: bytes = b"") -> dict:
        if self.user:
            headers = headers | {"Authorization": "Basic " + base64.b64encode(f"{self.user}:{self.password}".encode()).decode()}
        request = urllib.request.Request(url, data=body, headers=headers, method="PUT")
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                return json.loads(reply.read())
        except urllib.error.HTTPError as e:
            return {"Status": "Fail", "Message": f"HTTP {e.code}"}

    def load(self, label: str, body: bytes) -> dict:
        return self._request(self.path, self.headers | {"label": label, "two_phase_commit": "true"}, body)

    def publish(self, job: str, listed: dict) -> None:
        for b in listed["batches"]:
            sent(lambda b=b: self._request(f"{self.path}_2pc", {"label": b["label"], "txn_operation": "commit"}), 3, 1.0)

    def discard(self, job: str, but: Iterable[str] = ()) -> None:
        """Prepared batches that are never committed expire at the service."""


def _loader(options: dict[str, str]) -> FolderLoader | HttpLoader:
    path = options.get("path")
    if not path:
        raise ValueError("the option path is missing")
    if path.startswith(("http://", "https://")):
        separated = options.get("encoding", "json") != "json"
        headers = {"format": "csv", "column_separator": options.get("sep", "@")} if separated else {"format": "json", "read_json_by_line": "true"}
        if options.get("partitions"):
            headers["partitions"] = options["partitions"]
        return HttpLoader(path, options.get("user", ""), options.get("password", ""), headers)
    return FolderLoader(path.rstrip("/"), int(options.get("lose_replies", 0)))


@dataclass
class Prepared(WriterCommitMessage):
    batches: list[dict]


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        self.options, self.overwrite = options, overwrite
        self.job = uuid.uuid4().hex
        self.fields = [c.strip() for c in options["fields"].split(",")] if options.get("fields") else schema.names
        self.schema = StructType([schema[c] for c in self.fields])
        self.rows = int(options.get("batch_rows", 10_000))
        self.retries, self.wait = int(options.get("retries", 3)), float(options.get("wait", 0.2))
        self.encoding, self.sep = options.get("encoding", "json"), options.get("sep", "@")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Prepared:
        """Send this attempt's rows in batches of at most ``batch_rows``; one batch is held at a time."""
        task = TaskContext.get()
        own, loader = f"{self.job}-{task.partitionId()}-{task.taskAttemptId()}", _loader(self.options)
        done: list[dict] = []
        held: list[pa.RecordBatch] = []
        count = 0

        def send() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            for batch in table.to_batches(max_chunksize=self.rows):
                label, body = f"{own}-{len(done)}", encoded(batch, self.encoding, self.sep)
                sent(lambda: loader.load(label, body), self.retries, self.wait)
                done.append({"label": label, "rows": batch.num_rows, "bytes": len(body), "stats": _stats(batch)})

        for batch in iterator:
            batch = batch.select(self.fields)
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, self.rows - count)
                held.append(part)
                count += part.num_rows
                at += part.num_rows
                if count == self.rows:
                    send()
                    held, count = [], 0
        if held:
            send()
        return Prepared(done)

    def commit(self, messages: list[Prepared | None]) -> None:
        """Publish the batches of the attempts that succeeded."""
        batches = [b for m in messages if m is not None for b in m.batches]
        _loader(self.options).publish(self.job, {"schema": self.schema.json(), "encoding": self.encoding, "sep": self.sep, "replaces": self.overwrite, "batches": batches})

    def abort(self, messages: list[Prepared | None]) -> None:
        _loader(self.options).discard(self.job)


@dataclass
class Files(InputPartition):
    batches: list[dict]


_TESTS = {GreaterThan: (pc.greater, lambda lo, hi, v: hi > v), GreaterThanOrEqual: (pc.greater_equal, lambda lo, hi, v: hi >= v), LessThan: (pc.less, lambda lo, hi, v: lo < v), LessThanOrEqual: (pc.less_equal, lambda lo, hi, v: lo <= v), EqualTo: (pc.equal, lambda lo, hi, v: lo <= v <= hi)}


class BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.schema = options, schema
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of whole numbers and texts are taken; the others stay with Spark."""
        kinds = {f.name: f.dataType.typeName() for f in self.schema.fields}
        for f in filters:
            fits = type(f) in (*_TESTS, In, IsNotNull) and len(f.attribute) == 1 and kinds.get(f.attribute[0]) in ("byte", "short", "integer", "long", "string")
            value = getattr(f, "value", None)
            if fits and (isinstance(f, IsNotNull) or (value is not None and (not isinstance(f, In) or all(v is not None for v in value)))):
                self.filters.append(f)
            else:
                yield f

    def _may_hold(self, batch: dict) -> bool:
        for f in self.filters:
            ends = batch["stats"].get(f.attribute[0])
            if ends is None:
                continue
            lo, hi = ends
            if lo is None:  # nulls only
                return False
            if isinstance(f, In):
                if not any(lo <= v <= hi for v in f.value):
                    return False
            elif not isinstance(f, IsNotNull) and not _TESTS[type(f)][1](lo, hi, f.value):
                return False
        return True

    def partitions(self) -> list[Files]:
        found, size, most = [Files([])], 0, int(self.options.get("split_bytes", 64 << 20))
        for job in _loader(self.options).published():
            for b in job["batches"]:
                if self._may_hold(b):
                    if size and size + b["bytes"] > most:
                        found.append(Files([]))
                        size = 0
                    found[-1].batches.append({"label": b["label"], "encoding": job["encoding"], "sep": job["sep"], "schema": job["schema"]})
                    size += b["bytes"]
        return found

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        loader = _loader(self.options)
        wanted = to_arrow_schema(self.schema)
        for b in partition.batches:
            held = to_arrow_schema(StructType.fromJson(json.loads(b["schema"])))
            batch = decoded(loader.fetch(b["label"]), held, b["encoding"], b["sep"])
            batch = pa.RecordBatch.from_arrays([batch.column(n).cast(wanted.field(n).type) if n in held.names else pa.nulls(batch.num_rows, wanted.field(n).type) for n in wanted.names], schema=wanted)
            for f in self.filters:
                column = batch.column(f.attribute[0])
                mask = pc.is_valid(column) if isinstance(f, IsNotNull) else pc.is_in(column, pa.array(f.value, column.type)) if isinstance(f, In) else _TESTS[type(f)][0](column, pa.scalar(f.value, column.type))
                batch = batch.filter(mask)
            if batch.num_rows:
                yield batch


class LabelledBatches(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        """Of what was published last; columns that earlier jobs lack are null."""
        jobs = _loader(dict(self.options)).published()
        if not jobs:
            raise ValueError("nothing is published there: give a schema")
        return StructType.fromJson(json.loads(jobs[-1]["schema"]))

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(dict(self.options), schema, overwrite)

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LabelledBatches)
