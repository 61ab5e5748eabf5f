"""Quality scores by a factorisation machine.

A document is a sparse vector of hashed words, structure statistics of its
characters, words and lines, and metadata (the size class of its declared
length).  Pairwise interactions have rank ``k``; the sum-of-squares identity
gives a score in time linear in the non-zero entries.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .labelled import fold, labelled_sample

BUCKETS = 1 << 14
STATS = ("upper", "digit", "symbol", "period", "pipe", "space", "wide", "distinct_words", "word_length", "distinct_lines", "line_words", "log_words", "top_word", "echo", "empty")
SIZES = 24
WIDTH = BUCKETS + len(STATS) + SIZES
THRESHOLD = 0.3


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        return value


def _classes() -> np.ndarray:
    """Byte classes by which characters are counted: upper, digit, symbol, period or comma, pipe, space, beyond ASCII."""
    table = np.zeros((256, 7), np.float32)
    for b in range(256):
        c = chr(b)
        column = 6 if b >= 128 else 0 if c.isupper() else 1 if c.isdigit() else 3 if c in ".," else 4 if c == "|" else 5 if c.isspace() else None if c.isalpha() else 2
        if column is not None:
            table[b, column] = 1
    return table


_CLASSES = _classes()


def features(text: str | None, n_chars: int | None, buckets: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct feature numbers and their values; every text, empty and null included, has some."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(raw, minlength=256).astype(np.float32)
    shares = counts @ _CLASSES / max(1, len(raw))
    sequence = text.split()
    words = Counter(sequence)
    n = len(sequence)
    echo = sum(map(eq, sequence, islice(sequence, 1, None)))
    lines = [x for x in text.split("\n") if x.strip()]
    stats = [
        *shares.tolist(), len(words) / max(1, n), min(2.0, (len(text) - counts[32]) / max(1, n) / 10), len(set(lines)) / max(1, len(lines)),
        min(2.0, n / max(1, len(lines)) / 100), np.log1p(n) / 10, max(words.values(), default=0) / max(1, n), echo / max(1, n), float(n == 0),
    ]
    size = min(SIZES - 1, int(n_chars).bit_length()) if n_chars is not None and n_chars >= 0 else 0
    ids = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
    values = np.fromiter(words.values(), np.float32, len(words))
    if len(ids):
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ids, values = ids[first], np.add.reduceat(values, first)
        values = values / np.sqrt((values * values).sum())
    return (
        np.concatenate([ids, BUCKETS + np.arange(len(STATS)), [BUCKETS + len(STATS) + size]]),
        np.concatenate([values, np.array(stats, np.float32), [1.0]]).astype(np.float32),
    )


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray  # WIDTH
    factors: np.ndarray  # WIDTH x k

    def logits(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of rows that lie one after another; ``starts`` are their first places.  w.x + (|Vx|^2 - sum (v x)^2) / 2."""
        vx = self.factors[ids] * values[:, None]
        sums = np.add.reduceat(vx, starts)
        squares = np.add.reduceat((vx * vx).sum(1), starts)
        return self.bias + np.add.reduceat(self.linear[ids] * values, starts) + 0.5 * ((sums * sums).sum(1) - squares)


def _rows(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = [len(i) for i, _ in found]
    return np.concatenate([i for i, _ in found]), np.concatenate([v for _, v in found]), np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)


def fit(found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int = 4, epochs: int = 30, rate: float = 0.05, decay: float = 2e-4, seed: int = 7) -> FactorisationMachine:
    """Adagrad on the logistic loss, both classes of equal weight.  Without both classes the scores are the share of ones."""
    rng = np.random.default_rng(seed)
    share = float(np.mean(labels)) if len(labels) else 0.5
    model = FactorisationMachine(0.0, np.zeros(WIDTH, np.float32), rng.normal(0, 0.01, (WIDTH, k)).astype(np.float32))
    if not len(labels) or not 0 < share < 1:
        return FactorisationMachine(float(np.log((share + 1e-3) / (1 - share + 1e-3))), model.linear, np.zeros_like(model.factors))
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    g_bias, g_linear, g_factors = 1e-6, np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, k), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 256):
            part = order[at : at + 256]
            ids, values, starts = _rows([found[i] for i in part])
            lengths = np.diff(np.r_[starts, len(ids)])
            error = (1 / (1 + np.exp(-model.logits(ids, values, starts))) - labels[part]) * weights[part] / len(part)
            e = np.repeat(error, lengths).astype(np.float32)
            vx = model.factors[ids] * values[:, None]
            sums = np.repeat(np.add.reduceat(vx, starts), lengths, axis=0)
            used, where = np.unique(ids, return_inverse=True)
            grad = np.bincount(where, e * values) + decay * model.linear[used]
            g_linear[used] += grad**2
            model.linear[used] -= rate * grad / np.sqrt(g_linear[used])
            pull = (e * values)[:, None] * (sums - vx)
            grad = np.stack([np.bincount(where, pull[:, f]) for f in range(k)], 1) + decay * model.factors[used]
            g_factors[used] += grad**2
            model.factors[used] -= rate * grad / np.sqrt(g_factors[used])
            g_bias += float(error.sum()) ** 2
            model.bias -= rate * float(error.sum()) / np.sqrt(g_bias)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = 4000, parts: int = 5, held_out: int = 0, **options) -> FactorisationMachine:
    """Fit on at most ``rows`` labelled documents outside the held-out fold; their feature vectors, of bounded width, come to the driver."""
    sample = labelled_sample(docs, labels, "quality", parts, held_out, rows, columns=("text", "n_chars"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        for b in batches:
            found = [features(t, None if pd.isna(n) else n, buckets) for t, n in zip(b["text"], b["n_chars"], strict=True)]
            yield pd.DataFrame({"id": b["_id"], "label": b["label"], "ids": [i for i, _ in found], "xs": [v for _, v in found]})

    rows_ = sample.mapInPandas(run, "id long, label int, ids array<long>, xs array<float>").toPandas().sort_values("id")
    found = [(np.asarray(i, np.int64), np.asarray(v, np.float32)) for i, v in zip(rows_["ids"], rows_["xs"], strict=True)]
    return fit(found, rows_["label"].to_numpy(np.float32), **options)


def score(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str = "n_chars", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns ``keep`` and ``score`` (0 to 1, higher is better) of every row, whole texts."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    fields = [id_col, text_col, n_chars_col, *[c for c in keep if c not in (id_col, text_col, n_chars_col)]]
    out = [id_col, *[c for c in keep if c != id_col]]
    schema = StructType([*[docs.schema[c] for c in out], StructField("score", DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        buckets, machine = _Buckets(), sent.value
        for batch in batches:
            texts, sizes = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            scores = []
            for at in range(0, len(texts), 256):
                found = [features(t, n, buckets) for t, n in zip(texts[at : at + 256], sizes[at : at + 256], strict=True)]
                z = np.clip(machine.logits(*_rows(found)).astype(np.float64), -60, 60)
                scores.append(1 / (1 + np.exp(-z)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(fields.index(c)) for c in out], pa.array(np.concatenate(scores) if scores else np.empty(0))], names=[*out, "score"]
            )

    return docs.select(*fields).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, keep: tuple[str, ...] = (), **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row (and columns ``keep``).

    Null and empty texts are scored by their structure alone; a null length
    counts as size class 0; repeated rows are scored alike; without labels of
    both classes every score is the share of ones; an empty table gives an
    empty one.
    """
    scored = score(docs, train(docs, labels, **options), keep=keep)
    return scored.select(
        "doc_id", *keep, (fold("doc_id", options.get("parts", 5)) == options.get("held_out", 0)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
