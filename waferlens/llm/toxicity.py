"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs of a step are a word's own vector (words of the training vocabulary;
one shared vector for all others) and the mean of its character trigrams'
vectors.  Runs of word characters longer than ``LONGEST`` are several words, so
that scripts without spaces and glued words are read to their end.  The
network reads overlapping windows of a text, attention pools the states of
both directions, and a document scores as its highest window.  It is written
and trained in numpy.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .labelled import fold, labelled_sample

WINDOW, STRIDE = 48, 36
DIM, HIDDEN, ATTENTION = 8, 8, 8
GRAMS = 4096
THRESHOLD = 0.3
PAD, OTHER = 0, 1
#: Characters of a word; what is longer goes on as the next word.
LONGEST = 24
_WORD = re.compile(rf"\w{{1,{LONGEST}}}")
TABLE_ROWS = 200_000
#: Random windows of a text that an epoch may train on beside the most suspect one.
DRAWN = 4


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def window_starts(n: int) -> list[int]:
    """Starts of all overlapping windows of n words; the last one ends with the text, and an empty text has one window of padding."""
    if n <= WINDOW:
        return [0]
    starts = [*range(0, n - WINDOW, STRIDE)]
    return [*starts, n - WINDOW]


def gram_numbers(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the byte trigrams of all words, edges marked, and each word's first place."""
    raw = [b"\x02" + w.encode("utf-8", "surrogatepass") + b"\x03" for w in words]
    sizes = np.array([len(r) for r in raw])
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    ends = np.cumsum(sizes)
    # A word of one byte has three bytes with its edges, so each word has a trigram.
    keep = np.ones(len(flat), bool)
    keep[ends - 1] = False
    keep[ends - 2] = False
    at = np.flatnonzero(keep)
    grams = (flat[at] * 961 + flat[at + 1] * 31 * 7 + flat[at + 2] * 13) % GRAMS
    return grams, np.concatenate([[0], np.cumsum(sizes - 2)[:-1]])


@dataclass
class Network:
    vocabulary: dict[str, int]  # word numbers from 2
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, vocabulary: dict[str, int], odds: np.ndarray, seed: int = 11) -> Network:
        """``odds``: a log ratio for each word number, with which the first entry of its vector starts."""
        rng = np.random.default_rng(seed)

        def start(*shape: int, scale: float = 0.1) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        p = {"words": start(len(odds), DIM), "grams": start(GRAMS, DIM), "att_w": start(2 * HIDDEN, ATTENTION, scale=0.3), "att_v": start(ATTENTION, scale=0.3), "out": start(2 * HIDDEN, scale=0.3), "out_b": np.zeros(1, np.float32)}
        p["words"][:, 0] = odds
        for d in "fb":
            p |= {f"w_{d}": start(2 * DIM, 3 * HIDDEN, scale=0.4), f"u_{d}": start(HIDDEN, 3 * HIDDEN, scale=0.3), f"b_{d}": np.zeros(3 * HIDDEN, np.float32)}
        return cls(vocabulary, p)

    def char_vectors(self, words: Sequence[str]) -> np.ndarray:
        grams, starts = gram_numbers(words)
        counts = np.diff(np.r_[starts, len(grams)])
        return np.add.reduceat(self.p["grams"][grams], starts) / counts[:, None].astype(np.float32)

    def inputs(self, words: Sequence[str]) -> np.ndarray:
        numbers = np.fromiter((self.vocabulary.get(w, OTHER) for w in words), np.int64, len(words))
        return np.concatenate([self.p["words"][numbers], self.char_vectors(words)], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _direction(gates: np.ndarray, u: np.ndarray, tape: list | None = None) -> np.ndarray:
    """Hidden states (steps x rows x HIDDEN) from the input parts of the gates (steps x rows x 3 HIDDEN)."""
    steps, rows, _ = gates.shape
    h = np.zeros((rows, HIDDEN), np.float32)
    out = np.empty((steps, rows, HIDDEN), np.float32)
    for t in range(steps):
        r = h @ u
        zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])
        z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(gates[t, :, 2 * HIDDEN :] + reset * r[:, 2 * HIDDEN :])
        if tape is not None:
            tape.append((h, z, reset, n, r[:, 2 * HIDDEN :]))
        h = n + z * (h - n)
        out[t] = h
    return out


def _pool(p: dict[str, np.ndarray], states: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Attention over steps; padding has no weight unless a row has nothing else."""
    a = np.tanh(states @ p["att_w"])
    e = np.where(real | ~real.any(0), a @ p["att_v"], np.float32(-1e9))
    e = np.exp(e - e.max(0))
    weight = e / e.sum(0)
    context = np.einsum("tb,tbh->bh", weight, states)
    return context @ p["out"] + p["out_b"], a, weight, context


class Scorer:
    """Scores texts; a bounded table keeps the input parts of the gates of words seen before."""

    def __init__(self, net: Network) -> None:
        self.net = net
        p = net.p
        self._w = np.concatenate([p["w_f"], p["w_b"]], 1)
        self._b = np.concatenate([p["b_f"], p["b_b"]])
        self._fresh()

    def _fresh(self) -> None:
        pad = np.concatenate([self.net.p["words"][PAD], np.zeros(DIM, np.float32)])
        self._table = np.zeros((1024, 6 * HIDDEN), np.float32)
        self._table[0] = pad @ self._w + self._b
        self._numbers: dict[str, int] = {}

    def _rows(self, docs: list[list[str]]) -> list[np.ndarray]:
        if len(self._numbers) > TABLE_ROWS:
            self._fresh()
        known = self._numbers
        new = list(set().union(*docs) - known.keys())
        if new:
            first = len(known) + 1
            while len(self._table) < first + len(new):
                self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            for i in range(0, len(new), 8192):
                part = new[i : i + 8192]
                self._table[first + i : first + i + len(part)] = self.net.inputs(part) @ self._w + self._b
            known.update(zip(new, range(first, first + len(new)), strict=True))
        return [np.fromiter(map(known.__getitem__, d), np.int32, len(d)) for d in docs]

    def windows(self, rows: np.ndarray, at_once: int = 1024) -> np.ndarray:
        """Logits of windows, given as table rows (windows x WINDOW)."""
        out = []
        for i in range(0, len(rows), at_once):
            part = rows[i : i + at_once].T
            gates = self._table[part]
            forward = _direction(gates[:, :, : 3 * HIDDEN], self.net.p["u_f"])
            backward = _direction(gates[::-1, :, 3 * HIDDEN :], self.net.p["u_b"])[::-1]
            out.append(_pool(self.net.p, np.concatenate([forward, backward], 2), part != PAD)[0])
        return np.concatenate(out) if out else np.empty(0, np.float32)

    def single(self, windows: list[list[str]]) -> np.ndarray:
        """Logits of windows that are given as words."""
        rows = np.zeros((len(windows), WINDOW), np.int32)
        for k, own in enumerate(self._rows(windows)):
            rows[k, : len(own)] = own
        return self.windows(rows)

    def documents(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows of all documents, and the place of each document's first window."""
        rows_of = self._rows(docs)
        starts = [window_starts(len(d)) for d in rows_of]
        firsts = np.concatenate([[0], np.cumsum([len(s) for s in starts])]).astype(np.int64)
        rows = np.zeros((firsts[-1], WINDOW), np.int32)
        for d, own, k in zip(rows_of, starts, firsts.tolist(), strict=False):
            if len(own) == 1:
                rows[k, : len(d)] = d
            else:
                rows[k : k + len(own)] = d[np.array(own)[:, None] + np.arange(WINDOW)]
        return self.windows(rows), firsts[:-1]

    def texts(self, texts: Sequence[str | None]) -> np.ndarray:
        """A logit for each text: its highest window."""
        if not texts:
            return np.empty(0, np.float32)
        return np.maximum.reduceat(*self.documents([words_of(t) for t in texts]))


def _gradients(net: Network, numbers: np.ndarray, chars: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the weighted logistic loss over windows (WINDOW x rows); those of the inputs come second."""
    p = net.p
    x = np.concatenate([p["words"][numbers], chars], 2)
    tapes: dict[str, list] = {"f": [], "b": []}
    forward = _direction(x @ p["w_f"] + p["b_f"], p["u_f"], tapes["f"])
    backward = _direction((x @ p["w_b"] + p["b_b"])[::-1], p["u_b"], tapes["b"])[::-1]
    states = np.concatenate([forward, backward], 2)
    logit, a, share, context = _pool(p, states, numbers != PAD)
    error = ((_sigmoid(logit) - y) * weight).astype(np.float32)
    g = {"out": context.T @ error, "out_b": error.sum(keepdims=True)}
    d_context = error[:, None] * p["out"]
    d_share = np.einsum("bh,tbh->tb", d_context, states)
    d_e = share * (d_share - (share * d_share).sum(0))
    d_a = d_e[:, :, None] * p["att_v"] * (1 - a * a)
    g["att_v"] = np.einsum("tb,tbk->k", d_e, a)
    g["att_w"] = np.einsum("tbh,tbk->hk", states, d_a)
    d_states = share[:, :, None] * d_context + d_a @ p["att_w"].T
    d_x = np.zeros_like(x)
    for d, part in (("f", d_states[:, :, :HIDDEN]), ("b", d_states[::-1, :, HIDDEN:])):
        u, d_h = p[f"u_{d}"], np.zeros((x.shape[1], HIDDEN), np.float32)
        d_gates, g_u = np.empty((*x.shape[:2], 3 * HIDDEN), np.float32), np.zeros_like(u)
        for t in range(x.shape[0] - 1, -1, -1):
            h, z, reset, n, rn = tapes[d][t]
            d_h = d_h + part[t]
            d_n = d_h * (1 - z) * (1 - n * n)
            d_z = d_h * (h - n) * z * (1 - z)
            d_r = d_n * rn * reset * (1 - reset)
            d_gates[t] = np.concatenate([d_z, d_r, d_n], 1)
            d_rec = np.concatenate([d_z, d_r, d_n * reset], 1)
            g_u += h.T @ d_rec
            d_h = d_h * z + d_rec @ u.T
        if d == "b":
            d_gates = d_gates[::-1]
        g[f"u_{d}"], g[f"b_{d}"] = g_u, d_gates.sum((0, 1))
        g[f"w_{d}"] = np.einsum("tbi,tbo->io", x, d_gates)
        d_x += d_gates @ p[f"w_{d}"].T
    return g, d_x


def word_odds(counts: dict[str, tuple[int, int]], toxic: float, clean: float, vocabulary_rows: int = 20_000) -> tuple[dict[str, int], np.ndarray]:
    """Numbers of the most frequent and the most telling words, and the log ratio with which each one starts.

    ``counts``: in how many clean and toxic texts a word occurs.
    """
    ranked = sorted((w for w, c in counts.items() if sum(c) >= 3), key=lambda w: (-sum(counts[w]), w))
    strength = {w: np.log((counts[w][1] + 0.5) / (toxic + 1)) - np.log((counts[w][0] + 0.5) / (clean + 1)) for w in ranked}
    chosen = sorted({*ranked[: vocabulary_rows // 2], *sorted(ranked, key=lambda w: (-abs(strength[w]), w))[: vocabulary_rows // 2]})
    odds = np.array([0.0, 0.0, *[np.clip(strength[w], -2, 4) / 2 if sum(counts[w]) >= 5 else 0.0 for w in chosen]], np.float32)
    return {w: k + 2 for k, w in enumerate(chosen)}, odds


def _numbers(words: Sequence[str], vocabulary: dict[str, int]) -> np.ndarray:
    return np.fromiter((vocabulary.get(w, OTHER) for w in words), np.int64, len(words))


def look(docs: Sequence[Sequence[str]], seeds: Sequence[int], vocabulary: dict[str, int], odds: np.ndarray, scorer: Scorer | None = None, drawn: int = DRAWN) -> list[list[list[str]]]:
    """Of each text, given as words: its most suspect window, by the network or else by word odds, and ``drawn`` random ones.  Every window is looked at."""
    logits, firsts = scorer.documents([list(d) for d in docs]) if scorer is not None else (None, None)
    found = []
    for k, (words, seed) in enumerate(zip(docs, seeds, strict=True)):
        starts = window_starts(len(words))
        if logits is not None:
            own = logits[firsts[k] : firsts[k] + len(starts)]
        else:
            each = odds[_numbers(words, vocabulary)]
            own = np.array([each[s : s + WINDOW].max(initial=-9) for s in starts])
        at = [int(np.argmax(own)), *np.random.default_rng(seed).integers(len(starts), size=drawn).tolist()]
        found.append([list(words[starts[i] : starts[i] + WINDOW]) for i in at])
    return found


def fit(texts: Sequence[str | None], labels: Sequence[int], vocabulary_rows: int = 20_000, **options) -> Network:
    """Fit on texts that are here as a whole."""
    docs = [words_of(t) for t in texts]
    counts: dict[str, list[int]] = {}
    for d, label in zip(docs, labels, strict=True):
        for w in set(d):
            counts.setdefault(w, [0, 0])[label] += 1
    toxic = sum(labels)
    known = word_odds(counts, toxic, len(labels) - toxic, vocabulary_rows)

    def looked(net: Network | None, epoch: int, rows: Sequence[int]) -> dict[int, list[list[str]]]:
        found = look([docs[i] for i in rows], [1000 * epoch + i for i in rows], *known, Scorer(net) if net else None)
        return dict(zip(rows, found, strict=True))

    return fit_windows(looked, labels, *known, **options)


def fit_windows(looked: Callable[[Network | None, int, Sequence[int]], dict[int, list[list[str]]]], labels: Sequence[int], vocabulary: dict[str, int], odds: np.ndarray, epochs: int = 12, rate: float = 0.02, seed: int = 11, clean_a_toxic: int = 8) -> Network:
    """Adam over windows of the texts.

    ``looked`` (network or None, epoch, numbers of texts) looks at every
    window of these texts and gives of each the most suspect one and some
    random ones.  A toxic text stands for its most suspect window, at first by
    word odds and then by the network of that epoch; clean texts give their
    most suspect window and random ones.
    """
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    toxic, clean = float(y.sum()), float(len(y) - y.sum())
    net = Network.new(vocabulary, odds)
    if not toxic or not clean:
        net.p["out"][:] = 0
        net.p["out_b"][:] = np.log((toxic + 1e-3) / (clean + 1e-3)) if len(y) else 0
        return net
    windows = looked(None, 0, range(len(y)))
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    step = 0
    positive, negative = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    for epoch in range(epochs):
        if epoch >= 3:
            chosen = np.concatenate([positive, rng.choice(negative, min(len(negative), 4 * len(positive)), replace=False)])
            windows |= looked(net, epoch, chosen.tolist())
        picks = [(i, 0) for i in positive]
        n_clean = min(len(negative) * 2, clean_a_toxic * len(positive))
        for i in rng.choice(negative, n_clean):
            picks.append((i, 0 if rng.random() < 0.5 else int(rng.integers(len(windows[i])))))
        picks = [picks[k] for k in rng.permutation(len(picks))]
        for at in range(0, len(picks), 128):
            part = picks[at : at + 128]
            own = [windows[i][k] for i, k in part]
            ids = np.zeros((WINDOW, len(part)), np.int64)
            for c, (i, k) in enumerate(part):
                ids[: len(own[c]), c] = _numbers(windows[i][k], vocabulary)
            flat = [w for o in own for w in o]
            chars = np.zeros((WINDOW, len(part), DIM), np.float32)
            where_t = np.concatenate([np.arange(len(o)) for o in own]).astype(np.int64)
            where_b = np.repeat(np.arange(len(part)), [len(o) for o in own])
            if flat:
                grams, firsts = gram_numbers(flat)
                counts = np.diff(np.r_[firsts, len(grams)])
                chars[where_t, where_b] = np.add.reduceat(net.p["grams"][grams], firsts) / counts[:, None]
            target = y[[i for i, _ in part]]
            # Some words count as unknown, so that their characters learn too.
            ids = np.where((ids > OTHER) & (rng.random(ids.shape) < 0.1), OTHER, ids)
            g, d_x = _gradients(net, ids, chars, target, np.full(len(part), 1 / len(part), np.float32))
            d_words = d_x[:, :, :DIM]
            g["words"] = np.stack([np.bincount(ids.ravel(), d_words[:, :, f].ravel(), len(odds)) for f in range(DIM)], 1).astype(np.float32)
            g["grams"] = np.zeros_like(net.p["grams"])
            if flat:
                each = np.repeat(d_x[where_t, where_b, DIM:] / counts[:, None], counts, axis=0)
                g["grams"] = np.stack([np.bincount(grams, each[:, f], GRAMS) for f in range(DIM)], 1).astype(np.float32)
            step += 1
            for name, grad in g.items():
                grad = grad + 1e-5 * net.p[name]
                m[name] += 0.1 * (grad - m[name])
                v[name] += 0.001 * (grad * grad - v[name])
                net.p[name] -= (rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-6)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, rows: int = 6000, parts: int = 4, held_out: int = 2, vocabulary_rows: int = 20_000, **options) -> Network:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    Words are counted over their whole texts.  In every epoch tasks score all
    windows of these texts by the network so far, and of each text its most
    suspect window and ``DRAWN`` random ones come to the driver, whatever the
    length.
    """
    sample = labelled_sample(docs, labels, "toxic", parts, held_out, rows)
    # Every epoch's scoring is dealt over so many tasks.
    sample = cut(sample.repartition(max(1, rows // 250), "_id"), "labelled")
    kind = sample.schema["_id"].dataType.simpleString()
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one row a class
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = sorted(set(words_of(text)))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([label] * len(own), pa.int32())], names=["word", "label"])

    held = F.sum("label").cast("int")
    counts = sample.select("label", "text").mapInArrow(words, "word string, label int").groupBy("word").agg((F.count("*") - F.sum("label")).cast("int").alias("clean"), held.alias("toxic"))
    counts = cut(counts.filter(F.col("clean") + F.col("toxic") >= 3), "words")
    # The same order as word_odds: the most frequent words and the most telling ones, at most ``vocabulary_rows`` in all.
    strength = F.abs(F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1)))
    most = [counts.orderBy(F.desc(order), "word").limit(vocabulary_rows // 2) for order in (F.col("clean") + F.col("toxic"), strength)]
    found = most[0].union(most[1]).distinct().collect()
    known = word_odds({r["word"]: (r["clean"], r["toxic"]) for r in found}, toxic, clean, 2 * len(found))
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def looked(net: Network | None, epoch: int, chosen: set | None) -> list[tuple]:
        """(id, label, windows) of the chosen texts, or of all."""
        current = docs.sparkSession.sparkContext.broadcast((net, chosen))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, only = current.value
            scorer = Scorer(held) if held else None
            for b in batches:
                columns = [c.to_pylist() for c in b.columns]
                at = [k for k, key in enumerate(columns[0]) if only is None or key in only]
                for part in (at[i : i + 128] for i in range(0, len(at), 128)):
                    keys = [columns[0][k] for k in part]
                    found = look([words_of(columns[2][k]) for k in part], [zlib.crc32(f"{epoch}:{key}".encode()) for key in keys], *sent.value, scorer)
                    own = [[" ".join(w) for w in ws] for ws in found]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array([columns[1][k] for k in part], pa.int32()), pa.array(own, pa.list_(pa.string()))], names=["id", "label", "windows"])

        # At most ``rows`` texts with a few windows each.
        return [(r["id"], r["label"], [w.split() for w in r["windows"]]) for r in sample.select("_id", "label", "text").mapInArrow(run, f"id {kind}, label int, windows array<string>").collect()]

    first = sorted(looked(None, 0, None))
    ids, numbers = [r[0] for r in first], {r[0]: k for k, r in enumerate(first)}

    def of_numbers(net: Network | None, epoch: int, chosen: Sequence[int]) -> dict[int, list[list[str]]]:
        if net is None:
            return {k: r[2] for k, r in enumerate(first)}
        return {numbers[r[0]]: r[2] for r in looked(net, epoch, {ids[k] for k in chosen})}

    return fit_windows(of_numbers, [r[1] for r in first], *known, **options)


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` (0 to 1) of every row: all windows of the whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                z = scorer.texts(part.column(1).to_pylist()).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))))], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Null and empty texts are one window of padding; very long ones are scored
    by all their windows; repeated rows are scored alike, ties of windows do
    not matter; null ids keep their row; without labels of both classes every
    score is the share of toxic ones; an empty table gives an empty one; other
    columns are ignored.
    """
    scored = score(docs, train(docs, labels, **options))
    return scored.select(
        "doc_id", (fold("doc_id", options.get("parts", 4)) == options.get("held_out", 2)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
