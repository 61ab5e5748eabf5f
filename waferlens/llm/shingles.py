"""Hashes of word shingles."""

from __future__ import annotations

import numpy as np
import regex
import xxhash

SEED = 42
_LOWER = {c: c + 32 for c in range(65, 91)}
_OTHER_SPACES = regex.compile(r"[\x09-\x0D]")


def _spans(text: str | None, words: int) -> tuple[bytes, list[int], list[int]]:
    """The words joined by single spaces, and first and last place of every shingle; of the whole sequence when it is shorter."""
    if not text:
        return b"", [], []
    # A-Z only; white space is space and \x09-\x0D only.
    text = text.lower() if text.isascii() else text.translate(_LOWER)
    parts = [p for p in _OTHER_SPACES.sub(" ", text).encode("utf-8", "surrogatepass").split(b" ") if p]
    line = b" ".join(parts)
    n = len(parts)
    if n <= words:
        return line, [0] if n else [], [len(line)] if n else []
    ends, at = [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    return line, [0, *[e + 1 for e in ends[: n - words]]], ends[words - 1 :]


def shingle_hashes(text: str | None, words: int = 4) -> np.ndarray:
    """Unsigned XXH64 of every shingle, repeats included; of the whole word sequence when it is shorter; none without words."""
    line, starts, ends = _spans(text, words)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> np.uint64:
    """The 64 bits that are set in over half of the hashes; zero without any."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        part = hashes[i : i + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A second, independent word of each hash: the finaliser of a public 64-bit generator (multiply, xor-shift)."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
