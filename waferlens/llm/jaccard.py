"""Exact Jaccard similarity of word-shingle sets, by which candidate pairs of near copies are verified."""

from __future__ import annotations

import numpy as np
import xxhash

from .shingles import shingle_hashes

WORDS = 5
#: The least similarity as a fraction, so that no rounding decides.
TOP, BOTTOM = 4, 5


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(text, WORDS))


def set_key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity; empty ones do with each other only."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return BOTTOM * both >= TOP * (len(a) + len(b) - both)

