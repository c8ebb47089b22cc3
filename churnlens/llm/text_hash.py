"""Hashes of words and word shingles in numpy, shared by the operators that run in Python tasks."""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (bytes.lower and bytes.split are ASCII-only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, ws), np.uint64, len(ws))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all windows of ``size`` words; a shorter text is one shingle; no word, none."""
    n = len(h)
    if n == 0:
        return h
    k = min(size, n)
    s = h[: n - k + 1].copy()
    for j in range(1, k):
        s = s * _MUL + h[j : n - k + 1 + j]
    return np.unique(mixed(s * _MUL + np.uint64(k)))
