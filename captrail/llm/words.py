"""Word and word-sequence hashes of whole texts, vectorised within a task."""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

#: Odd multipliers of the polynomial and the mixer.
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text as UTF-8: runs without blank, tab, newline, vertical tab, form feed and return."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.translate(_LOWER) if lower else raw).split()


def hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, ws), np.uint64, len(ws))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def sequences(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words, by the hashes of the words; empty if there are fewer."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out = out * _A + h[k : len(h) - n + 1 + k]
    return mixed(out)


def minimisers(m: np.ndarray, width: int) -> np.ndarray:
    """For each window of width sequence hashes, the place of its smallest, the leftmost of equals."""
    if len(m) < width:
        return np.zeros(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(m, width).argmin(axis=1) + np.arange(len(m) - width + 1)
