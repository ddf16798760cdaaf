"""Hashes of many spans of an array at once, in blocks of fixed size."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 17  # elements that one pair of power tables covers; only a longer span needs more
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, ``n`` at least; tables beyond a block are not kept."""
    size = max(n, BLOCK + 1)
    if size in _powers:
        return _powers[size]
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    tables = np.cumprod(up), np.cumprod(down)
    if size == BLOCK + 1:
        _powers[size] = tables
    return tables


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[begin:end] for ascending, disjoint, non-empty spans; it doesn't depend on where a span stands."""
    out = np.empty(len(begin), np.uint64)
    k = 0
    while k < len(begin):
        last = max(k + 1, int(np.searchsorted(end, begin[k] + BLOCK, "right")))
        low, high = int(begin[k]), int(end[last - 1])
        up, down = powers(high - low + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[low:high] * up[: high - low])))
        x, y = begin[k:last] - low, end[k:last] - low
        out[k:last] = mix((total[y] - total[x]) * down[x] + (y - x).astype(np.uint64))
        k = last
    return out
