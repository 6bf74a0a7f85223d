"""Vectorised hashing of words and windows over the bytes of many documents.

Hashes have 64 bits and are the same in every task. A window hash is a polynomial modulo 2^64 taken from prefix sums.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEPS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power(_BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to its end."""
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; words end at white space and at the end of a document."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[0] = after[-1] = True
    before[edges], after[edges - 1] = True, True
    starts, ends = np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def window_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values; callers drop windows that cross documents."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = values[:count] * _STEPS[0]
    for k in range(1, n):
        total += values[k:k + count] * _STEPS[k]
    return mix(total)


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values."""
    best, width = values, 1
    while 2 * width <= n:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    rest = n - width
    return np.minimum(best[:len(best) - rest], best[rest:]) if rest else best
