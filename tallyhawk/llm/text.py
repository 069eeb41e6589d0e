"""Words of whole texts, vectorised over the bytes of Arrow batches.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Words are carried as
64-bit hashes: a polynomial over random byte values modulo 2^64, then mixed. Two
different words share a hash with probability about 2^-56.

A batch is worked on in slices of about ``SLICEBYTES`` of text (a longer document is
a slice of its own), so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICEBYTES = 1 << 21
#: For work that holds some dozens of bytes for each of a slice's: it is faster in small slices, too.
SMALL_SLICE = 1 << 19
U = np.uint64

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BYTE = np.random.default_rng(20240101).integers(0, 1 << 63, size=256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM = U(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def power(which: str, n: int) -> np.ndarray:
    """1, x, x^2, ... for the hash base (``up``) or its inverse (``down``), at least ``n`` of them."""
    if len(_powers[which]) < n:
        x = _BASE if which == "up" else _INVERSE
        steps = np.full(max(n, SMALL_SLICE + 1, 2 * len(_powers[which])), x, dtype=U)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (the splitmix64 finaliser)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, kind)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets.astype(np.int64)


def slices(column: pa.Array, max_bytes: int = SLICEBYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) for runs of rows of about ``max_bytes``."""
    data, offsets = buffers(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Words of the documents of one slice: ``hash``, ``doc`` (row in the slice), byte ``start`` and ``end``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        n = len(data)
        space = SPACE[data]
        after = np.empty(n, dtype=bool)
        before = np.empty(n, dtype=bool)
        if n:
            after[0] = before[-1] = True
            after[1:] = space[:-1]
            before[:-1] = space[1:]
            edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
            after[edge] = True
            before[edge - 1] = True
        word = ~space
        self.start = np.flatnonzero(word & after)
        self.end = np.flatnonzero(word & before) + 1
        total = np.zeros(n + 1, dtype=U)
        np.cumsum((BYTE[LOWER] if lower else BYTE)[data] * power("up", n), out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * power("down", n + 1)[self.start])
        self.rows = len(offsets) - 1
        self.first = np.concatenate((np.searchsorted(self.start, offsets[:-1]), [len(self.start)]))
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.rows), self.count)


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside one document, and the index of each run's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h = np.zeros(n, dtype=U)
    for j in range(k):
        h = h * _GRAM + hashes[j:j + n]
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    return mix(h[at]), at


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return np.ascontiguousarray(h).view(np.int64)
