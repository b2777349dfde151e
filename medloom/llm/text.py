"""Whole-batch text helpers: words, windows and their 64-bit hashes over Arrow string buffers.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. All functions work on the UTF-8 bytes of a chunk of rows at once, so no
Python object is made per word. Hashes depend on the bytes alone; two different words agree with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

# Rows are cut into chunks of about this many bytes, so that the arrays below stay small. One longer text is its own chunk.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (wraps modulo 2**64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n, CHUNK_BYTES) + 1, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
        if n > 4 * CHUNK_BYTES:  # an outsize text is not kept in mind
            del _powers[base]
    return have


@dataclass
class Words:
    """Rows of a chunk. ``first[d]:first[d + 1]`` are the words of row d; spans are byte positions in ``data``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    space: np.ndarray
    _sum: np.ndarray = field(repr=False)

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = _power(_BASE_INVERSE, len(self.data))
        return mix((self._sum[ends] - self._sum[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.count)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are flagged."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    space = SPACE[data]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    before[inner] = True
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n)[:n], out=summed[1:])
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), space, summed)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` successive words from each position on; row bounds are the caller's business."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _U(0xD6E8FEB86659FD93) + hashes[k : k + n]
    return mix(out)


def within_rows(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Of the n windows of ``windows``, which lie inside one row."""
    last = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + size <= last


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw[:0], offsets - offsets[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) in chunks of about ``most`` bytes."""
    if not len(column):
        return
    data, offsets = buffers(column)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
