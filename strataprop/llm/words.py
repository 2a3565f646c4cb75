"""Words, lines and n-grams of many texts at once, as numpy arrays over UTF-8 bytes.

An Arrow text column is taken apart in blocks of whole texts, about half a megabyte each, so that
memory follows the block (or the longest text) and not the batch. Words are never built as Python
strings: a word is a pair of byte positions and a 64-bit hash. The hash is a polynomial over
randomly mapped bytes, taken from running sums, so one pass gives the hash of any byte range.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(7919).integers(0, 1 << 64, 256, dtype=np.uint64)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_STEPS = np.random.default_rng(104729).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: As WHITE, and all other ASCII characters that are no letter or digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Block(NamedTuple):
    """Whole texts side by side. Text k has the bytes bounds[k] to bounds[k + 1]."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def texts(self) -> int:
        return len(self.bounds) - 1

    def ranges(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the runs free of separators, and each text's first run (and the end)."""
        apart = separators[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.bounds] = True
        before = np.empty_like(apart)
        before[:1], before[1:] = True, apart[:-1]
        starts = np.flatnonzero(~apart & (before | edge[:-1]))
        after = np.empty_like(apart)
        after[-1:], after[:-1] = True, apart[1:]
        ends = np.flatnonzero(~apart & (after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def sums(self, fold: bool = False) -> np.ndarray:
        """Running sums from which hash_ranges takes the hash of any byte range."""
        total = np.zeros(len(self.data) + 1, np.uint64)
        values = (_FOLDED if fold else _BYTES)[self.data]
        values *= _powers_up_to(len(self.data) + 1)[0][: len(self.data)]
        np.cumsum(values, out=total[1:])
        return total


def hash_ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; equal ranges have equal hashes."""
    inverse = _powers_up_to(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a text column, in order; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        lo, hi = offsets[row], offsets[end]
        yield Block(row, data[lo:hi], offsets[row : end + 1] - lo)
        row = end


def ngrams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start index and hash of every run of n words inside one text, in order."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    windows = len(hashes) - n + 1
    total = hashes[:windows] * _STEPS[0]
    for j in range(1, n):
        total += hashes[j : j + windows] * _STEPS[j]
    inside = np.ones(windows, bool)
    for edge in bounds[1:-1]:  # a window that starts up to n - 1 words before an edge crosses it
        inside[max(0, edge - n + 1) : min(edge, windows)] = False
    starts = np.flatnonzero(inside)
    return starts, mix(total[starts] + np.uint64(n))


def occurrences(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether an equal one stands before it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    twice[order], later[order] = same[1:] | same[:-1], same[:-1]
    return twice, later


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring bounds."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_of(bounds: np.ndarray) -> np.ndarray:
    """The text that each item between the bounds belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def range_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> pa.StringArray:
    """The byte ranges as strings, A-Z as a-z with ``fold``."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    found = data[np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])]
    if fold:
        found = np.where((found >= 65) & (found < 91), found + 32, found).astype(np.uint8)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(found)))
