"""Words of whole Arrow text columns as NumPy arrays: where they lie, which row they belong to, 64-bit hashes.

Rows are handled in slices of half a megabyte, so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_table(separators: list[tuple[int, int]], lower: bool) -> np.ndarray:
    """Code of each byte: 0 for separators (inclusive ranges), else the byte plus 1, A-Z as a-z if ``lower``."""
    table = np.arange(1, 257, dtype=np.uint16)
    if lower:
        table[0x41:0x5B] += 32
    for first, last in separators:
        table[first : last + 1] = 0
    return table


SPACED = word_table([(0x20, 0x20), (0x09, 0x0D)], lower=False)
SPACED_LOWER = word_table([(0x20, 0x20), (0x09, 0x0D)], lower=True)
ALNUM_LOWER = word_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)], lower=True)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1)
            up, down = np.full(n, BASE), np.full(n, INVERSE)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)


_POWERS = _Powers()


@dataclass
class Words:
    """Words of rows ``first`` to ``first + rows``: byte ranges in ``data``, row numbers from 0, hashes."""

    first: int
    rows: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray  # words of row r are bounds[r] to bounds[r + 1]

    def text(self, word: int) -> bytes:
        return self.data[self.start[word] : self.end[word]].tobytes()


def words_of(first: int, data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """The words of the texts that lie between ``offsets`` in ``data``; row bounds end words, too."""
    code = table[data]
    inside = code != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] = inside[cuts]
    start = np.flatnonzero(begins)
    stops = np.empty(len(data) + 1, bool)
    stops[:-1] = ~inside | begins
    stops[-1] = True
    stop = np.flatnonzero(stops)
    end = stop[np.searchsorted(stop, start + 1)] if len(start) else start
    _POWERS.grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code * _POWERS.up[: len(data)], out=sums[1:])
    value = (sums[end] - sums[start]) * _POWERS.down[start]
    bounds = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(first, len(offsets) - 1, data, start, end, row, mix(value + (end - start).astype(np.uint64)), bounds)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of up to ``limit`` bytes, or one longer row; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, len(column))
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each ``n`` consecutive word hashes; shorter by n - 1. The caller drops those across rows."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = out * BASE + words[i : i + count]
    return mix(out)
