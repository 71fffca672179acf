"""Texts as byte arrays: words, spans and their 64-bit hashes, computed for many texts at once.

Hashes are sums of byte values times powers of an odd number, modulo 2^64; dividing by the
power of the start makes the hash of a span independent of where it lies. They are mixed, so
that their order and their low bits behave like random numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
ODD = U64(0x9E3779B97F4A7C15)
SLICE_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that stand in words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes that stand in words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE_VALUE = mix((np.arange(256, dtype=U64) + U64(1)) * ODD)
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((int(ODD), pow(int(ODD), -1, 1 << 64))):
            table = np.full(n, base, U64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


class Spans:
    """Hashes of any spans of one byte array."""

    def __init__(self, data: np.ndarray):
        powers, self._inverse = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE_VALUE[data] * powers[: len(data)], out=self._sums[1:])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._inverse[start])

    def fixed(self, size: int, first: int, last: int) -> np.ndarray:
        """Hashes of the spans of one size that start at first .. last - 1."""
        return mix((self._sums[first + size : last + size] - self._sums[first:last]) * self._inverse[first:last])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of each; null is the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column) or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes each, or of one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, bytes, offsets) of each slice of a text column."""
    data, offsets = text_bytes(column)
    for first, last in row_slices(offsets, limit):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of all words, and for each text the number of words before it."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    mark = in_word[data]
    before = np.zeros(n, bool)
    before[1:] = mark[:-1]
    before[offsets[offsets < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = mark[1:]
    after[offsets[offsets > 0] - 1] = False
    start = np.flatnonzero(mark & ~before)
    return start, np.flatnonzero(mark & ~after) + 1, np.searchsorted(start, offsets)


def text_of_word(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k word hashes; empty if there are fewer."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, U64(k))
    for i in range(k):
        out = out * ODD + h[i : n + i]
    return mix(out)


def whole_grams(first: np.ndarray, k: int) -> np.ndarray:
    """Which runs of k words lie in one text."""
    n = max(0, int(first[-1]) - k + 1)
    return np.arange(n) + k <= np.repeat(first[1:], np.diff(first))[:n]


def sum_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i] : bounds[i + 1]]."""
    out = np.zeros(len(bounds) - 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        out[filled] = np.add.reduceat(values, bounds[:-1][filled], dtype=out.dtype)
    return out


def batch(**columns) -> pa.RecordBatch:
    """A record batch from (values, Arrow type) pairs or Arrow arrays, in the given order."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c[0], type=c[1]) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))
