"""Texts as flat arrays inside a task: bytes, words, and hashes of any stretch.

An Arrow column of strings is one buffer of bytes with offsets, so whole batches
are split into words and hashed without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def values(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_ODD) + U64(seed))


#: A value per byte; two bytes never share one.
BYTE = values(256, 1)
LOWERED = BYTE.copy()
LOWERED[ord("A") : ord("Z") + 1] = BYTE[ord("a") : ord("z") + 1]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = [np.ones(1, U64), np.ones(1, U64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, n of each at least."""
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for at, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Hashes:
    """64-bit hashes of any stretches of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        power, self._inverse = _grown(len(symbols) + 1)
        self._sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * power[: len(symbols)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start])

    def runs(self, length: int) -> np.ndarray:
        """The hash of every stretch of that length, by start."""
        n = len(self._sums) - length
        return mix((self._sums[length:] - self._sums[:n]) * self._inverse[:n]) if n > 0 else np.zeros(0, U64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of texts or bytes; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def parts(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together hold about `limit` bytes, one text at least."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end
        at = end


class Words:
    """The words of a run of texts: their byte ranges, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~IS_SPACE[data]
        begins = np.diff(inside)[:-1] > 0
        ends = np.diff(inside)[1:] < 0
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        begins[edge] |= inside[edge + 1] > 0
        ends[edge - 1] |= inside[edge] > 0
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: Text i has the words first[i] to first[i + 1].
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, values: np.ndarray = BYTE) -> np.ndarray:
        if not len(self.data):
            return np.zeros(0, U64)
        return Hashes(values[self.data]).of(self.start, self.end)


def signed(x: np.ndarray) -> np.ndarray:
    """As Spark's bigint."""
    return x.astype(U64, copy=False).view(np.int64)


def lists(flat_values: pa.Array, starts: np.ndarray) -> pa.Array:
    """A list column; row i holds the values from starts[i] to starts[i + 1]."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), flat_values)
