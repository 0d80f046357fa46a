"""Flat byte views of Arrow string columns and vectorised hashes of byte ranges.

A batch of texts is one ``uint8`` array plus row offsets, so words, lines and windows of all rows
are found with a few NumPy passes.  Range hashes are differences of a running polynomial sum over
random 64-bit byte values (mod 2**64), scaled back to position zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
MASK = (1 << 64) - 1
# The ASCII white space that separates words.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix((np.arange(256, dtype=U64) + U64(seed * 256 + 1)) * U64(0x9E3779B97F4A7C15))


IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACE_BYTES, np.uint8))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `limit` text bytes (a longer text is a part alone)."""
    if batch.num_rows == 0:
        return
    _, offsets = column_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


class RangeHash:
    """Hashes of byte ranges of one flat array: equal bytes give equal values wherever they stand."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        self.seed = seed
        self.up, self.down = self._tables(seed, len(data) + 1)
        terms = _byte_values(seed)[data]
        terms *= self.up[: len(data)]
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(terms, out=self.sums[1:])

    @classmethod
    def _tables(cls, seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(seed)
        if have is None or len(have[0]) < n:
            base = (0xD1342543DE82EF95 + 2 * 0x9E3779B97F4A7C15 * seed) & MASK | 1
            size = 1 << max(16, (n - 1).bit_length())

            def powers(x: int) -> np.ndarray:
                steps = np.full(size, x, U64)
                steps[0] = 1
                return np.cumprod(steps, dtype=U64)

            have = powers(base), powers(pow(base, -1, 1 << 64))
            if size <= 1 << 23:
                cls._powers[seed] = have
        return have

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U64))


class Words:
    """Word spans ([^\\x20\\x09-\\x0D]+) of all rows of a flat array."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.rows = len(offsets) - 1
        inside = ~IS_SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | first[1:-1]
        self.inside = inside
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(end) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.row, minlength=self.rows)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flagged bytes each row has."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
