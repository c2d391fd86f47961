"""Vector operations on the UTF-8 bytes of a column of texts.

Words are the runs of bytes other than \\x20 and \\x09-\\x0D, so no text has to
be decoded. A word's hash comes from prefix sums of a polynomial modulo 2**64,
which numpy takes for all words of a slice at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NOT_SPACE = (~SPACE).astype(np.uint8)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, np.ndarray] = {}

#: Bytes of text worked on at once, unless a single text is longer.
SLICE_BYTES = 262_144


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown on demand."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        out = np.full(size, base, dtype=U)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= SLICE_BYTES + 1:
            _powers[base] = have
    return have


class Slice:
    """Some rows of a text column: their bytes, and where each row begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Slice:
        return Slice(LOWER[self.data], self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and the first word of each row (one more at the end)."""
        return self.runs(_NOT_SPACE)

    def runs(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for runs of bytes of one kind; kinds has a number for each byte value, 0 for none."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(len(self.offsets), dtype=np.int64)
        kind = kinds[self.data]
        inside = kind != 0
        starts, ends = inside.copy(), inside.copy()
        turns = kind[1:] != kind[:-1]
        starts[1:] &= turns
        ends[:-1] &= turns
        edge = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        starts[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span."""
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum((self.data.astype(U) + U(1)) * _power(_BASE, n + 1)[:n], out=sums[1:])
        back = _power(pow(_BASE, -1, 2**64), n + 1)
        return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Slice]]:
    """(first row, end row, Slice) over a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, where, raw = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64, count=n + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j, Slice(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i+1]] for each row, 0 for empty rows."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:]), dtype=values.dtype), np.cumsum(values, axis=0)])
    return sums[first[1:]] - sums[first[:-1]]
