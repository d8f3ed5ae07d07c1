"""Words and shingles of Arrow text columns as numpy arrays, in chunks of bounded size.

Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SAME_CASE = np.arange(256, dtype=np.uint8)
LOWER = SAME_CASE.copy()
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Chunk(NamedTuple):
    """Some rows of a column: their bytes end to end, and where each row begins and ends."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a text column in order; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield Chunk(i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


class Words(NamedTuple):
    """The words of a chunk: hash, first byte, byte after the last, and the first word of each row."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def of(self, row: int) -> slice:
        return slice(self.rows[row], self.rows[row + 1])


def words(chunk: Chunk, case: np.ndarray = SAME_CASE) -> Words:
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64))
    inside = ~SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, dtype=np.uint64), starts, ends, rows)
    lengths = ends - starts
    place = np.arange(n)
    place -= np.repeat(np.append(starts[0] * 0, starts), np.diff(np.concatenate(([0], starts, [n]))))
    longest = int(lengths.max())
    np.minimum(place, longest - 1, out=place)
    value = (case[data].astype(np.uint64) + np.uint64(1)) * _powers(longest)[place]
    value[~inside] = 0
    hashes = np.add.reduceat(value, starts)
    return Words(mix64(hashes + lengths.astype(np.uint64) * _STEP), starts, ends, rows)


def runs_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words (none if there are fewer words)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return hashes[:0]
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total = total * _STEP + hashes[k:k + n]
    return mix64(total)


def shingle_set(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct shingles of a text; a shorter text is one shingle, an empty one none."""
    if not len(hashes):
        return hashes
    return np.unique(runs_of(hashes, min(width, len(hashes))) + np.uint64(max(0, width - len(hashes))))
