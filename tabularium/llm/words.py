"""Word boundaries and word hashes of Arrow text columns, vectorised over bytes.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``: every byte of a longer
UTF-8 sequence is above those, so bytes and code points give the same words. Hashes are 64-bit
polynomials over a fixed table of random byte values, mixed at the end; equal words have equal
hashes everywhere. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # text bytes handled at once; a longer single text is a slice of its own
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept and doubled as needed."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 1 << 64))
            have[done : 2 * done] = have[: min(done, size - done)] * step
            done *= 2
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hash of each byte span of ``data``; ``fold`` takes A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _VALUES)[data] * _powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


class Words(NamedTuple):
    data: np.ndarray  # the bytes of all texts of the slice, one after another
    bounds: np.ndarray  # first byte of each text, and the end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    doc: np.ndarray  # text of each word
    first: np.ndarray  # first word of each text, and the number of words

    def text(self, a: int, b: int) -> str:
        return self.data[a:b].tobytes().decode("utf-8")


def split(column: pa.Array) -> Words:
    """The words of every text of a string column."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    solid = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    inner = bounds[:-1][bounds[:-1] < len(data)]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(solid & ~after) + 1
    first = np.searchsorted(starts, bounds)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(data, bounds, starts, ends, doc, first)


def hashes(words: Words, fold: bool = False) -> np.ndarray:
    """Hash of each word."""
    return span_hashes(words.data, words.starts, words.ends, fold)


def windows(words: Words, hashed: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``width`` words inside one text."""
    n = len(hashed) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.doc[:n] == words.doc[width - 1 :])
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total *= np.uint64(_BASE)
        total += hashed[k : k + n]
    return at, mix(total[at])


def covered(n: int, at: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``at``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + width, n), -1)
    return np.cumsum(edge[:n]) > 0


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of text each, at least one row."""
    if not batch.num_rows:
        return
    import pyarrow.compute as pc

    size = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, base = stop, int(size[stop - 1])
