"""Vector helpers over UTF-8 texts: chunks of a batch, words, shingles and rolling hashes.

A batch of Arrow strings is cut into chunks of about a quarter megabyte (a longer text
is a chunk of its own), and every helper works on the bytes of a chunk at once.
Hashes of byte ranges take in eight bytes at a time, each step a multiplication and a shift that
feeds high bits back (no polynomial, whose value modulo 2**64 structured texts share), and bytes beyond
the 4096th of a range by BLAKE2; ranges of different length start differently. Two texts have the same
hash by chance only, about once in 2**64 pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
STEPS = 512

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose outputs look random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_FIRST, _SECOND, _LENGTH = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xD6E8FEB86659FD93))
_HELD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes


@dataclass
class Chunk:
    """Consecutive rows of a batch: their bytes end to end, and where each row begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def chunks(texts: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a string column in order; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield Chunk(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def _step(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _SECOND
    return x ^ (x >> np.uint64(29))


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges; equal bytes give equal hashes wherever they stand."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    length = end - start
    out = mix((length + 1).astype(np.uint64) * _LENGTH)
    live = np.arange(len(start))
    at, left = start, length
    for _ in range(STEPS):
        if not len(live):
            return out
        out[live] = _step(out[live] * _FIRST ^ eight[at] & _HELD[np.minimum(left, 8)])
        more = left > 8
        if not more.all():
            live, at, left = live[more], at[more], left[more]
        at, left = at + 8, left - 8
    for i, a, n in zip(live.tolist(), at.tolist(), left.tolist()):
        rest = hashlib.blake2b(data[a : a + n], digest_size=8).digest()
        out[i] ^= np.frombuffer(rest, "<u8")[0]
    return _step(out)


def window_hash(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` bytes, from those of half the size."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    out, have = _BYTE[data], 1
    while have < size:
        step = min(have, size - have)
        out = _step(out[: len(out) - step] * _FIRST ^ out[step:])
        have += step
    return out


def words(chunk: Chunk, lower: bool = True, gaps: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, byte starts and ends, and for each row the first of its words (one longer than the rows).

    Words are runs of anything but the bytes in ``gaps``: space, tab, line feed,
    vertical tab, form feed and carriage return. A-Z count as a-z if ``lower``.
    """
    data = LOWER[chunk.data] if lower else chunk.data
    n = len(data)
    ink = ~gaps[data]
    edge = np.zeros(n + 1, bool)
    edge[chunk.offsets] = True
    after = np.ones(n, bool)
    after[1:] = ~ink[:-1]
    starts = np.flatnonzero(ink & (after | edge[:-1]))
    before = np.ones(n, bool)
    before[:-1] = ~ink[1:]
    ends = np.flatnonzero(ink & (before | edge[1:])) + 1
    return range_hash(data, starts, ends), starts, ends, np.searchsorted(starts, chunk.offsets)


_ORDER = mix(np.arange(1001, 1017, dtype=np.uint64)) | np.uint64(1)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n neighbours, rows not regarded."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    size = len(hashes) - n + 1
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total += hashes[k : k + size] * _ORDER[k]
    return mix(total + np.uint64(n))


def shingle_sets(chunk: Chunk, n: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its n-word shingles; fewer words make one shingle, none an empty set."""
    hashes, _, _, first = words(chunk)
    grams = ngrams(hashes, n)
    for row in range(len(chunk)):
        start, end = int(first[row]), int(first[row + 1])
        if end - start >= n:
            yield np.unique(grams[start : end - n + 1])
        else:
            yield ngrams(hashes[start:end], end - start) if end > start else np.empty(0, np.uint64)
