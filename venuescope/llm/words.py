"""Words of UTF-8 texts and their 64-bit hashes, in numpy over an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import mix64

_BASE = np.uint64(0x2545F4914F6CDD1D)                       # odd, so it has an inverse mod 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_KEPT = 1 << 21                                             # powers that a worker keeps, at most
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    global _powers
    have = _powers
    if len(have[0]) < n:
        size = min(1 << int(n).bit_length(), max(n, _KEPT))
        with np.errstate(over="ignore"):
            have = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size, x, np.uint64)]) for x in (_BASE, _INVERSE))
        if size <= _KEPT:
            _powers = have
    return have[0][:n], have[1][:n]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null row has none."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, ends - ends[0]


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(xxh3 hash of each word with A-Z lower-cased, offsets of the rows into them).

    Each distinct word is hashed once; memory is a few bytes for each byte of text."""
    import xxhash

    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    word = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True                                       # no word crosses a row
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    stops[:-1] &= ~word[1:] | edge[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(stop - start, out=offsets[1:])
    flat = _LOWER[raw[word]]
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]).dictionary_encode()
    types = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return types[words.indices.to_numpy(zero_copy_only=False)] if len(types) else types, np.searchsorted(start, ends)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; the whole run if there are fewer (none without words)."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    total = np.full(n - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        total = total * np.uint64(0xD1342543DE82EF95) + words[j:n - k + 1 + j]
    return mix64(total)
