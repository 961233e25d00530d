"""Byte-level BPE encoding and decoding in numpy matrices.

Distinct pieces of a batch are laid out as padded matrices, one per length
bucket.  In each round every row merges its leftmost pair of lowest rank; the
hole is closed by compaction, and rows without a mergeable pair leave the matrix.
The rank of a pair comes from an open-addressing hash table over (left, right).

A piece of more than ``LONG`` bytes makes the same merges in the same order, but on a linked list with the
ranks in a heap, as moving a row of its length for each of them would take the square of its length.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_array, mix64, row_slices

NONE = np.int32(2**31 - 1)     # rank of a pair that does not merge
LONG = 256                     # pieces above this many bytes are merged on a list, not in a matrix
_WORKER: dict = {}             # (path, pattern) -> Codec


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class PairTable:
    """(left id, right id) -> rank of their concatenation; linear probing in two arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        key, value = np.array(keys, np.uint64), np.array(values, np.int32)
        size = 1 << max(4, int(3 * len(key)).bit_length())
        self.mask = np.uint64(size - 1)
        self._single: dict[int, int] | None = None
        self.keys, self.values = np.full(size, 2**64 - 1, np.uint64), np.full(size, NONE, np.int32)
        slot, left, self.probes = mix64(key) & self.mask, np.arange(len(key)), 0
        while len(left):
            self.probes += 1
            free = left[self.keys[slot[left]] == np.uint64(2**64 - 1)]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = key[won], value[won]
            left = left[self.keys[slot[left]] != key[left]]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask

    def lookup(self) -> dict[int, int]:
        """The table as (left << 32 | right) -> rank, for single pairs; made when it is first asked for."""
        if self._single is None:
            used = np.flatnonzero(self.values != NONE)
            self._single = dict(zip(self.keys[used].tolist(), self.values[used].tolist()))
        return self._single

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ids below 0 (padding) and unknown pairs give NONE."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        flat = out.reshape(-1)
        key = left.ravel()[todo].astype(np.uint64) << np.uint64(32) | right.ravel()[todo].astype(np.uint64)
        slot = mix64(key) & self.mask
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == key
            flat[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there != np.uint64(2**64 - 1))
            if not on.any():
                break
            todo, key, slot = todo[on], key[on], (slot[on] + np.uint64(1)) & self.mask
        return out


class Codec:
    """Encoder and decoder of one vocabulary; ``known`` caches pieces up to ``room`` entries."""

    def __init__(self, path: str, pattern: str, room: int = 300_000):
        import regex

        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.pairs = PairTable(self.ranks)
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            bytes_of[rank] = token
        self.bytes_of = pa.array(bytes_of, pa.large_binary())
        self.known: dict[str, bytes] = {}
        self.room = room

    def _rounds(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge a padded matrix to the end; yields (row numbers, their final rows)."""
        row = np.arange(len(ids))
        rank = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        while len(row):
            if ids.shape[1] < 2:
                yield row, ids
                return
            at = rank.argmin(axis=1)                       # the first of the lowest: leftmost
            low = rank[np.arange(len(row)), at]
            done = low == NONE
            if done.any():
                yield row[done], ids[done]
                row, ids, rank, at, low = row[~done], ids[~done], rank[~done], at[~done], low[~done]
                if not len(row):
                    return
            i = np.arange(len(row))
            ids[i, at] = low
            stay = np.ones(ids.shape, bool)
            stay[i, at + 1] = False
            ids = ids[stay].reshape(len(row), -1)          # compaction: each row is one id shorter
            stay = np.ones(rank.shape, bool)
            stay[i, at] = False
            rank = rank[stay].reshape(len(row), -1)
            if rank.shape[1]:
                has = np.flatnonzero(at < rank.shape[1])
                rank[has, at[has]] = self.pairs.rank(ids[has, at[has]], ids[has, at[has] + 1])
                has = np.flatnonzero(at > 0)
                rank[has, at[has] - 1] = self.pairs.rank(ids[has, at[has] - 1], ids[has, at[has]])

    def _long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: the leftmost pair of lowest rank is the least of the heap; entries of pairs that
        are gone are passed over."""
        n = len(ids)
        first = self.pairs.rank(ids[:-1], ids[1:])
        some = np.flatnonzero(first != NONE)
        heap = (first[some].astype(np.int64) << 32 | some).tolist()
        heapq.heapify(heap)
        token, rank, none = ids.tolist(), [*first.tolist(), int(NONE)], int(NONE)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        of = self.pairs.lookup().get
        while heap:
            low, i = divmod(heapq.heappop(heap), 1 << 32)
            if rank[i] != low:
                continue
            gone = after[i]
            j = after[i] = after[gone]
            token[i], token[gone], rank[gone] = low, -1, -1
            rank[i] = none
            if j < n:
                before[j] = i
                rank[i] = of(low << 32 | token[j], none)
                if rank[i] != none:
                    heapq.heappush(heap, rank[i] << 32 | i)
            h = before[i]
            if h >= 0:
                rank[h] = of(token[h] << 32 | low, none)
                if rank[h] != none:
                    heapq.heappush(heap, rank[h] << 32 | h)
        out = np.array(token, np.int32)
        return out[out >= 0]

    def learn(self, pieces) -> None:
        """Encode the pieces that are not in the cache yet, by length bucket."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > self.room:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
        rows: dict[int, list[tuple[str, bytes]]] = {}
        for p in new:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is not None:                           # a piece of the vocabulary is one token
                self.known[p] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                self.known[p] = self._long(self.byte[np.frombuffer(raw, np.uint8)]).astype("<i4").tobytes()
            else:
                rows.setdefault((len(raw) - 1).bit_length(), []).append((p, raw))
        for bucket, group in rows.items():
            width = 1 << bucket
            for start in range(0, len(group), step := max(1, (1 << 20) // width)):
                part = group[start:start + step]
                flat = np.frombuffer(b"".join(raw.ljust(width, b"\0") for _, raw in part), np.uint8).reshape(-1, width)
                size = np.array([len(raw) for _, raw in part])
                ids = np.where(np.arange(width) < size[:, None], self.byte[flat], np.int32(-1)).astype(np.int32)
                for numbers, final in self._rounds(ids):
                    count = (final >= 0).sum(axis=1).tolist()
                    for i, n, r in zip(numbers.tolist(), count, final.astype("<i4")):
                        self.known[part[i][0]] = r[:n].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers laid end to end."""
        cut = [self.split(t) for t in texts]
        self.learn({p for pieces in cut for p in pieces})
        get = self.known.__getitem__
        return [b"".join(map(get, pieces)) for pieces in cut]

    def decode(self, flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The bytes of rows of ids laid end to end."""
        whole = self.bytes_of.take(pa.array(flat.astype(np.int64)))
        ends = np.frombuffer(whole.buffers()[1], np.int64)[:len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
        rows = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=rows[1:])
        data = whole.buffers()[2] if len(whole) else pa.py_buffer(b"")
        return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends[rows].copy()), data]).cast(pa.binary())


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = Codec(path, pattern)
    return _WORKER[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
           decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, and with ``decoded`` also the bytes that
    the ids decode to.  Null and empty texts give no id; repeated rows and null ids each give
    a row of their own; other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = codec(path, pattern)
            for part in row_slices(batch, "t", 1 << 21):
                raw = own.encode([t or "" for t in part.column("t").to_pylist()])
                flat = np.frombuffer(b"".join(raw), "<i4")
                lists = list_array(flat, np.array([len(r) // 4 for r in raw]), pa.int32())
                cols = [part.column("d"), lists]
                if decoded:
                    cols.append(own.decode(flat, np.array([len(r) // 4 for r in raw], np.int64)))
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["d", "ids", "decoded"][:2 + decoded]
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"d {kind}, ids array<int>" + ", decoded binary" * decoded
    return docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).mapInArrow(run, schema).withColumnRenamed("d", doc_id)


def decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded binary): the bytes of each row's ids; null ids decode to no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = codec(path, pattern)
            sizes = pc.fill_null(pc.list_value_length(batch.column("i")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            out = own.decode(batch.column("i").flatten().to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([batch.column("d"), out], ["d", "decoded"])

    kind = encoded.schema[doc_id].dataType.simpleString()
    return encoded.select(F.col(doc_id).alias("d"), F.col(ids).alias("i")).mapInArrow(
        run, f"d {kind}, decoded binary").withColumnRenamed("d", doc_id)
