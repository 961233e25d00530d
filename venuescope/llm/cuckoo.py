"""A cuckoo filter over 64-bit keys, filled and probed in numpy batches."""

from __future__ import annotations

import numpy as np

from .common import mix64

SLOTS = 4            # fingerprints of 16 bits in a bucket
LOAD = 0.75


class CuckooFilter:
    """Set of 64-bit keys with false positives (about 2 * SLOTS / 2**16 of the probes) and no
    false negatives.  Keys can be removed; insert each key once and remove only inserted ones."""

    def __init__(self, keys: np.ndarray, rng_seed: int = 7):
        need = max(1, int(len(keys) / (SLOTS * LOAD)))
        bits = max(1, (need - 1).bit_length())
        while not self._fill(keys, 1 << bits, rng_seed):
            bits += 1

    @staticmethod
    def _mark(keys: np.ndarray) -> np.ndarray:
        mark = (mix64(keys ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)
        return np.maximum(mark, np.uint16(1))           # 0 is an empty slot

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(mark) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _fill(self, keys: np.ndarray, buckets: int, seed: int) -> bool:
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        return self._insert(self._home(keys), self._mark(keys), np.random.default_rng(seed))

    def _insert(self, bucket: np.ndarray, mark: np.ndarray, rng) -> bool:
        """Place all marks; those that find both buckets full evict others, in rounds."""
        for turn in range(500):
            if not len(bucket):
                return True
            order = np.argsort(bucket, kind="stable")
            bucket, mark = bucket[order], mark[order]
            nth = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            empty = self.table[bucket] == 0
            # the nth arrival of a bucket takes its nth empty slot
            slot = np.argmax(empty & (np.cumsum(empty, axis=1) == (nth + 1)[:, None]), axis=1)
            fits = nth < empty.sum(axis=1)
            self.table[bucket[fits], slot[fits]] = mark[fits]
            bucket, mark, nth = bucket[~fits], mark[~fits], nth[~fits]
            if turn % 2:                                 # both buckets were full: one per bucket evicts
                _, kick = np.unique(bucket, return_index=True)
                slot = rng.integers(0, SLOTS, len(kick))
                mark[kick], self.table[bucket[kick], slot] = self.table[bucket[kick], slot].copy(), mark[kick].copy()
            bucket = self._other(bucket, mark)
        return False

    def insert(self, keys: np.ndarray) -> bool:
        """Add keys; False if the table is too full for them (build a larger one then)."""
        saved = self.table.copy()
        if self._insert(self._home(keys), self._mark(keys), np.random.default_rng(len(keys))):
            return True
        self.table = saved
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted, each from one of its two buckets."""
        for home, mark in zip(self._home(keys).tolist(), self._mark(keys)):
            for bucket in (home, int(self._other(np.array([home]), np.array([mark]))[0])):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        home, mark = self._home(keys), self._mark(keys)
        here = (self.table[home] == mark[:, None]).any(axis=1)
        return here | (self.table[self._other(home, mark)] == mark[:, None]).any(axis=1)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "CuckooFilter":
        out = cls.__new__(cls)
        out.table = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        return out
