"""Repeated strings of one text by threshold-bounded interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Start of each suffix, in the order of their first ``depth`` bytes or more (prefix doubling).

    Suffixes that agree that far may stand in any order: nothing below looks deeper."""
    n = len(text)
    key = text.astype(np.uint64) + np.uint64(0)
    for width, bits in ((1, 8), (2, 16), (4, 32)):               # eight bytes in one key
        ahead = np.zeros(n, np.uint64)
        ahead[:n - width] = key[width:] if n > width else 0
        key = key << np.uint64(bits) | ahead
    width = 8
    while True:
        order = np.argsort(key)
        run = np.empty(n, np.uint64)
        ordered = key[order]
        rank = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]], dtype=np.uint64)
        run[order] = rank
        if width >= depth or n == 0 or int(rank[-1]) == n:
            return order.astype(np.int32)
        key = run << np.uint64(32)
        if n > width:
            key[:n - width] |= run[width:]
        width *= 2


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """For each position, whether the ``length`` bytes from it also start at another position.

    ``text`` holds pieces that each end with the byte 255, which occurs nowhere else, so no repeat of ``length``
    bytes spans it as long as only starts with that many bytes left in their piece are asked for.

    Intervals of suffixes that share a prefix w grow by one byte on the left, breadth first.  When
    the interval of cw ends at a boundary not met before, the common prefix of the two suffixes there
    has the length of w: boundaries get their values in increasing order, each once.  The search
    stops at ``length``; boundaries still open then join suffixes that share at least so much.
    A node's children come from the runs of equal bytes of the transform inside its interval, so
    many copies of one text cost as much as one."""
    n = len(text)
    if n == 0:
        return np.zeros(0, bool)
    order = sort_suffixes(text, length + 1)
    bwt = text[order - 1]                                        # -1 wraps to the last byte
    by_byte = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int32)
    lf[by_byte] = np.arange(n, dtype=np.int32)
    first = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]]).astype(np.int32)     # runs
    stop = np.r_[first[1:], n].astype(np.int32)
    run_of = np.repeat(np.arange(len(first), dtype=np.int32), stop - first)
    met = np.zeros(n + 1, bool)
    met[0] = met[n] = True
    low, high = np.zeros(1, np.int32), np.full(1, n, np.int32)
    for _ in range(length):
        if not len(low):
            break
        a, b = run_of[low], run_of[high - 1]
        pieces = b - a + 1
        lone = pieces == 1
        left = lf[low[lone]]
        one = left, left + (high[lone] - low[lone])              # a single run: a single child
        low, high, a, pieces = low[~lone], high[~lone], a[~lone], pieces[~lone]
        if len(low):
            node = np.repeat(np.arange(len(low), dtype=np.int32), pieces)
            run = np.repeat(a - (np.cumsum(pieces) - pieces).astype(np.int32), pieces) + np.arange(len(node), dtype=np.int32)
            begin = np.maximum(first[run], low[node])
            size = np.minimum(stop[run], high[node]) - begin
            begin = lf[begin]
            rank = np.argsort(begin)
            begin, size, node, char = begin[rank], size[rank], node[rank], bwt[first[run]][rank]
            # runs of one byte inside one node lie side by side after the step to the left
            new = np.r_[True, (node[1:] != node[:-1]) | (char[1:] != char[:-1])]
            begin = begin[new]
            child = np.r_[one[0], begin], np.r_[one[1], begin + np.add.reduceat(size, np.flatnonzero(new))]
        else:
            child = one
        open_ = ~met[child[1]]
        low, high = child[0][open_].astype(np.int32), child[1][open_].astype(np.int32)
        met[high] = True
    shares = ~met                                               # boundary i: between order[i - 1] and order[i]
    out = np.zeros(n, bool)
    out[order] = shares[:-1] | shares[1:]
    return out
