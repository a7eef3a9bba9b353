"""A run-length index of a repetitive collection of strings.

The strings are sorted by suffix (seven characters at first, then prefix tripling on ranks), which gives the Burrows-Wheeler transform; only its runs are kept, with the text place of
each run's first suffix (a sample), the place of the suffix sorted before it, and their common prefix length. Between two samples q < q' of the text the
rest follows: the suffix before p's in sorted order is at before(q) + (p - q), and their common prefix has length lcp(q) - (p - q). So the matching
statistics of the collection against itself are streamed from the samples, a few numbers per run.
"""

from __future__ import annotations

import numpy as np

#: texts of one index, in characters, at most (three ranks must fit one 64-bit key)
MAX_TEXT = (1 << 20) - 1


class RunIndex:
    """strings: bytes objects, in all at most MAX_TEXT characters with a separator for each; no match runs over a separator."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(lengths + 1) - (lengths + 1)
        self.size = int((lengths + 1).sum())
        if self.size > MAX_TEXT:
            raise ValueError("too much text for one index")
        text = np.frombuffer(b"\0".join([*strings, b""]), "u1")
        ends = self.begin + lengths
        order = _suffix_order(text, ends)
        before = np.full(self.size, -1, np.int64)  # the character before each suffix in sorted order; separators are all different
        inner = order > 0
        before[inner] = text[order[inner] - 1]
        mark = np.zeros(self.size + 1, bool)
        mark[ends + 1] = True
        own = mark[order] | (order == 0)
        before[own] = -1 - np.arange(int(own.sum()))
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.runs = len(heads)
        heads = heads[1:]
        q, p = order[heads], order[heads - 1]
        by = np.argsort(q)
        self.sample, self.other = q[by], p[by]
        self.lcp = _common(text, ends, self.sample, self.other)

    def repeated(self, length: int) -> np.ndarray:
        """For each place of the joined text, whether the string of that length there occurs at another place as well."""
        change = np.zeros(self.size + 1, np.int64)
        to = np.minimum(np.append(self.sample[1:], self.size) - self.sample, self.lcp - length + 1)
        keep = to > 0
        for start in (self.sample[keep], self.other[keep]):
            np.add.at(change, start, 1)
            np.add.at(change, start + to[keep], -1)
        return np.cumsum(change[:-1]) > 0


def _suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffixes' places in sorted order; separators sort before all characters, and a suffix that reaches one equals no other."""
    n = len(text)
    bits = max(1, int(n).bit_length())
    # the first key is the next seven characters, up to a separator (characters count from 1)
    wide = text.astype(np.uint64) + np.uint64(1)
    wide[ends] = 0
    wide = np.concatenate([wide, np.zeros(6, np.uint64)])
    to_end = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | np.where(to_end > k, wide[k : k + n], np.uint64(0))
    order = np.argsort(key)
    # suffixes that reach a separator: equal ones by place, which is the order of their separators
    near = np.flatnonzero(to_end[order] < 7)
    order[near] = order[near][np.lexsort((order[near], key[order[near]]))]
    fresh = np.ones(n, bool)
    fresh[1:] = (key[order][1:] != key[order][:-1]) | (to_end[order][1:] < 7)
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    step = 7
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        if not tied.any():
            return order
        slots = slots[tied]
        padded = np.concatenate([rank + 1, np.zeros(2 * step, np.int64)])
        at = order[slots]
        key = (padded[at] << (2 * bits)) | (padded[at + step] << bits) | padded[at + 2 * step]
        by = np.argsort(key)
        at, key = at[by], key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        order[slots] = at
        # a group's rank is the slot of its first member
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        step *= 3


def _common(text: np.ndarray, ends: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of pairs of suffixes, up to the nearer separator."""
    room = np.minimum(ends[np.searchsorted(ends, p)] - p, ends[np.searchsorted(ends, q)] - q)
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, "u1")]), 8)
    packed = np.ascontiguousarray(words).view("<u8").ravel()
    out = room.copy()
    live = np.flatnonzero(room > 0)
    at = 0
    while len(live):
        x = packed[p[live] + at] ^ packed[q[live] + at]
        # the lowest set bit is in the first byte that differs
        differ = x != 0
        low = x[differ] & (~x[differ] + np.uint64(1))
        byte = (np.log2(low.astype(float)).astype(np.int64)) // 8
        out[live[differ]] = np.minimum(room[live[differ]], at + byte)
        at += 8
        live = live[~differ]
        live = live[room[live] > at]
    return out
