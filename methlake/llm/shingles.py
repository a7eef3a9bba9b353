"""Word shingles as 64-bit hashes, for many texts at once.

A word is a maximal run of ASCII letters and digits and of characters beyond ASCII, in lower case. A shingle is ``size`` words in a row;
a text with fewer words (but one at least) has one shingle, all its words. Null texts and texts without a word have none.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_C = np.uint64(0xD6E8FEB86659FD93)
_INV = np.uint64(pow(int(_B), -1, 2**64))
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(a: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (murmur3's constants)."""
    a = (a ^ (a >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    a = (a ^ (a >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return a ^ (a >> np.uint64(33))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i (mod 2**64) for i < n, kept at the largest n so far."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_B, _INV)):
            x = np.full(1 << (n - 1).bit_length(), base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_places(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """(first byte, end, text's index) of every word of the joined texts, in order, and a function that hashes stretches of bytes inside words."""
    raw = [(t or "").lower().encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), "u1")
    ends = np.cumsum([len(r) for r in raw])
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view("i1"), [0]])))
    a, b = edge[::2], edge[1::2]
    up, down = powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
    return a, b, np.searchsorted(ends, a, "right"), lambda x, y: mix((run[y] - run[x]) * down[x] + (y - x).astype(np.uint64))


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text's index) of every word, in order."""
    a, b, of, hashed = word_places(texts)
    return hashed(a, b), of


def shingles(texts: list[str | None], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text's index) of every shingle, in order."""
    h, of = words(texts)
    if not len(h):
        return h, of
    n = np.bincount(of, minlength=len(texts))
    first = np.cumsum(n) - n
    k = np.arange(len(h)) - first[of]
    full = k + size <= n[of]
    out = np.zeros(len(h), np.uint64)
    for j in range(size):
        out[: len(h) - j] = out[: len(h) - j] * _C + h[j:]
    short = np.flatnonzero((n > 0) & (n < size))
    for t in short.tolist():
        x = np.uint64(0)
        for w in h[first[t] : first[t] + n[t]]:
            x = np.uint64((int(x) * int(_C) + int(w)) % 2**64)
        out[first[t]], full[first[t]] = x, True
    return mix(out[full]), of[full]


def counted(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text's index, count) of the distinct shingles of each text, ordered by text and hash."""
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])])) if len(h) else np.empty(0, np.int64)
    return h[start], of[start], np.diff(np.concatenate([start, [len(h)]]))
