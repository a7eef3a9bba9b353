"""Tokenizers applied once to each distinct piece of text that a worker meets.

The pre-tokenizers of the vocabulary files never join what stands before a space with what stands after it, nor an ASCII letter with
an ASCII character after it that is none. So a batch of texts is cut at these places in array form, every piece is looked up by a 64-bit hash, and the tokenizers
library is asked only for new ones. Texts that don't allow this go to the library whole: those with characters outside a safe range (where
two Unicode tables or the normalizer might differ), with the string of an added token, or with a piece of more than LONG bytes.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from .shingles import mix, powers

SAFE = re.compile("[\t\n\r -~¡-įĲ-ɏ]*").fullmatch
#: bytes of a piece, at most, and of texts that are cut together
LONG, GROUP = 160, 500_000
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True


def _pairs(words: bool) -> np.ndarray:
    """For two bytes in a row (first * 256 + second): 1 if they are cut apart, 2 if both are blank."""
    letter = np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123)]] = True
    other = ~letter
    other[128:] = False
    cut = letter[:, None] & other | ~_BLANK[:, None] & _BLANK
    parts = _BLANK.copy()
    parts[32] = words  # else a space stays with what follows it
    cut |= parts[:, None] & ~_BLANK
    return np.where(_BLANK[:, None] & _BLANK, 2, cut).astype("u1").ravel()


_PAIRS = {words: _pairs(words) for words in (False, True)}
_PLAIN = re.compile(" ?[A-Za-z]+").fullmatch


class WordTable:
    """Hash -> ids of a piece: an open hash table in arrays, kept at most half full, and flat ids."""

    def __init__(self, dtype: str):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.keys, self.entries = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32)
        self.start, self.length, self.ids = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32), np.empty(1 << 14, self.dtype)
        self.size = self.total = 0

    def __len__(self) -> int:
        return self.size

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entries of the hashes (none is 0), -1 where absent."""
        slot = self._slots(h)
        got = self.keys[slot]
        out = np.where(got == h, self.entries[slot], np.int32(-1))
        live = np.flatnonzero((got != h) & (got != 0))
        while len(live):
            slot[live] = (slot[live] + 1) & (len(self.keys) - 1)
            got = self.keys[slot[live]]
            hit = got == h[live]
            out[live[hit]] = self.entries[slot[live[hit]]]
            live = live[~hit & (got != 0)]
        return out

    def _place(self, h: np.ndarray, entries: np.ndarray) -> None:
        slot = self._slots(h)
        while len(h):
            free = np.flatnonzero(self.keys[slot] == 0)
            self.keys[slot[free]] = h[free]
            won = self.keys[slot] == h
            self.entries[slot[won]] = entries[won]
            h, entries, slot = h[~won], entries[~won], (slot[~won] + 1) & (len(self.keys) - 1)

    def add(self, h: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """New hashes, each once, with the ids of all one after another."""
        size, total = self.size + len(h), self.total + len(ids)
        if 2 * size > len(self.keys):
            old, entries = self.keys, self.entries
            bits = (2 * size).bit_length()
            self.keys, self.entries = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
            self._place(old[old != 0], entries[old != 0])
        if size > len(self.start):
            self.start, self.length = _grown(self.start, size), _grown(self.length, size)
        if total > len(self.ids):
            self.ids = _grown(self.ids, total)
        self.start[self.size : size] = self.total + np.cumsum(lengths) - lengths
        self.length[self.size : size] = lengths
        self.ids[self.total : total] = ids
        self._place(h, np.arange(self.size, size, dtype=np.int32))
        self.size, self.total = size, total

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all entries one after another, the length of each)."""
        n = self.length[entries].astype(np.int64)
        ends = np.cumsum(n)
        return self.ids[np.repeat(self.start[entries] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], n


def _grown(a: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(1 << size.bit_length(), a.dtype)
    out[: len(a)] = a
    return out


class PieceEncoder:
    """Encodes texts to ids of the given dtype through a table of pieces. A subclass encodes what is new: ``_learn`` pieces, ``_whole`` texts.

    words: the vocabulary drops white space and marks word ends (else it is byte-level and keeps a space with the word after it).
    limit: pieces kept; beyond that the table is emptied, so memory is bounded.
    """

    #: finds the string of an added token in a lower-case text
    special = None

    def __init__(self, words: bool, dtype: str, limit: int):
        self.words, self.dtype, self.limit = words, dtype, limit
        self.table = WordTable(dtype)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def _learn(self, h: np.ndarray, new: list[str]) -> None:
        raise NotImplementedError

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null is the empty text. New pieces of all texts are learnt together."""
        out: list = [np.empty(0, self.dtype)] * len(texts)
        if len(self.table) > self.limit:
            self.table.clear()
        cut: list[tuple] = []
        group: list[tuple[int, str, bytes]] = []
        size = 0
        for i, t in enumerate(texts):
            if not t:
                continue
            low = t.lower() if self.words or self.special else t
            if not SAFE(t) or self.special and self.special(low):
                out[i] = self._whole([t])[0]
                continue
            group.append((i, t, (low if self.words else t).encode()))
            size += len(group[-1][2])
            if size > GROUP:
                self._cut(group, cut, out)
                group, size = [], 0
        self._cut(group, cut, out)
        self._learn_new(cut)
        for of, bounds, a, h, _ in cut:
            ids, n = self.table.gather(self.table.find(h))
            after = np.concatenate([[0], np.cumsum(n)])
            places = after[np.searchsorted(a, bounds)].tolist()
            for i, x, y in zip(of, places, places[1:]):
                out[i] = ids[x:y]
        return out

    def _cuts(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) of the pieces. Without ``words`` they cover the texts."""
        pair = _PAIRS[self.words][(data[:-1].astype(np.uint16) << 8) | data[1:]]
        inner = np.flatnonzero(pair == 2) + 1
        first = np.concatenate([[True], pair == 1, [True]])
        first[begins] = True
        if len(inner):
            # inside a run of blanks: before its last one, if a character follows
            blank = _BLANK[data]
            last = np.isin(inner + 1, ends) | blank[np.minimum(inner + 1, len(data) - 1)]
            first[inner[~last]] = True
        a = np.flatnonzero(first)
        a, b = a[:-1], a[1:]
        if self.words:
            keep = ~_BLANK[data[a]]
            a, b = a[keep], b[keep]
        return a, b

    def _cut(self, group: list[tuple[int, str, bytes]], cut: list[tuple], out: list) -> None:
        """Appends the texts' places, bounds, pieces' first bytes and hashes, and new pieces (by hash) of a group of texts."""
        if not group:
            return
        raw = b"".join([r for _, _, r in group])
        data = np.frombuffer(raw, "u1")
        ends = np.cumsum([len(r) for _, _, r in group])
        begins = ends - [len(r) for _, _, r in group]
        a, b = self._cuts(data, begins, ends)
        if not len(a):
            return
        if (b - a).max() > LONG:
            far = set((np.searchsorted(ends, a[b - a > LONG], "right")).tolist())
            for k in far:
                out[group[k][0]] = self._whole([group[k][1]])[0]
            self._cut([g for k, g in enumerate(group) if k not in far], cut, out)
            return
        up, down = powers(len(data) + 1)
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
        h = np.maximum(mix((run[b] - run[a]) * down[a] + (b - a).astype(np.uint64)), np.uint64(1))
        absent = np.flatnonzero(self.table.find(h) < 0)
        keys, place = np.unique(h[absent], return_index=True)
        place = absent[place]
        new = [raw[x:y].decode() for x, y in zip(a[place].tolist(), b[place].tolist())]
        cut.append(([i for i, _, _ in group], np.concatenate([begins, ends[-1:]]), a, h, (keys, new)))

    def _learn_new(self, cut: list[tuple]) -> None:
        keys = [c[4][0] for c in cut]
        if not sum(map(len, keys)):
            return
        found, place = np.unique(np.concatenate(keys), return_index=True)
        new = [w for c in cut for w in c[4][1]]
        self._learn(found, [new[i] for i in place.tolist()])


class Encoder(PieceEncoder):
    """Encodes as the tokenizers library does with add_special_tokens=False."""

    def __init__(self, path: str, words: bool, dtype: str = "<u2", limit: int = 800_000):
        super().__init__(words, dtype, limit)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size()
        if dtype == "<u2" and size > 65536:
            raise ValueError("the vocabulary needs 32-bit ids")
        added = [re.escape(x["content"].lower()) for x in json.loads(self.tok.to_str())["added_tokens"]]
        self.special = re.compile("|".join(added)).search if added else None
        # in a text of many new words: the ids that end a word, or the id that stands between two
        self.stop = np.array([words and (self.tok.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        if not words:
            (line,) = self.tok.encode("\n", add_special_tokens=False).ids
            self.stop[line] = True

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.dtype) for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, h: np.ndarray, new: list[str]) -> None:
        """Encodes new pieces. Plain words are one pre-token each and go to the library's model; other words go to the library many in one
        text, where their ids can be told apart; the rest goes to it piece by piece."""
        plain, many, alone = [], [], []
        for i, w in enumerate(new):
            if _PLAIN(w):
                plain.append(i)
            elif not w.isalpha() if self.words else "\n" in w or w.isspace():
                alone.append(i)
            else:
                many.append(i)
        if plain:
            model = self.tok.model.tokenize
            # the byte-level form of a space
            found = [[x.id for x in model(w if self.words else w.replace(" ", "Ġ"))] for w in (new[i] for i in plain)]
            self.table.add(h[plain], np.array([len(x) for x in found]), np.array([x for f in found for x in f], self.dtype))
        for at in range(0, len(many), 200):
            part = many[at : at + 200]
            text = (" " if self.words else "\n").join([new[i] for i in part]) + ("" if self.words else "\n")
            ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.stop[ids])
            if len(ends) != len(part):
                raise ValueError("the vocabulary does not tell words apart")
            if self.words:
                self.table.add(h[part], np.diff(ends, prepend=-1), ids)
            else:
                self.table.add(h[part], np.diff(ends, prepend=-1) - 1, np.delete(ids, ends))
        if alone:
            found = self._whole([new[i] for i in alone])
            self.table.add(h[alone], np.array([len(x) for x in found]), np.concatenate(found))


_encoders: dict[tuple[str, bool, str], Encoder] = {}


def encoder(path: str, words: bool, dtype: str = "<u2") -> Encoder:
    """One encoder for each vocabulary in a Python worker, kept over its tasks."""
    key = (path, words, dtype)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def forget() -> None:
    """Frees the encoders of this worker: for workers whose next tasks need none."""
    _encoders.clear()
