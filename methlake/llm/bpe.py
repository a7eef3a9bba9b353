"""Byte-level BPE by merge replay over a corpus of distinct pieces.

A worker cuts its texts into pieces of one or more of the pattern's matches (see wordcache) and replays the merges once over all matches of the pieces it has not met before, laid out in
flat arrays. An inverted index from a merge's rank to the places of its pairs gives, rank after rank, the places to change; only the neighbours of a
changed place are looked up again. The index is a heap of ranks, since a new pair can rank lower than the merge that made it.

The result equals merging each piece alone, lowest rank first and leftmost among equals: no place of a lower rank is left when a
rank comes up, and where several places of one piece share the rank they are merged together only if no pair this makes ranks lower.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import tidy
from .wordcache import PieceEncoder

NONE = np.int32(2**31 - 1)
# fixed value: the pattern of the byte-level vocabularies, none of whose matches goes on after a letter with what is none, or begins before a blank
BLANKS_AND_LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """The ranks as arrays: every pair of tokens whose bytes together are a token, sorted, with that token's rank."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= 1 << 16 or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ranks must be under 65536 and hold every byte")
        self.token = [b""] * (max(ranks.values()) + 1)
        pairs: dict[int, int] = {}
        for word, rank in ranks.items():
            self.token[rank] = word
            for cut in range(1, len(word)):
                a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
                if a is not None and b is not None:
                    pairs[a << 16 | b] = rank
        self.keys = np.array(sorted(pairs), np.uint32)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.whole = ranks

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.uint32) << np.uint32(16)) | b.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all pieces one after another, how many each has); no piece is empty."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        symbol = self.byte[np.frombuffer(b"".join(pieces), "u1")]
        n = len(symbol)
        ends = np.cumsum(lengths)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        after = np.arange(1, n + 1, dtype=np.int32)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[ends - lengths] = -1
        alive = np.ones(n, bool)
        rank = np.full(n, NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.rank(symbol[inner], symbol[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(places: np.ndarray) -> None:
            places = places[rank[places] != NONE]
            if not len(places):
                return
            order = places[np.argsort(rank[places], kind="stable")]
            of = rank[order]
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            starts = [0, *cuts.tolist(), len(order)]
            for r, a, b in zip(of[np.array(starts[:-1])].tolist(), starts, starts[1:]):
                if r in index:
                    index[r].append(order[a:b])
                else:
                    index[r] = [order[a:b]]
                    heapq.heappush(heap, r)

        enter(inner)
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = at[rank[at] == r]
            if len(at) > 1:
                at = np.unique(at)
                # of places that overlap, every second one from the left
                tied = np.flatnonzero(after[at[:-1]] == at[1:])
                if len(tied):
                    chained = np.zeros(len(at), bool)
                    chained[tied + 1] = True
                    k = np.arange(len(at))
                    head = np.maximum.accumulate(np.where(chained, 0, k))
                    at = at[(k - head) % 2 == 0]
                same = piece[at[1:]] == piece[at[:-1]]
                if same.any():
                    first = np.concatenate([[True], ~same])
                    left, right = before[at], after[after[at]]
                    new = np.full(len(at), r, np.int32)
                    low = self.rank(new[:1], new[:1])[0] < r
                    low = low | ((left >= 0) & (self.rank(symbol[left], new) < r)) | ((right >= 0) & (self.rank(new, symbol[right]) < r))
                    held = np.isin(piece[at], piece[at[low]]) & ~first
                    if held.any():
                        index[r] = [at[held]]
                        heapq.heappush(heap, r)
                        at = at[~held]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbol[at] = r
            after[at] = beyond
            has = beyond >= 0
            before[beyond[has]] = at[has]
            alive[gone] = False
            rank[gone] = NONE
            right = at[has]
            rank[at[~has]] = NONE
            left = before[at]
            left = left[left >= 0]
            touched = np.concatenate([left, right])
            if len(touched):
                rank[touched] = self.rank(symbol[touched], symbol[after[touched]])
                enter(touched)
        return symbol[alive], np.bincount(piece[alive], minlength=len(pieces))


class Strings:
    """Byte strings by number, laid out in one array."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(strings), "u1")

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the strings of the numbers one after another, the end of each)."""
        n = self.length[numbers]
        ends = np.cumsum(n)
        return self.data[np.repeat(self.start[numbers] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], ends


class Codec(PieceEncoder):
    """Texts <-> ids. The texts of one call are a corpus whose new pieces are replayed together."""

    def __init__(self, path: str, pattern: str, limit: int = 800_000):
        super().__init__(False, "<u2", limit)
        self.merges = Merges(load_ranks(path))
        self.find = regex.compile(pattern).findall
        # pieces may be cut at blanks and after letters only where the pattern's matches end there
        self.cuttable = pattern == BLANKS_AND_LETTERS
        self.decimals = Strings([b"%d," % i for i in range(len(self.merges.token))])
        self.tokens = Strings(self.merges.token)

    def _match_ids(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all matches one after another, how many each has). A match that is a token is that token; the others are replayed."""
        raw = [m.encode() for m in matches]
        known = np.array([self.merges.whole.get(x, -1) for x in raw], np.int32)
        rest = np.flatnonzero(known < 0)
        counts = np.ones(len(raw), np.int64)
        if not len(rest):
            return known, counts
        ids, counts[rest] = self.merges.replay([raw[i] for i in rest.tolist()])
        first = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        out[first[known >= 0]] = known[known >= 0]
        n = counts[rest]
        out[np.repeat(first[rest] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, counts

    def _learn(self, h: np.ndarray, new: list[str]) -> None:
        matches = [self.find(w) for w in new]
        ids, counts = self._match_ids([m for p in matches for m in p])
        of = np.repeat(np.arange(len(new)), [len(p) for p in matches])
        self.table.add(h, np.bincount(of, counts, len(new)).astype(np.int64), ids.astype(self.dtype))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [self._match_ids(m)[0].astype(self.dtype) if (m := self.find(t)) else np.empty(0, self.dtype) for t in texts]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return super().encode(texts) if self.cuttable else [self._whole([t or ""])[0] for t in texts]

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, bytes, bytes]]:
        """(number of ids, the ids as decimal text joined by commas, the bytes decoded from them) of each text; null is the empty text."""
        found = self.encode(texts)
        at = 0
        while at < len(found):
            # a few megabytes at a time
            stop, size = at, 0
            while stop < len(found) and (stop == at or size + len(found[stop]) <= 500_000):
                size += len(found[stop])
                stop += 1
            ids = np.concatenate(found[at:stop])
            ends = np.cumsum([len(x) for x in found[at:stop]])
            (ten, ten_ends), (raw, raw_ends) = self.decimals.joined(ids), self.tokens.joined(ids)
            ten, raw = ten.tobytes(), raw.tobytes()
            cuts = [np.concatenate([[0], np.concatenate([[0], e])[ends]]).tolist() for e in (ten_ends, raw_ends)]
            for k, x in enumerate(found[at:stop]):
                yield len(x), ten[cuts[0][k] : max(cuts[0][k], cuts[0][k + 1] - 1)], raw[cuts[1][k] : cuts[1][k + 1]]
            at = stop

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.merges.token[i] for i in ids])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary in a Python worker, kept over its tasks."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _groups(batch: pa.RecordBatch, chars: int = 12_000_000) -> Iterator[tuple[list, list]]:
    """(ids, texts) of a batch in groups of about so many characters."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        ids.append(i)
        texts.append(t)
        size += len(t or "")
        if size > chars:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every row; null and empty texts have no ids, repeated rows are encoded each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, texts in _groups(batch, 3_000_000):
                found = [x.astype(np.int32) for x in codec(path, pattern).encode(texts)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), ids], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes of every row of (doc_id, ids); null ids give null. Ids beyond the vocabulary fail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if x is None else codec(path, pattern).decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, bytes binary")


ROUND_TRIP = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of every row's ids and of the bytes decoded from them, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, texts in _groups(batch):
                out = [(n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest()) for n, ids, raw in codec(path, pattern).texts(texts)]
                n, a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(tidy(run), ROUND_TRIP)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> digests of the ids and of their decoded bytes."""
    import public_tokenizers as P

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
