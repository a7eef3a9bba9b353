"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and word beginnings of 4 to 6 bytes, as hashes. Examples are a bounded sample of labelled texts; all their terms count. A term's weight is its inverse document frequency
times the square root of its likelihood ratio between the labels, so a word that toxic and clean examples share alike says little (nothing, at the very same rate).

The examples' unit vectors form an inverted index in blocks of examples. The lists of rare and of strong terms are added up for a query first; the lists of common, weak terms are kept
with their greatest weight per block, and only blocks whose bound can reach the k-th best example so far are completed. So the neighbours are exact. Their
distance-weighted vote is calibrated on the examples themselves, each judged by the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import id_bucket, released, tidy, written
from .langid import HashArray
from .shingles import counted, mix, shingles, word_places

#: labelled texts of each label, at most about, that the examples come from
SAMPLE = 1000
NEIGHBOURS, BLOCK, BEGINNINGS = 15, 64, (4, 5, 6)
#: a term is common in this share of the examples, and weak under this share of the greatest weight (both only order the work)
COMMON, WEAK = 1 / 16, 1 / 3
#: weights have 32 bits: cosines are told apart at five digits, and bounds leave room for their rounding
SLACK = 2e-5


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text's index) of every term of texts."""
    a, b, of, hashed = word_places(texts)
    h, owner = [hashed(a, b)], [of]
    for k in BEGINNINGS:
        w = b - a >= k
        h.append(mix(hashed(a[w], a[w] + k) + np.uint64(k)))
        owner.append(of[w])
    return np.concatenate(h), np.concatenate(owner)


class BlockMaxIndex:
    """Unit vectors of ``size`` examples, given as (term, example, weight) arrays over ``width`` terms.

    Posting lists of the terms but the common weak ones; these as columns of blocks of BLOCK examples, with the greatest weight of each block.
    """

    def __init__(self, term: np.ndarray, example: np.ndarray, weight: np.ndarray, size: int, width: int, worth: np.ndarray):
        self.size, self.width, self.blocks = size, width, -(-size // BLOCK)
        often = np.bincount(term, minlength=width) > max(BLOCK // 8, COMMON * size)
        weak = often & (worth < WEAK * worth.max(initial=0.0))
        self.column = np.where(weak, np.cumsum(weak) - 1, -1).astype(np.int32)
        dense = np.zeros((self.blocks * BLOCK, int(weak.sum())), np.float32)
        w = weak[term]
        dense[example[w], self.column[term[w]]] = weight[w]
        self.dense = dense.reshape(self.blocks, BLOCK, dense.shape[1])
        self.most = self.dense.max(1) if size else np.zeros((0, dense.shape[1]), np.float32)
        term, example, weight = term[~w], example[~w], weight[~w]
        order = np.lexsort((example, term))
        self.example, self.weight = example[order].astype(np.int32), weight[order].astype(np.float32)
        self.start = np.searchsorted(term[order], np.arange(width + 1)).astype(np.int32)

    def nearest(self, term: np.ndarray, of: np.ndarray, weight: np.ndarray, n: int, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(examples [n, k], cosines [n, k]) of the k nearest of n queries (unit vectors), best first, ties by example; where there are fewer with a cosine over 0, the rest has cosine 0."""
        wide = self.blocks * BLOCK
        if not wide:
            return np.zeros((n, 0), np.int64), np.zeros((n, 0))
        column = self.column[term]
        tail = column >= 0
        q = np.zeros((n, self.dense.shape[2]), np.float32)
        q[of[tail], column[tail]] = weight[tail]
        t, o, w = term[~tail], of[~tail], weight[~tail]
        length = self.start[t + 1] - self.start[t]
        ends = np.cumsum(length)
        at = np.repeat(self.start[t] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        score = np.bincount(np.repeat(o * wide, length) + self.example[at], self.weight[at] * np.repeat(w, length), n * wide).astype(float).reshape(n, wide)
        if without is not None:
            score[np.arange(n), without] = -2
        k = min(k, self.size)
        floor = np.partition(score, wide - k, axis=1)[:, wide - k]
        bound = score.reshape(n, self.blocks, BLOCK).max(2) + q @ self.most.T
        visit = (bound >= floor[:, None] - SLACK) & (bound > 0)
        for b in range(self.blocks):
            rows = np.flatnonzero(visit[:, b])
            score[rows, b * BLOCK : (b + 1) * BLOCK] += q[rows] @ self.dense[b].T
        score.reshape(n, self.blocks, BLOCK)[~visit] = 0
        score[:, self.size :] = 0
        score = np.round(np.maximum(score, 0), 5)
        # the order is by cosine, then by example: both in one number
        key = -score + np.arange(wide) * 1e-11
        best = np.argpartition(key, k - 1, axis=1)[:, :k]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(key, best, 1), axis=1, kind="stable"), 1)[:, :k]
        return best, np.take_along_axis(score, best, 1)


@dataclass
class Model:
    """Terms' hashes and weights, the index, examples' ids and labels, the calibration (raw votes -> scores), and the score of texts without a neighbour."""

    keys: HashArray
    worth: np.ndarray
    index: BlockMaxIndex
    example_ids: np.ndarray
    labels: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]
    blank: float
    k: int

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, text's index, weight) of the texts' unit TF-IDF vectors over the examples' terms; a text without one has no entry."""
        h, of = terms(texts)
        at = self.keys.find(h)
        known = at >= 0
        key, n = np.unique(of[known] * self.index.width + at[known], return_counts=True)
        of, at = np.divmod(key, max(1, self.index.width))
        w = (1 + np.log(n)) * self.worth[at]
        norm = np.sqrt(np.bincount(of, w * w, len(texts)))
        good = w > 0
        return at[good], of[good], w[good] / norm[of[good]]

    def votes(self, texts: list[str | None], without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distance-weighted share of toxic neighbours, -1 without a neighbour; neighbours; cosines)."""
        e, c = self.index.nearest(*self.vectors(texts), len(texts), self.k, without)
        w = np.where(c > 0, 1 / (1.05 - np.minimum(c, 1)), 0)
        total = w.sum(1)
        return np.where(total > 0, (w * self.labels[e]).sum(1) / np.where(total > 0, total, 1), -1.0), e, c

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[int]], list[list[float]]]:
        """(scores in 0..1, ids of the nearest examples, their cosines)."""
        if not len(self.example_ids):
            return np.full(len(texts), self.blank), [[]] * len(texts), [[]] * len(texts)
        raw, e, c = self.votes(texts)
        ids = self.example_ids[e]
        seen = (c > 0).sum(1).tolist()
        return np.where(raw < 0, self.blank, np.interp(raw, *self.steps)), [i[:m] for i, m in zip(ids.tolist(), seen)], [x[:m] for x, m in zip(c.tolist(), seen)]


def chunks(texts: list, size: int = 64, room: int = 500_000) -> Iterator[slice]:
    """Slices of texts of so many texts and about so many characters at most."""
    at = total = 0
    for i, t in enumerate(texts):
        if i > at and (i - at == size or total > room):
            yield slice(at, i)
            at, total = i, 0
        total += len(t or "")
    if at < len(texts):
        yield slice(at, len(texts))


def build(ids: list[int], labels: np.ndarray, texts: list[str], weight: dict[int, float], k: int) -> Model:
    """A model of examples. weight: how many labelled texts an example of each label stands for."""
    # the driver holds some bytes for each term of an example: hashes go part by part
    parts = []
    for part in chunks(texts):
        h, of, n = counted(*terms(texts[part]))
        parts.append([h, (of + part.start).astype(np.int32), n.astype(np.float32)])
    found = np.empty(0, np.uint64)
    for h, _, _ in parts:
        found = np.union1d(found, h)
    for p in parts:
        p[0] = np.searchsorted(found, p[0]).astype(np.int32)
    term, of, count = (np.concatenate(x) for x in zip(*parts))
    del parts
    n, bad, good = len(ids), float(labels.sum()), float((1 - labels).sum())
    b, g = np.bincount(term, labels[of]), np.bincount(term, 1 - labels[of])

    def part_(cell: np.ndarray, row: np.ndarray, column: float) -> np.ndarray:
        return cell * np.log(np.where(cell > 0, cell * n / (row * column + (row == 0)), 1))

    ratio = 2 * (part_(b, b + g, bad) + part_(g, b + g, good) + part_(bad - b, n - b - g, bad) + part_(good - g, n - b - g, good))
    worth = (np.log((n + 1) / (b + g + 1)) + 1) * np.sqrt(np.maximum(ratio, 0))
    keys = HashArray(found)
    # terms in the order of the hash array
    rank = np.empty(len(found), np.int32)
    rank[keys.order] = np.arange(len(found))
    term, worth = rank[term], worth[keys.order]
    w = (1 + np.log(count)) * worth[term].astype(np.float32)
    del count
    norm = np.sqrt(np.bincount(of, w * w, n))
    some = w > 0
    term, of, w = term[some], of[some], w[some]
    w /= norm[of].astype(np.float32)
    # examples of one label with the same strongest term stand together
    strongest = np.zeros(n, np.int64)
    by = np.argsort(w, kind="stable").astype(np.int32)
    strongest[of[by]] = term[by]
    del by
    order = np.lexsort((np.array(ids), strongest, labels))
    place = np.empty(n, np.int32)
    place[order] = np.arange(n)
    index = BlockMaxIndex(term, place[of], w, n, len(found), worth)
    del term, of, w
    empty = norm == 0
    none = float((empty * labels).sum()) * weight[1], float((empty * (1 - labels)).sum()) * weight[0]
    line = np.array([0.0, 1.0])
    model = Model(keys, worth, index, np.array(ids)[order], labels[order].astype(float), (line, line), none[0] / (sum(none) + 1), k)
    sorted_texts = [texts[i] for i in order.tolist()]
    raw = np.concatenate([model.votes(sorted_texts[p], np.arange(p.start, p.stop))[0] for p in chunks(sorted_texts)])
    seen = raw >= 0
    if seen.any():
        y = model.labels[seen]
        model.steps = _isotonic(raw[seen], y, np.where(y > 0, weight[1], weight[0]))
    released()
    return model


def fit(docs: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, k: int = NEIGHBOURS) -> Model:
    """A model from the labelled rows where the column ``train`` (over the labels table) holds.

    Of each label about ``sample`` ids are taken, by a hash of the id (labels that are null are left out; an id with several labels counts with the
    greatest). Sampled texts that are near copies of each other (same least shingle) count once. Without labelled texts every score is 0.
    """
    spark = docs.sparkSession
    known = labels.where(train & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("i")).agg(F.max(label_col).cast("int").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    place = F.pmod(F.xxhash64("i", F.lit(7)), F.lit(1 << 20))
    cut = F.lit(0.0)
    for y, n in sizes.items():
        cut = F.when(F.col("y") == y, min(1.0, sample / n)).otherwise(cut)
    known = known.where(place < cut * (1 << 20))
    # the sample is bounded by the parameter, so it can go to every task
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(known), "i")
    rows = written(rows.mapInArrow(tidy(_least_shingle), "i long, y int, t string, s long"), "toxsample")
    rows = rows.join(rows.groupBy("s", "y").agg(F.min("i").alias("i")), ["i", "s", "y"], "left_semi")
    rows = written(rows.groupBy("i").agg(F.min(F.struct("t", "y")).alias("r")).select("i", "r.y", "r.t"), "toxexamples")
    data = rows.orderBy("i").collect()  # the bounded sample
    total = {y: sum(r["y"] == y for r in data) for y in (0, 1)}
    if not total[0] or not total[1]:
        zero = np.zeros(2)
        return Model(HashArray(np.empty(0, np.uint64)), np.empty(0), BlockMaxIndex(*[np.empty(0, np.int64)] * 2, np.empty(0), 0, 0, np.empty(0)), np.empty(0, np.int64), np.empty(0), (zero, zero), float(total[1] > 0), k)
    return build([r["i"] for r in data], np.array([r["y"] for r in data]), [r["t"] or "" for r in data], {y: sizes[y] / total[y] for y in total}, k)


def _least_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.select(["i", "y", "t"]).slice(at, 500)
            texts = part.column(2).to_pylist()
            h, of = shingles(texts)
            least = np.full(len(texts), 2**64 - 1, np.uint64)
            np.minimum.at(least, of, mix(h))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least.view(np.int64))], ["i", "y", "t", "s"])


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression (pool adjacent violators) as points of a piecewise linear map."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order]):
        pools.append([a, a, b * c, c])
        while len(pools) > 1 and (pools[-2][1] == pools[-1][0] or pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]):
            low, high, s, n = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + s, pools[-1][3] + n]
    points = [(q, (s + 0.02) / (n + 0.04)) for low, high, s, n in pools for q in ((low,) if low == high else (low, high))]
    return np.array([p for p, _ in points]), np.array([v for _, v in points])


JUDGED = "score double, examples array<long>, cosines array<double>"


def judge(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, name: str = "toxicity") -> DataFrame:
    """The columns ``keep`` of docs (all by default) with the struct ``name``: score, and as evidence the nearest examples' ids and cosines.

    Null and empty texts and texts that share no term with an example get the model's score for such texts and no evidence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(JUDGED)
    def run(texts: pa.Array) -> pa.Array:
        score, ids, cosines = [], [], []
        found = texts.to_pylist()
        for part in chunks(found):
            x, i, c = shared.value.scores(found[part])
            score.append(x)
            ids += i
            cosines += c
        released()
        return pa.StructArray.from_arrays([pa.array(np.concatenate(score) if score else [], pa.float64()), pa.array(ids, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))], ["score", "examples", "cosines"])

    columns = [docs[f"`{c}`"] for c in (keep if keep is not None else docs.columns)]
    return docs.select(*columns, run(docs[f"`{text_col}`"].cast("string")).alias(name))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> toxicity score of each; labels of one fifth of the ids are held out of the fit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), id_bucket("doc_id", 5) != 0)
    judged = judge(docs, model, keep=["doc_id"])
    return judged.select("doc_id", (id_bucket("doc_id", 5) == 0).alias("held_out"), "toxicity.score", (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"), F.col("toxicity.examples").alias("nearest_examples"), F.col("toxicity.cosines").alias("nearest_cosines"))
