"""BagMinHash: near-duplicate texts by weighted Jaccard similarity of their shingle multisets (after Ertl, 2018).

The weight axis of a shingle is cut at 1, 2, 4, 8 ...; each interval holds a Poisson process of rate equal to its width, seeded by the shingle and the
interval alone. A point of the process has a time (sums of exponential gaps), a place in the interval and one of the m signature slots.
A text keeps, for each slot, the least time among the points that lie below the shingles' counts; two texts agree in a slot with a probability equal to
their weighted Jaccard similarity (sum of minima over sum of maxima). Points are made in time order, only while they can be
under the text's greatest slot, so that most intervals stop after their first point.

Signatures are banded; texts that share a band, directly or over others, are candidates and their multisets are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, tidy, written
from .components import components
from .shingles import counted, mix, shingles

#: 24 bands of 4 slots: a pair at similarity 0.8 shares no band with probability (1 - 0.8**4)**24 = 3e-6
BANDS, ROWS, SIZE, THRESHOLD = 24, 4, 5, 0.8
#: nodes and bytes of text of a block that is compared with another in one task, on average
BLOCK, BYTES = 512, 4 << 20


def signatures(h: np.ndarray, of: np.ndarray, count: np.ndarray, texts: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(least times [texts, m], seeds of the points that hold them [texts, m]) of weighted shingles; infinite and 0 where a text has none."""
    time = np.full(texts * m, np.inf)
    holder = np.zeros(texts * m, np.uint64)
    cells = [(h, of, np.zeros(len(h)), np.ones(len(h)), count)]
    low = 1
    while len(over := np.flatnonzero(count > low)):
        cells.append((mix(h[over] + np.uint64(0x51ED270B * low % 2**64)), of[over], np.full(len(over), float(low)), np.full(len(over), float(low)), count[over]))
        low *= 2
    seed, of, floor, width, count = (np.concatenate(x) for x in zip(*cells))
    at = np.zeros(len(seed))
    k = 0
    while len(seed):
        k += 1
        point = mix(seed + np.uint64(0x9E3779B97F4A7C15 * k % 2**64))
        at = at - np.log(((point >> np.uint64(11)).astype(float) + 0.5) / 2**53) / width
        other = mix(point ^ np.uint64(0xA0761D6478BD642F))
        slot = of * m + ((other >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        place = floor + width * ((other & np.uint64(0xFFFFFFFF)).astype(float) / 2**32)
        good = np.flatnonzero((place < count) & (at < time[slot]))
        good = good[np.argsort(-at[good], kind="stable")]  # the least time is written last
        time[slot[good]] = at[good]
        holder[slot[good]] = point[good]
        most = time.reshape(texts, m).max(1)
        keep = at < most[of]
        seed, of, floor, width, count, at = seed[keep], of[keep], floor[keep], width[keep], count[keep], at[keep]
    return time.reshape(texts, m), holder.reshape(texts, m)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, each as (sorted hashes, counts)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - least
    return least / total if total else 0.0


SIGNED = "doc_id long, print binary, total long, bytes long, bands array<long>"


def signed(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, a 128-bit print of the whole shingle multiset (null for texts without a word), its size, the text's bytes, and the bands' hashes."""
    import pyarrow.compute as pc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column(1), batch.column(0)
            for at, n in _chunks(texts, 3_000_000):
                part = texts.slice(at, n).to_pylist()
                h, of, count = counted(*shingles(part, size))
                _, holder = signatures(h, of, count, n, bands * rows)
                band = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    band = mix(band * np.uint64(31) + holder[:, r::rows] + np.uint64(r))
                band = mix(band + np.arange(bands, dtype=np.uint64))
                w = mix(h + mix(count.astype(np.uint64)))
                some = np.bincount(of, minlength=n) > 0
                prints = np.zeros((n, 2), np.uint64)
                if len(h):
                    starts = np.searchsorted(of, np.flatnonzero(some))
                    prints[some, 0] = np.add.reduceat(w, starts)
                    prints[some, 1] = np.add.reduceat(mix(w ^ np.uint64(0x2545F4914F6CDD1D)), starts)
                prints = [p.tobytes() if s else None for p, s in zip(prints, some)]
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands), pa.int32()), pa.array(band.view(np.int64).ravel()))
                total = pa.array(np.bincount(of, count, n).astype(np.int64))
                size_ = pc.fill_null(pc.binary_length(texts.slice(at, n)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids.slice(at, n), pa.array(prints, pa.binary()), total, size_, values], ["doc_id", "print", "total", "bytes", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(tidy(run), SIGNED)


def _chunks(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of runs of about so many bytes of an Arrow string array."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        total += n
        if total >= size:
            yield at, i + 1 - at
            at, total = i + 1, 0
    if at < len(lengths):
        yield at, len(lengths) - at


def links_of_block(x: list[tuple[int, str]], y: list[tuple[int, str]] | None, size: int, threshold: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between two blocks of (node, text), or inside one.

    A multiset is the set of its (shingle, i-th occurrence) pairs; the sizes of all intersections are one product of 0/1 matrices over the
    pairs that two texts or more have.
    """
    both = [*x, *(y or ())]
    h, of, count = counted(*shingles([t for _, t in both], size))
    total = np.bincount(of, count, len(both))
    n = len(x)
    if len(both) < 4:
        cut = np.searchsorted(of, np.arange(len(both) + 1)).tolist()
        sets = [(h[i:j], count[i:j]) for i, j in zip(cut, cut[1:])]
        found = [(i, j) for i in range(n) for j in range(i + 1 if y is None else n, len(both)) if similarity(sets[i], sets[j]) >= threshold]
        return _forest(found, [i for i, _ in both])
    of = np.repeat(of, count)
    feature = np.repeat(h, count)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    feature = mix(feature + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, feature, df = np.unique(feature, return_inverse=True, return_counts=True)
    keep = df[feature] > 1
    of, feature = of[keep], np.unique(feature[keep], return_inverse=True)[1]
    order = np.argsort(feature, kind="stable")
    of, feature = of[order], feature[order]
    width = 8192
    right = slice(0, n) if y is None else slice(n, len(both))
    common = np.zeros((n, right.stop - right.start), np.float32)
    for at in range(0, int(feature[-1]) + 1 if len(feature) else 0, width):
        i, j = np.searchsorted(feature, (at, at + width))
        part = np.zeros((len(both), width), np.float32)
        part[of[i:j], feature[i:j] - at] = 1
        common += part[:n] @ part[right].T
    union = total[:n, None] + total[None, right] - common
    i, j = np.nonzero((union > 0) & (common >= threshold * union - 1e-6))
    if y is None:
        i, j = i[i < j], j[i < j]
    else:
        j = j + n
    # the matrices hold whole numbers, so the quotient decides exactly
    c, u = common[i, j - right.start].astype(float), union[i, j - right.start].astype(float)
    good = c / u >= threshold
    return _forest(list(zip(i[good].tolist(), j[good].tolist())), [k for k, _ in both])


def _forest(pairs: list[tuple[int, int]], nodes: list[int]) -> list[tuple[int, int]]:
    parent = list(range(len(nodes)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for a, b in pairs:
        a_, b_ = root(a), root(b)
        if a_ != b_:
            parent[max(a_, b_)] = min(a_, b_)
            out.append((nodes[a], nodes[b]))
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id, n_distinct, kept: each document with the least id of its class of near duplicates.

    A class is a connected component over the links, pairs of texts with similarity >= threshold; n_distinct counts its distinct
    shingle multisets; kept marks one document of each class (doc_id = class_id). Documents without a word (null, empty) and documents with a null id are classes of their own; rows that
    repeat an id are one document for links and come back each. Other columns of docs are not read.

    Documents with one shingle multiset are one node. Nodes that share a band are joined into candidate groups; inside a group every pair is
    compared exactly, in tiles of two blocks of about ``block`` nodes and BYTES bytes, and a tile gives back the edges of a spanning forest of its
    links. In a group of more than one block, pairs whose sizes alone rule out a link don't meet. So no link of a group is left out, no task holds more than two blocks, and what
    leaves the tiles is linear in their blocks.
    """
    spark = docs.sparkSession
    rows_ = written(signed(docs, id_col, text_col, size, bands, rows), "signed")
    member = rows_.where(F.col("print").isNotNull() & F.col("doc_id").isNotNull())
    # what is joined back is written first: with an exchange on both sides a join can split a frequent key
    nodes = written(member.groupBy("print").agg(F.min("doc_id").alias("node")), "nodes", few=True)
    members = written(member.select("doc_id", "print").join(nodes, "print").select("doc_id", "node"), "members")
    # a node stands in for its copies
    heads = members.where("doc_id = node").select("node").distinct()
    banded = member.select(F.col("doc_id").alias("node"), "bands").join(heads, "node", "left_semi")
    buckets = banded.select("node", F.posexplode("bands").alias("k", "v")).select("node", F.xxhash64("k", "v").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("bucket", "hub")
    hubs = written(hubs, "hubs", few=True)
    groups = components(buckets.join(hubs, "bucket"), "node", "hub").withColumnRenamed("component", "grp")
    # rows that repeat an id: one of them stands for the node's size
    weighed = member.groupBy(F.col("doc_id").alias("node")).agg(F.max("total").alias("total"), F.max("bytes").alias("bytes"))
    groups = written(groups.join(weighed, "node"), "groups")
    whole = groups.groupBy("grp").agg(F.count("*").alias("n"), F.sum("bytes").alias("all"))
    # linked multisets differ in size by 1 / threshold at most, i.e. by one class: in a group of many blocks only neighbouring classes meet
    kind = F.floor(F.log("total") / -math.log(0.999 * threshold)) if threshold > 0 else F.lit(0)
    groups = groups.join(whole, "grp").withColumn("kind", F.when((F.col("n") > block) | (F.col("all") > BYTES), kind).otherwise(0).cast("int")).drop("n", "all")
    sizes = written(groups.groupBy("grp", "kind").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("bytes") / BYTES, F.lit(1.0))).cast("int").alias("blocks")), "blocksizes", few=True)
    groups = groups.join(sizes, ["grp", "kind"]).withColumn("b", F.pmod(F.hash("node"), "blocks"))
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    # the groups grow with the corpus: no size at which they would be broadcast
    blocked = texts.join(groups.select("node", "grp", "kind", "blocks", "b").hint("merge"), "node").groupBy("grp", "kind", "blocks", "b").agg(F.collect_list(F.struct("node", "text")).alias("m"))
    blocked = written(blocked, "blocks")
    right = blocked.select("grp", "kind", "b", F.col("m").alias("y"))
    own = blocked.where("size(m) > 1").select(F.col("m").alias("x"), F.lit(None).cast(blocked.schema["m"].dataType).alias("y"))
    # block b meets itself and the half of its class's ring after it: each pair of blocks once, every block as often
    reach = F.floor(F.col("blocks") / 2).cast("int")
    left = blocked.where("blocks > 1").withColumn("step", F.explode(F.sequence(F.lit(1), reach))).where(~((F.col("step") * 2 == F.col("blocks")) & (F.col("b") * 2 >= F.col("blocks"))))
    left = left.select("grp", "kind", F.pmod(F.col("b") + F.col("step"), "blocks").alias("b"), F.col("m").alias("x"))
    # and all blocks of the next class
    after = sizes.select("grp", (F.col("kind") - 1).alias("kind"), F.col("blocks").alias("next"))
    up = blocked.join(after, ["grp", "kind"]).select("grp", (F.col("kind") + 1).alias("kind"), F.explode(F.sequence(F.lit(0), F.col("next") - 1)).alias("b"), F.col("m").alias("x"))
    tiles = own.unionByName(left.unionByName(up).join(right, ["grp", "kind", "b"]).select("x", "y"))
    tiles = tiles.repartition(4 * partitions(spark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                x, y = ([(r["node"], r["text"]) for r in c[k].as_py()] if c[k].is_valid else None for c in batch.columns)
                if y is not None or len(x) > 1:
                    edges += links_of_block(x, y, size, threshold)
            a, b = zip(*edges) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    classes = components(tiles.mapInArrow(tidy(run), "a long, b long"))
    placed = members.join(classes, "node", "left").select("doc_id", "node", F.coalesce("component", "node").alias("class_id"))
    sizes = written(placed.groupBy("class_id").agg(F.countDistinct("node").alias("n_distinct")), "sizes", few=True)
    placed = placed.join(sizes, "class_id").select("doc_id", "class_id", "n_distinct")
    alone = rows_.where(F.col("print").isNull() | F.col("doc_id").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_distinct"))
    return placed.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> class of near duplicates of each document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
