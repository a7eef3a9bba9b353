"""Removal of long strings that occur more than once in a corpus, found with run-length indexes.

Every string of ``length`` bytes has a designated anchor: the leftmost, least-hashed gram of ANCHOR bytes in it (winnowing). Equal strings have equal
anchors at equal offsets, so the starts of a text fall into runs with one anchor each, and a run need only be compared with the
runs of the same anchor. Anchors that occur once in the corpus are dropped; the rest of the runs go, with the bytes their strings cover, to the task of their
anchor, where a run-length index of all runs there streams their matching statistics (``rindex``). No string of the corpus is in two
runs, so a match of ``length`` in an index is a repeated string.

An anchor with very many runs (a passage in a large part of all texts) would not fit one task. Of its runs with the same bytes one is taken (the others are
marked already), and what is left is halved, level by level, along their offsets
from the anchor: the bytes that all strings of a half share must occur elsewhere, or the half is dropped; if all
bytes it covers occur elsewhere, it is marked; else it is halved again. This needs counts by digest only, which are summed before each shuffle.

Exact copies are one text (marked whole). All byte places are counted from 0.
"""

from __future__ import annotations

import uuid as uuids
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, new_path, partitions, tidy, written
from .rindex import MAX_TEXT, RunIndex
from .shingles import mix, powers

LENGTH, ANCHOR = 400, 96
#: runs of one anchor that one index takes
CROWD = 600
#: bytes of a text that are looked at together
SLAB = 1 << 23


def anchor_runs(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first start, last start) of the runs of a text's strings, in order."""
    parts = []
    for at in range(0, max(0, len(data) - length + 1), SLAB):
        d = data[at : at + SLAB + length - 1]
        n, w = len(d) - gram + 1, length - gram + 1
        up, down = powers(len(d) + 1)
        run = np.zeros(len(d) + 1, np.uint64)
        np.cumsum((d.astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
        h = mix((run[gram:] - run[:-gram]) * down[:n])
        # the order is by hash, then by place: 40 and 24 bits
        key = (h >> np.uint64(24) << np.uint64(24)) | np.arange(n, dtype=np.uint64)
        padded = np.concatenate([key, np.full(-n % w, 2**64 - 1, np.uint64)]).reshape(-1, w)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        m = n - w + 1
        least = (np.minimum(behind[:m], ahead[w - 1 : w - 1 + m]) & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], m) - 1
        a = least[first]
        parts.append((h[a].view(np.int64), a + at, first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 4


RUNS = "text_id binary, x long, a long, lo long, hi long"


def _runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts_ = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 2000):
                part = texts_.slice(at, 2000).to_pylist()
                found = [anchor_runs(np.frombuffer(t, "u1"), length, gram) for t in part]
                n = [len(f[0]) for f in found]
                owner = pa.array(np.repeat(np.arange(at, at + len(part)), n))
                columns = [np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(4)]
                yield pa.RecordBatch.from_arrays([ids.take(owner), *(pa.array(c) for c in columns)], ["text_id", "x", "a", "lo", "hi"])

    return texts.select("text_id", "bytes").where(F.length("bytes") >= length).mapInArrow(tidy(run), RUNS)


SPANS = "text_id binary, b long, e long"


def _indexed(contexts: DataFrame, length: int, gram: int, crowd: int) -> DataFrame:
    """Spans of repeated strings of runs (text_id, x, lo, bytes); the runs of one x, ``crowd`` at most, stand together in a partition."""
    # a run covers 2 * length - gram bytes at most; an index takes what came before and one more anchor
    room = MAX_TEXT - crowd * (2 * length - gram + 1)
    if room < 0:
        raise ValueError("crowd is too large for one index")

    def found(group: list[list[tuple[bytes, int, bytes]]]) -> pa.RecordBatch:
        """group: the anchors' runs. Runs with the same bytes are marked at once, and one of them is indexed."""
        ids, b, e = [], [], []
        chosen: list[tuple[bytes, int, bytes]] = []
        for runs in group:
            if len(runs) < 2:
                continue
            alike: dict[bytes, list[tuple[bytes, int, bytes]]] = {}
            for r in runs:
                alike.setdefault(r[2], []).append(r)
            for data, same in alike.items():
                if len(same) > 1:
                    for i, lo, _ in same:
                        ids.append(i)
                        b.append(lo)
                        e.append(lo + len(data))
            if len(alike) > 1:
                chosen += [same[0] for same in alike.values()]
        if chosen:
            index = RunIndex([g[2] for g in chosen])
            hit = index.repeated(length)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view("i1"), [0]])))
            owner = np.searchsorted(index.begin, edge[::2], "right") - 1
            for k, s, t in zip(owner.tolist(), edge[::2].tolist(), edge[1::2].tolist()):
                base = chosen[k][1] - int(index.begin[k])
                ids.append(chosen[k][0])
                b.append(base + s)
                e.append(base + t - 1 + length)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(b, pa.int64()), pa.array(e, pa.int64())], ["text_id", "b", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[list[tuple[bytes, int, bytes]]] = []
        size, now = 0, None
        for batch in batches:
            for i, x, lo, data in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if x != now:
                    if size > room:
                        yield found(group)
                        group, size = [], 0
                    now = x
                    group.append([])
                group[-1].append((i, lo, data))
                size += len(data) + 1
        yield found(group)

    return contexts.select("text_id", "x", "lo", "bytes").mapInArrow(tidy(run), SPANS)


def _halved(crowded: DataFrame, contexts: Callable[[DataFrame], DataFrame], length: int) -> DataFrame:
    """Spans of repeated strings of the runs (text_id, x, a, lo, hi) of crowded anchors. contexts adds the bytes that a run's strings cover.

    Runs with the same bytes at the same place from the anchor are marked whole, and one of them stands for them from here on; the rest is halved.
    """
    digests = written(contexts(crowded).select("text_id", "x", "a", "lo", "hi", F.md5("bytes").alias("d")), "digests")
    key = ["x", "off", "d"]
    digests = digests.withColumn("off", F.expr("a - lo"))
    # every count is written: a join with it has an exchange on both sides, and adaptive execution can split what one passage brings
    groups = written(digests.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("text_id", "a", "lo", "hi")).alias("r")), "alike", few=True)
    same = groups.where("n > 1").select(*key)
    done = written(digests.join(same, key, "left_semi").select("text_id", F.col("lo").alias("b"), (F.col("hi") + length).alias("e")), "spans")
    size = 1
    while size * 2 <= length // 2:
        size *= 2
    # a half is the strings whose anchor is b .. b+size-1 bytes after their start
    starts = F.expr(f"sequence(((a - hi) div {size}) * {size}, a - lo, {size})")
    nodes = contexts(groups.select("r.text_id", "x", "r.a", "r.lo", "r.hi")).withColumn("b", F.explode(starts))
    stale = [digests, groups]
    while True:
        first, last = F.expr(f"a - b - {size - 1}"), F.expr("a - b")
        core = F.expr(f"md5(substring(bytes, cast(a - b - lo + 1 as int), {length + 1 - size}))")
        whole = (first >= F.col("lo")) & (last <= F.col("hi"))
        union = F.when(whole, F.expr(f"md5(substring(bytes, cast(a - b - {size - 1} - lo + 1 as int), {length - 1 + size}))"))
        t = written(nodes.withColumn("core", core).withColumn("whole", union), "halves")
        discard(*stale)
        # counts of the bytes that all strings of a half share, and of all that it covers; of halves with one whole the keeper stays as the other place of what remains
        both = F.array(F.struct(F.lit(0).alias("kind"), F.col("core").alias("d")), F.struct(F.lit(1).alias("kind"), F.col("whole").alias("d")))
        counts = t.select("x", "b", "text_id", "lo", F.explode(both).alias("k")).where("k.d is not null").groupBy("x", "b", "k.kind", "k.d")
        counts = written(counts.agg(F.count("*").alias("n"), F.min(F.struct("text_id", "lo")).alias("keeper")).where("n > 1").drop("n"), "counts", few=True)
        cores = counts.where("kind = 0").select("x", "b", F.col("d").alias("core"))
        wholes = counts.where("kind = 1").select("x", "b", F.col("d").alias("whole"), "keeper")
        live = t.join(cores, ["x", "b", "core"], "left_semi")
        span = F.struct(F.greatest(first, "lo").alias("b"), (F.least(last, "hi") + length).alias("e"))
        if size == 1:
            done = done.unionByName(written(live.select("text_id", span.alias("s")).select("text_id", "s.*"), "spans"))
            discard(t, counts)
            return done
        live = live.join(wholes, ["x", "b", "whole"], "left").withColumn("s", F.when(F.col("keeper").isNotNull(), span))
        goes_on = F.col("keeper").isNull() | (F.col("keeper") == F.struct("text_id", "lo"))
        live = written(live.select("text_id", "x", "a", "lo", "hi", "b", "s", F.when(goes_on, F.col("bytes")).alias("bytes")), "live")
        done = done.unionByName(live.where("s is not null").select("text_id", "s.*"))
        left = live.where("bytes is not null")
        nodes = left.select("text_id", "x", "a", "lo", "hi", "bytes", F.explode(F.array(F.col("b"), F.col("b") + size // 2)).alias("b"))
        discard(t, counts)
        stale = []
        size //= 2
        nodes = nodes.where(F.expr(f"a - b >= lo and a - b - {size - 1} <= hi"))


def repeated_strings(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = ANCHOR, crowd: int = CROWD, as_text: bool = False) -> DataFrame:
    """text_id, n_bytes, spans, kept of every distinct text of docs.

    text_id: the first 16 bytes of the SHA-256 of the text (UTF-8; null is the empty text). spans: the maximal runs of bytes covered by strings of
    ``length`` bytes that start at another place of the corpus too, in this or another row, as an array of (start, end). kept: the other bytes; with as_text
    as a string (a character that loses some of its bytes goes whole).
    Texts shorter than ``length`` have no span. An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(text_bytes(text_col).alias("bytes"))
    rows = rows.withColumn("text_id", text_id("bytes"))
    # written in buckets of the id, so that the later joins move only their other side
    name, path = f"texts_{uuids.uuid4().hex}", new_path(spark, "texts")
    one = rows.groupBy("text_id").agg(F.first("bytes").alias("bytes"), F.count("*").alias("copies"))
    one.repartition(n, "text_id").write.bucketBy(n, "text_id").sortBy("text_id").option("path", path).option("compression", "zstd").saveAsTable(name)
    texts = spark.table(name)
    spark.sql(f"drop table {name}")  # the entry only: an external table's files stay, and texts knows them
    runs = written(_runs(texts, length, gram), "runs")
    # the counts are written, so that the join has an exchange on both sides and a crowded anchor can be split
    counts = written(runs.groupBy("x").agg(F.count("*").alias("n")).where("n > 1"), "anchors", few=True)
    shared = written(runs.join(counts, "x"), "shared")

    def contexts(chosen: DataFrame) -> DataFrame:
        """The chosen runs with the bytes that their strings cover."""
        per_text = chosen.groupBy("text_id").agg(F.collect_list(F.struct("x", "a", "lo", "hi")).alias("runs"))
        cut = texts.select("text_id", "bytes").join(per_text, "text_id").select("text_id", "bytes", F.explode("runs").alias("r"))
        piece = F.expr(f"substring(bytes, cast(r.lo + 1 as int), cast(r.hi - r.lo + {length} as int))")
        return cut.select("text_id", "r.x", "r.a", "r.lo", "r.hi", piece.alias("bytes"))

    common = contexts(shared.where(F.col("n") <= crowd)).select("text_id", "x", "lo", "bytes").repartition(4 * n, "x").sortWithinPartitions("x")
    spans = _indexed(common, length, gram, crowd)
    if not counts.where(F.col("n") > crowd).isEmpty():
        spans = spans.unionByName(_halved(shared.where(F.col("n") > crowd), contexts, length))
    per_text = spans.groupBy("text_id").agg(F.collect_list(F.struct("b", "e")).alias("spans"))
    joined = texts.join(per_text, "text_id", "left")
    return joined.select("text_id", "bytes", "copies", "spans").mapInArrow(tidy(_cutter(length, as_text)), CUT.replace("kept binary", "kept string") if as_text else CUT)


CUT = "text_id binary, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _cutter(length: int, as_text: bool):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, data, copies, spans in zip(*(batch.column(k).to_pylist() for k in range(4))):
                merged: list[list[int]] = []
                if copies > 1 and len(data) >= length:
                    merged = [[0, len(data)]]
                else:
                    for s in sorted((s["b"], s["e"]) for s in spans or ()):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append(list(s))
                at, kept = 0, []
                for b, e in merged:
                    kept.append(data[at:b])
                    at = e
                kept.append(data[at:])
                left = b"".join(kept)
                out.append((i, len(data), [{"start": b, "end": e} for b, e in merged], left.decode("utf-8", "ignore") if as_text else left))
                if len(out) == 500:
                    yield _cut_batch(out, kind, as_text)
                    out = []
            yield _cut_batch(out, kind, as_text)

    return run


def _cut_batch(out: list[tuple], kind: pa.DataType, as_text: bool) -> pa.RecordBatch:
    i, n, spans, kept = zip(*out) if out else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(i, pa.binary()), pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.string() if as_text else pa.binary())], ["text_id", "n_bytes", "spans", "kept"])


def text_bytes(text_col: str):
    return F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))


def text_id(bytes_col):
    return F.unhex(F.substring(F.sha2(bytes_col, 256), 1, 32))


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = ANCHOR) -> DataFrame:
    """All columns and rows of docs with the repeated strings cut out of the text (a character that loses some of its bytes goes whole); null stays null."""
    found = repeated_strings(docs, text_col, length, gram, as_text=True).where(F.size("spans") > 0).select(F.col("text_id").alias("__text_id"), F.col("kept").alias("__kept"))
    joined = docs.withColumn("__text_id", text_id(text_bytes(text_col))).join(found, "__text_id", "left")
    text = F.when(F.col("__kept").isNotNull(), F.col("__kept")).otherwise(F.col(f"`{text_col}`"))
    return joined.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def op8_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> what is removed from each, as counts and a digest of what is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = repeated_strings(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    digests = found.select("text_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return docs.select("doc_id", text_id(text_bytes("text")).alias("text_id")).join(digests, "text_id").drop("text_id")
