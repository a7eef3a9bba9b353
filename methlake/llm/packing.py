"""Packing along a space-filling curve.

A document becomes a vector of hashed token counts, projected to a few dimensions; its place on a Hilbert curve through
those dimensions is its key. Documents are laid end to end in key order, and that one stream is cut every ``length``
tokens: neighbours on the curve share sequences, and only the last sequence of all has padding.

The curve is cut into parts at quantiles of the keys (the low bits of a key are a hash of the id, so that any number of copies of one
text can be split). The tokens before a part are a prefix sum over the parts' totals, a row for each part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import partitions, tidy, written
from .shingles import mix
from .wordcache import encoder, forget

DIMS, BITS, BUCKETS, TIE_BITS = 4, 12, 256, 15
ENCODED = "doc_id long, key long, n int, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indices (int64) of integer points [n, dims] with coordinates under 2**bits; dims*bits <= 62.

    Gray-code form of the curve: from the highest bit down, each set bit of a coordinate reflects the lower bits of the first
    coordinate, each unset bit exchanges them; the result is then Gray-decoded across the coordinates.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for d in range(dims):
            hit = (x[d] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> b) & 1)
    return out


def _projection() -> np.ndarray:
    """BUCKETS x DIMS with orthonormal columns, from hashes."""
    raw = (mix(np.arange(1, BUCKETS * DIMS + 1, dtype=np.uint64)) >> np.uint64(11)).astype(float) / 2**53 - 0.5
    return np.linalg.qr(raw.reshape(BUCKETS, DIMS))[0]


def _keys(payloads: list[bytes], ids: list, dtype: str, projection: np.ndarray) -> np.ndarray:
    lengths = np.array([len(p) for p in payloads]) // np.dtype(dtype).itemsize
    tokens = np.frombuffer(b"".join(payloads), dtype)
    bucket = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)[tokens & 0xFFFF]
    row = np.repeat(np.arange(len(payloads)), lengths)
    vectors = np.sqrt(np.bincount(row * BUCKETS + bucket, minlength=len(payloads) * BUCKETS).reshape(-1, BUCKETS))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    places = np.clip(np.round((vectors @ projection + 1) / 2 * (2**BITS - 1)), 0, 2**BITS - 1)
    tie = mix(np.array([0 if i is None else i for i in ids], np.int64).view(np.uint64)) & np.uint64(2**TIE_BITS - 1)
    return (hilbert(places, BITS) << TIE_BITS) | tie.astype(np.int64)


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", words: bool = True) -> DataFrame:
    """doc_id, curve key, number of ids, ids (16-bit) of every row of docs; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, projection = encoder(tokenizer_path, words).encode, _projection()
        tail = b"" if end_id is None else int(end_id).to_bytes(2, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column(0).to_pylist()
                payloads = [x.tobytes() + tail for x in ids_of(part.column(1).to_pylist())]
                n = pa.array([len(p) // 2 for p in payloads], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_keys(payloads, ids, "<u2", projection)), n, pa.array(payloads, pa.binary())], ["doc_id", "key", "n", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(tidy(run), ENCODED)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, length: int = 4096, id_col: str = "doc_id", text_col: str = "text", words: bool = True) -> DataFrame:
    """A row for each piece: doc_id, start, length, doc_tokens, sequence_id, offset and its ids (32-bit little-endian).

    Every id of every row of docs lies in exactly one piece; sequence_id counts from 0 without gaps, and all sequences but the last are
    full. Null text counts as empty (its piece is the end id; without end id it has no piece); repeated rows are packed once each, rows with one
    key in id order; an empty table gives no rows. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    rows = written(encoded(docs, tokenizer_path, end_id, id_col, text_col, words), "encoded")
    parts = 4 * partitions(spark)
    cuts = rows.select(F.percentile_approx("key", [k / parts for k in range(1, parts)], 20 * parts)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @arrow_udf("int")
    def part(key: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, key.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    rows = rows.withColumn("part", part("key"))
    base, before = {}, 0
    for r in sorted(rows.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        base[r["part"]] = before
        before += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # the encoders of the stage before
        at, now = 0, None
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                for doc_id, p, payload in zip(*(c.to_pylist() for c in batch.slice(first, 200).columns)):
                    if p != now:
                        now, at = p, base[p]
                    ids = np.frombuffer(payload, "<u2")
                    start = 0
                    while start < len(ids):
                        n = min(length - at % length, len(ids) - start)
                        out.append((doc_id, start, n, len(ids), at // length, at % length, ids[start : start + n].astype("<u4").tobytes()))
                        start, at, size = start + n, at + n, size + n
                        if size > 500_000:
                            yield _batch(out)
                            out, size = [], 0
        yield _batch(out)

    dealt = rows.select("doc_id", "part", "ids", "key").repartition(parts, "part").sortWithinPartitions("part", "key", "doc_id", "ids")
    return dealt.select("doc_id", "part", "ids").mapInArrow(tidy(run), PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    columns = list(zip(*rows)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())], [*names, "ids"])


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> pieces of sequences of 4096 tokens."""
    import public_tokenizers as P

    return piece_digests(pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("word_bpe_49k.json")))
