"""Token-ID output: flat unsigned integer files with 64-bit document offsets, read back memory-mapped.

A shard is two files. ``<name>.bin`` holds the ids of its documents one after another, as little-endian
unsigned integers of ``dtype``. ``<name>.idx`` holds the magic ``TOKIDX01``, the width of an id (u32), a flag word (u32),
the number n of documents (u64), n+1 offsets (u64, in ids, from 0), n document ids (i64) and n validity bytes
(0: the document id is null). The shards' manifest (a Parquet table) gives each shard's place in document order and
its sizes; the base of a shard (the ids before it) is a prefix sum over the manifest, so a writer never waits for another.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, partitions, tidy
from .wordcache import encoder, forget

MAGIC = b"TOKIDX01"
MANIFEST = "shard int, name string, documents long, ids long, width int"


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class ShardWriter:
    """Streams documents into one shard; the files get their names only when they are whole."""

    def __init__(self, folder: str, width: int):
        self.fs, self.root = _fs(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.name, self.width = f"shard-{uuid.uuid4().hex}", width
        self.sink = self.fs.open_output_stream(f"{self.root}/{self.name}.bin.part", buffer_size=1 << 20)
        self.lengths: list[int] = []
        self.ids: list[int] = []
        self.valid = bytearray()

    def add(self, doc_ids: list[int | None], payloads: list[bytes]) -> None:
        self.sink.write(b"".join(payloads))
        self.lengths += [len(p) // self.width for p in payloads]
        self.ids += [i or 0 for i in doc_ids]
        self.valid += bytes(i is not None for i in doc_ids)

    def close(self) -> tuple[str, int, int]:
        self.sink.close()
        n = len(self.ids)
        offsets = np.zeros(n + 1, "<u8")
        np.cumsum(self.lengths, out=offsets[1:])
        with self.fs.open_output_stream(f"{self.root}/{self.name}.idx.part") as f:
            f.write(MAGIC + struct.pack("<IIQ", self.width, 0, n) + offsets.tobytes() + np.array(self.ids, "<i8").tobytes() + bytes(self.valid))
        for kind in ("bin", "idx"):
            self.fs.move(f"{self.root}/{self.name}.{kind}.part", f"{self.root}/{self.name}.{kind}")
        return self.name, n, int(offsets[-1])


class Shard:
    """One shard read back: memory-mapped where the folder is on a mounted file system, else streamed in."""

    def __init__(self, folder: str, name: str):
        fs, root = _fs(folder)
        with fs.open_input_file(f"{root}/{name}.idx") as f:
            head = f.read()
        if head[:8] != MAGIC:
            raise ValueError(f"{name}.idx is no token index")
        width, _, n = struct.unpack_from("<IIQ", head, 8)
        self.offsets = np.frombuffer(head, "<u8", n + 1, 24)
        self.ids = np.frombuffer(head, "<i8", n, 24 + 8 * (n + 1))
        self.valid = np.frombuffer(head, "u1", n, 24 + 8 * (2 * n + 1))
        dtype, path = f"<u{width}", f"{root}/{name}.bin"
        if not int(self.offsets[-1]):
            self.tokens = np.empty(0, dtype)
        elif isinstance(fs, pafs.LocalFileSystem):
            self.tokens = np.memmap(path, dtype, "r")
        else:
            with fs.open_input_file(path) as f:
                self.tokens = np.frombuffer(f.read(), dtype)

    def __len__(self) -> int:
        return len(self.ids)

    def document(self, i: int) -> np.ndarray:
        return self.tokens[int(self.offsets[i]) : int(self.offsets[i + 1])]


def _task_writer(folder: str, path: str, end: int | None, words: bool, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path, words, f"<u{width}").encode
        tail = b"" if end is None else int(end).to_bytes(width, "little")
        writer = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                writer = writer or ShardWriter(folder, width)
                writer.add(part.column(0).to_pylist(), [x.tobytes() + tail for x in ids_of(part.column(1).to_pylist())])
        if writer:
            name, n, total = writer.close()
            shard = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "name": [name], "documents": pa.array([n], pa.int64()), "ids": pa.array([total], pa.int64()), "width": pa.array([width], pa.int32())}
            )

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", words: bool = False, width: int = 2) -> DataFrame:
    """Writes docs as token shards under folder, in ascending id order, and returns the manifest (reread).

    Null texts count as empty. Rows with one id are ordered by text (null first) and each is kept; a null id sorts
    first. An empty table gives no shard. Other columns of docs are not read.

    One range shuffle on the id; the ids are made after it, so that only the scan runs twice (once for the range bounds). A lost task
    leaves unnamed or unlisted files; the manifest lists the shards of the tasks that were committed.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    rows = rows.repartitionByRange(2 * partitions(spark), "i").sortWithinPartitions("i", "t")
    manifest = rows.mapInArrow(tidy(_task_writer(f"{folder}/shards", tokenizer_path, end_id, words, width)), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a token folder: doc_id, start (ids before it), n_tokens, ids_crc32 (of 32-bit little-endian ids).

    The manifest has a row for each shard, i.e. for each task that wrote; its prefix sums are made on the driver.
    """
    base, listed = 0, []
    for r in spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("shard").collect():
        listed.append((r["name"], base))
        base += r["ids"]
    shards = spark.createDataFrame(listed or [], "name string, base long").repartition(max(1, len(listed)), "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = Shard(f"{folder}/shards", name)
                for at in range(0, len(s), 20_000):
                    to = min(len(s), at + 20_000)
                    o = s.offsets[at : to + 1].astype(np.int64)
                    crc = [zlib.crc32(s.tokens[x:y].astype("<u4")) for x, y in zip(o.tolist(), o[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.ids[at:to], mask=s.valid[at:to] == 0), pa.array(o[:-1] + first), pa.array(np.diff(o)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return shards.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> token files -> one digest row per document, from the files."""
    import public_tokenizers as P

    folder = new_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, P.path("byte_bpe_50k.json"), 2)
    return read_tokens(spark, folder)
