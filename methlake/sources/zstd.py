"""Lines of zstd texts, frame by frame, with every frame's end checked.

Spark's text reader decodes such files too, but takes a file whose last of several frames is cut off for whole. Here a file must end where a frame ends, each frame's content must agree
with its checksum, and bytes that are no frame fail. A file is one task, as a frame cannot be entered in its middle; small files share tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from methlake.sources.files import filesystem, listed

SCHEMA = "file string, n long, value string"
STEP, PACK = 1 << 20, 32 << 20


class Broken(ValueError):
    """A file that is cut off or damaged."""


def content(file, path: str, step: int = STEP) -> Iterator[bytes]:
    """The decoded bytes of all frames of an open file, in pieces."""
    import zstandard

    frame, rest = None, b""
    while True:
        raw = rest or file.read(step)
        rest = b""
        if not raw:
            break
        frame = frame or zstandard.ZstdDecompressor().decompressobj()
        try:
            data = frame.decompress(raw)
        except zstandard.ZstdError as e:
            raise Broken(f"{path}: {e}") from e
        if data:
            yield data
        if frame.eof:
            rest, frame = frame.unused_data, None
    if frame is not None:
        raise Broken(f"{path}: cut off inside a frame")


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class ZstdReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.pattern = options["path"], options.get("pattern", "*.zst")

    def partitions(self) -> list[InputPartition]:
        packs, held = [[]], 0
        for i in listed(self.uri, self.pattern):
            if held and held + i.size > PACK:
                packs, held = [*packs, []], 0
            packs[-1].append(i.path)
            held += i.size
        return [Files(p) for p in packs]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.uri)
        for path in partition.paths:
            with fs.open_input_stream(path, compression=None) as f:
                n, held = 0, b""
                for data in content(f, path):
                    *whole, held = (held + data).split(b"\n")
                    if whole:
                        yield _batch(path, n, whole)
                        n += len(whole)
                if held:
                    yield _batch(path, n, [held])


def _batch(path: str, n: int, lines: list[bytes]) -> pa.RecordBatch:
    values = pa.array(lines, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(range(n, n + len(lines)), pa.int64()), values], ["file", "n", "value"])


class ZstdSource(DataSource):
    """Options: path (a folder or file), pattern (of file names)."""

    @classmethod
    def name(cls) -> str:
        return "zstd_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZstdReader:
        return ZstdReader(self.options)


def zstd_lines(spark: SparkSession, path: str, pattern: str = "*.zst") -> DataFrame:
    """file, n (from 0), value of the lines of zstd texts under a path."""
    spark.dataSource.register(ZstdSource)
    return spark.read.format("zstd_lines").option("pattern", pattern).load(path)


def cpg_zst(spark: SparkSession, path: str) -> DataFrame:
    """Counts (sample_id, chrom, pos, methyl, unmethyl) of files ``<cell>[.<range>].cpg.tsv.zst``. A file without the exact header, or a line that is not a contig and three plain numbers, fails the job."""
    lines = zstd_lines(spark, path, "*.cpg.tsv.zst")
    cell = F.regexp_extract("file", r"([^/]*?)(?:\.\d{5})?\.cpg\.tsv\.zst$", 1)
    fine = F.when(F.col("n") == 0, F.col("value") == "chrom\tpos\tmethyl\tunmethyl").otherwise(F.col("value").rlike(r"^[^\t]+\t[0-9]{1,18}\t[0-9]{1,18}\t[0-9]{1,18}$"))
    text = F.when(fine, F.col("value")).otherwise(F.raise_error(F.concat("file", F.lit(": invalid line "), F.col("n").cast("string"))).cast("string"))
    part = F.split("text", "\t")
    rows = lines.select("n", cell.alias("sample_id"), text.alias("text")).where("n > 0 or text is null")
    return rows.select("sample_id", part[0].alias("chrom"), *[part[k + 1].cast("long").alias(c) for k, c in enumerate(("pos", "methyl", "unmethyl"))])
