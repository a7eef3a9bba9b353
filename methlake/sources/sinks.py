"""Sinks. Tables are Parquet; deliveries are generations (see delivery)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from methlake.functions import numbers as N
from methlake.operators.cpg import canonical
from methlake.sources.delivery import folder, publish


def cpg_parquet(sites: DataFrame, path: str, shift: int = 0) -> None:
    """Counts by cell, sorted by place, zstd. Tasks take ranges of (cell, contig, place), so a large cell is several files in order and a task many small cells."""
    canonical(sites, shift).repartitionByRange("sample_id", "chrom", "pos").sortWithinPartitions("sample_id", "chrom", "pos").write.partitionBy("sample_id").option("compression", "zstd").parquet(path)


def cpg_text(sites: DataFrame, path: str, shift: int = 0) -> None:
    """Counts as one folder of TSV per cell, split as in cpg_parquet."""
    canonical(sites, shift).repartitionByRange("sample_id", "chrom", "pos").sortWithinPartitions("sample_id", "chrom", "pos").write.partitionBy("sample_id").options(sep="\t", header=True, compression="gzip").csv(path)


def cpg_zst(sites: DataFrame, path: str, shift: int = 0) -> DataFrame:
    """Counts as one checksummed zstd text ``<cell>.<range>.cpg.tsv.zst`` for each cell and range of (cell, contig, place) that has some of it; gives back the files written: sample_id, file, rows.

    A cell without a site has no file. A file gets its name when it is whole, and a task that runs again writes the same files.
    """
    import pyarrow as pa
    import zstandard
    from pyspark import TaskContext

    from methlake.sources.files import filesystem

    def run(batches):
        fs, root = filesystem(path)
        fs.create_dir(root, recursive=True)
        part, now, name, out, rows = TaskContext.get().partitionId(), None, None, None, 0

        def close():
            out.close()
            fs.move(f"{root}/_{name}.{attempt}", f"{root}/{name}")
            return pa.RecordBatch.from_pydict({"sample_id": [now], "file": [name], "rows": [rows]})

        attempt = uuid.uuid4().hex
        for batch in batches:
            table = pa.Table.from_batches([batch])
            cells = table.column(0).to_pylist()
            text = [f"{c}\t{p}\t{m}\t{u}\n" for c, p, m, u in zip(*(table.column(k).to_pylist() for k in range(1, 5)))]
            at = 0
            while at < len(cells):
                if cells[at] != now:
                    if out is not None:
                        yield close()
                    now, rows = cells[at], 0
                    name = f"{now}.{part:05d}.cpg.tsv.zst"
                    out = zstandard.ZstdCompressor(write_checksum=True).stream_writer(fs.open_output_stream(f"{root}/_{name}.{attempt}", compression=None), closefd=True)
                    out.write(b"chrom\tpos\tmethyl\tunmethyl\n")
                end = at
                while end < len(cells) and cells[end] == now:
                    end += 1
                out.write("".join(text[at:end]).encode())
                rows, at = rows + end - at, end
        if out is not None:
            yield close()

    ranged = canonical(sites, shift).select("sample_id", "chrom", "pos", "methyl", "unmethyl").repartitionByRange("sample_id", "chrom", "pos").sortWithinPartitions("sample_id", "chrom", "pos")
    files = ranged.mapInArrow(run, "sample_id string, file string, rows long")
    files.write.parquet(f"{path}/_files")
    return sites.sparkSession.read.parquet(f"{path}/_files")


def reads_by_cell(reads: DataFrame, path: str, key: str = "sample_id") -> None:
    """Reads as FASTQ text by cell; a large cell is several files in order."""
    record = F.concat(F.lit("@"), F.col("id"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    reads.repartitionByRange(key, "lane", "ordinal").sortWithinPartitions(key, "lane", "ordinal").select(key, record.alias("value")).write.partitionBy(key).option("compression", "gzip").text(path)


def matrix(means: DataFrame, obs: DataFrame, path: str, base: int = 1) -> None:
    """Interval means as a sparse matrix: obs, var (labelled intervals) and values, absent meaning not observed."""
    from methlake.functions.contigs import interval_label

    means.select("chrom", "start", "stop").distinct().withColumn("feature", interval_label("chrom", "start", "stop", base)).write.parquet(f"{path}/var")
    means.select("sample_id", interval_label("chrom", "start", "stop", base).alias("feature"), "mean_fraction").write.option("compression", "zstd").parquet(f"{path}/x")
    obs.write.parquet(f"{path}/obs")


def update_obs(obs: DataFrame, path: str) -> None:
    """New annotations; the values stay."""
    obs.write.mode("overwrite").parquet(f"{path}/obs")


def subset_matrix(spark: SparkSession, source: str, target: str, cells: DataFrame) -> None:
    for part in ("obs", "x"):
        spark.read.parquet(f"{source}/{part}").join(cells.select("sample_id").distinct(), "sample_id", "left_semi").write.parquet(f"{target}/{part}")
    spark.read.parquet(f"{source}/var").write.parquet(f"{target}/var")


def packed_counts(sites: DataFrame, path: str) -> None:
    sites.select("sample_id", "chrom", "pos", N.packed("methyl", "unmethyl").alias("packed")).write.parquet(path)


def one_file(rows: DataFrame, path: str, columns: list[str], kind: str = "csv") -> str:
    """A small table as one sorted file; columns that the table lacks fail, others are left out. The file is a generation of a delivery: gives back its folder, and a reader at the one before is not disturbed."""
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    out = rows.select(*columns).orderBy(*columns).coalesce(1).write
    out.options(sep="\t", header=True).csv(staged) if kind == "csv" else out.json(staged)
    return folder(path, publish(rows.sparkSession, staged, path))


def shard_seals(rows: DataFrame) -> DataFrame:
    """shard, rows, checksum (the exclusive or of the rows' hashes) of spooled rows."""
    columns = [c for c in rows.columns if c != "shard"]
    return rows.groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64(*columns)).alias("checksum"))


def write_spool(rows: DataFrame, path: str, key: str = "barcode", shards: int = 64) -> None:
    """rows in folders by shard (FNV-1a of the key), with a manifest of rows and checksum of each shard, written last. A shard may be many files, so a frequent key is no one task's work."""
    from methlake.functions.sequence import fnv1a_shard

    dealt = rows.withColumn("shard", fnv1a_shard(key, shards))
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(f"{path}/shards")
    shard_seals(rows.sparkSession.read.parquet(f"{path}/shards").select(*rows.columns, "shard")).write.json(f"{path}/manifest")


def append_batch(rows: DataFrame, path: str, batch: str) -> bool:
    """Adds a batch of rows as its own partition; a batch that is there already is left alone (False). A broken append leaves no partition."""
    spark = rows.sparkSession
    target = f"{path}/batch={batch}"
    fs, p = _fs(spark, target)
    if fs.exists(p):
        return False
    staged = f"{path}/_staged_{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    if not fs.rename(_fs(spark, staged)[1], p):
        raise OSError(f"could not publish {target}")
    return True


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p
