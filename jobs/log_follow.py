"""Incremental job: follows logs that arrive as new files and keeps a view of each run.

Each file holds chunks of logs (run, chunk, text by the configuration's ``columns``). Per run the job keeps its number of lines and characters, its last ``keep`` lines, the last lines that
match one of ``patterns`` (what must not be in a log that is delivered, or what a reader looks for), and each such message with its count and first
place. The file stream's checkpoint is the high-water mark: a run of the job takes only files that no run before took. A chunk that comes again in another file counts again.

The views are Parquet folders ``views/batch=../product=../shard=..``. A batch writes the shards that it touches, made from what the batches before it left and from its new lines, into a
folder of its own; then a row in ``marks`` says that it is whole. The view of a shard is that of its last marked batch. So no folder that counts is ever written over: a batch that breaks off
anywhere leaves the views as they were, and when the stream repeats it, it makes the same folder again. Every ``history`` batches all shards are written, and what the
snapshot before that one made superfluous is emptied. A checkpoint and its output belong together: output of another checkpoint is refused.

    python -m jobs.log_follow --input /data/documents --output /data/views --checkpoint /data/views-checkpoint [--config my.json]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import counted, load, log, session
from methlake.streaming.follow import PRODUCTS, log_lines, merged, products, shard_of

NAME = "log_follow"
STORED = f"{PRODUCTS}, batch long"
MARKS = "snapshot boolean, stream string, batch long"


def marks(spark: SparkSession, target: str) -> list:
    """(batch, snapshot, stream) of the whole batches; there are twice ``history`` of them at most, and those of the batches since."""
    return sorted((r["batch"], r["snapshot"], r["stream"]) for r in spark.read.schema(MARKS).parquet(f"{target}/marks").collect())


def latest(spark: SparkSession, target: str, batches: list[int]) -> DataFrame:
    """The rows of each shard from the last of some batches that has it."""
    rows = spark.read.schema(STORED).parquet(f"{target}/views").where(F.col("batch").isin(batches))
    # one row for each shard and batch
    newest: dict[int, int] = {}
    for r in rows.select("shard", "batch").distinct().collect():
        newest[r["shard"]] = max(r["batch"], newest.get(r["shard"], -1))
    own = F.lit(False)
    for batch in set(newest.values()):
        own = own | ((F.col("batch") == batch) & F.col("shard").isin([k for k, b in newest.items() if b == batch]))
    return rows.where(own)


def take(chunks: DataFrame, number: int, target: str, config: dict) -> None:
    """Makes one batch's folder from the views before it and its chunks."""
    spark = chunks.sparkSession
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    shards, keep = config["shards"], config["keep"]
    known = marks(spark, target)
    if any(m[2] != stream for m in known):
        raise ValueError(f"{target} was written with another checkpoint")
    before = [m for m in known if m[0] < number]
    # one row for each shard at most
    touched = [r[0] for r in chunks.select(shard_of(F.col("run"), shards)).distinct().collect()]
    chunks, seen = counted(chunks, f"read {number}")
    state = latest(spark, target, [m[0] for m in before]).drop("batch")
    rows = merged(state.where(F.col("shard").isin(touched)), products(log_lines(chunks), config["patterns"], keep, shards), keep)
    snapshot = number % config["history"] == 0
    if snapshot:
        rows = rows.unionByName(state.where(~F.col("shard").isin(touched)))
    rows, made = counted(rows, f"written {number}")
    # ranges, so that a shard with a very large run is several files
    order = ["product", "shard", "run", "chunk", "line", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.partitionBy("product", "shard").option("partitionOverwriteMode", "static").mode("overwrite").parquet(f"{target}/views/batch={number}")
    spark.createDataFrame([(snapshot, stream)], "snapshot boolean, stream string").coalesce(1).write.mode("overwrite").parquet(f"{target}/marks/batch={number}")
    log.info("%s: batch %d, wrote %d rows of %d shards to %s", NAME, number, made.get["rows"], len(touched), target)
    # the last but one snapshot holds all that batches before it made: a reader may still be at those after it
    for old in [m[0] for m in before if m[0] < ([0, 0] + [x[0] for x in before if x[1]])[-2]]:
        spark.createDataFrame([], "snapshot boolean, stream string").write.mode("overwrite").parquet(f"{target}/marks/batch={old}")
        spark.createDataFrame([], PRODUCTS).write.partitionBy("product", "shard").option("partitionOverwriteMode", "static").mode("overwrite").parquet(f"{target}/views/batch={old}")


def watched(source: str) -> str:
    """source as a pattern of its own name: the file stream takes a folder by its path, but a single file only by a pattern."""
    folder, slash, name = source.rstrip("/").rpartition("/")
    return source if any(c in name for c in "*?[]{}") else f"{folder}{slash}{{{name}}}"


def run(spark: SparkSession, source: str, target: str, checkpoint: str, config: dict) -> DataFrame:
    """The job on a session: takes all files that are new, waits for the stream to end, and gives back the whole views."""
    # no rows: the folders are there before the first batch
    spark.createDataFrame([], STORED).write.partitionBy("batch", "product", "shard").mode("append").parquet(f"{target}/views")
    spark.createDataFrame([], MARKS).write.partitionBy("batch").mode("append").parquet(f"{target}/marks")
    files = spark.readStream.schema(config["schema"]).format(config["format"]).option("maxFilesPerTrigger", config["files_per_batch"]).load(watched(source))
    chunks = files.selectExpr(*[f"{config['columns'][c]} {c}" for c in ("run", "chunk", "text")])
    stream = chunks.writeStream.foreachBatch(lambda batch, number: take(batch, number, target, config)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    log.info("%s: read %s, %d batches with new files, checkpoint %s", NAME, source, sum(p["numInputRows"] > 0 for p in stream.recentProgress), checkpoint)
    return read(spark, target)


def read(spark: SparkSession, target: str) -> DataFrame:
    """The views of all shards."""
    return latest(spark, target, [m[0] for m in marks(spark, target)]).select(*[f.split()[0] for f in PRODUCTS.split(", ")])


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{NAME}", description="Views of growing logs")
    for name in ("input", "output", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config", help="JSON file; keys that it lacks are taken from the job's own one")
    args = parser.parse_args(argv)
    config, spark = load(args.config, NAME), session(NAME)
    try:
        run(spark, args.input, args.output, args.checkpoint, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
