"""Incremental processing: counts of new sequencing batches, an event log (log files themselves are followed by ``sources.logs``, and runs viewed by ``views``), and (beyond the reference's scope) windowed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", per_trigger: int = 1) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(kind).load(folder)


def cell_totals(cpg: DataFrame) -> DataFrame:
    """Sites and counts by cell and contig, for a batch or a stream."""
    return cpg.groupBy("sample_id", "chrom").agg(F.count("*").alias("rows"), F.sum("methyl").cast("long").alias("methyl"), F.sum("unmethyl").cast("long").alias("unmethyl"))


def run_into(df: DataFrame, path: str, checkpoint: str) -> None:
    """Appends what is there now to a Parquet folder, each batch in a partition of its own so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def totals_so_far(cpg: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Totals by cell and contig of a stream: each batch's partial totals are written in a partition of their own, the sums over them are the totals. No state grows with the keys."""

    def write(batch: DataFrame, number: int) -> None:
        cell_totals(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    cpg.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    parts = cpg.sparkSession.read.schema("sample_id string, chrom string, rows long, methyl long, unmethyl long, batch int").parquet(path)
    return parts.groupBy("sample_id", "chrom").agg(*[F.sum(c).alias(c) for c in ("rows", "methyl", "unmethyl")])


def states_so_far(lines: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Latest state and number of warnings by job of a stream of log lines: each batch's states are written in a partition of their own, the latest of them is the state."""

    def write(batch: DataFrame, number: int) -> None:
        found = log_events(batch).groupBy("job").agg(F.max(F.struct("at", "state")).alias("last"), F.count_if(F.col("state") == "warning").alias("warnings"))
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    parts = lines.sparkSession.read.schema("job string, last struct<at: string, state: string>, warnings long, batch int").parquet(path)
    return parts.groupBy("job").agg(F.max("last").alias("last"), F.sum("warnings").alias("warnings")).select("job", "last.state", "warnings")


def log_events(lines: DataFrame) -> DataFrame:
    """job, state of log lines such as ``[time] rule NAME: started``."""
    m = r"^\[([^\]]+)\] (?:rule|job) ([A-Za-z0-9_.-]+): ([a-z]+)"
    return lines.select(F.regexp_extract("value", m, 1).alias("at"), F.regexp_extract("value", m, 2).alias("job"), F.regexp_extract("value", m, 3).alias("state")).where("job <> ''")


def latest_states(events: DataFrame) -> DataFrame:
    """Latest state and number of warnings by job, for a batch or a stream."""
    return events.groupBy("job").agg(F.max_by("state", "at").alias("state"), F.count_if(F.col("state") == "warning").alias("warnings"))


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value sum by tumbling window and type, late ones within the watermark counted. Beyond the reference."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")
