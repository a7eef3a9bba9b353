"""Views of logs that grow: totals, latest lines, latest events and counts of messages by run, kept from batch to batch.

A log arrives as chunks (run, chunk, text) in ascending order of chunk; its lines are placed by (chunk, line). All products are sums, minima or the last K of an order, so
those of one batch are merged with those before it, in any order of batches, and no group is ever collected: a run that holds most of all lines is
folded in each task before its rows meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: terminal colours and the like
ANSI = r"\x1b\[[0-9;?]*[ -/]*[@-~]"
PRODUCTS = "product string, shard int, run string, chunk long, line long, kind string, text string, n long, chars long"
_PLACE = ["chunk", "line"]


def log_lines(chunks: DataFrame) -> DataFrame:
    """run, chunk, line (from 0), text of the lines of chunks: cut at line feeds and carriage returns, without terminal codes and outer blanks; empty lines are left out, a null text has none."""
    parts = chunks.select("run", "chunk", F.posexplode(F.split("text", r"[\r\n]")).alias("line", "text"))
    return parts.select("run", "chunk", F.col("line").cast("long").alias("line"), F.btrim(F.regexp_replace("text", ANSI, ""), F.lit(" \t")).alias("text")).where("text <> ''")


def kind_of(text: Column, patterns: dict[str, str]) -> Column:
    """Name of the first pattern that a line matches, or null."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(patterns.items()):
        kind = F.when(text.rlike(pattern), name).otherwise(kind)
    return kind


def shard_of(run: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(shards)).cast("int")


def products(lines: DataFrame, patterns: dict[str, str], keep: int, shards: int) -> DataFrame:
    """The products (PRODUCTS) of lines: ``total`` (lines and characters), ``recent`` and ``event`` (the last keep lines, and lines of a kind), ``message`` (each line of a kind with its count and first place)."""
    rows = lines.select(
        shard_of(F.col("run"), shards).alias("shard"), "run", "chunk", "line", kind_of(F.col("text"), patterns).alias("kind"), "text", F.lit(1).cast("long").alias("n"), F.length("text").cast("long").alias("chars")
    )
    return _folded(rows, rows, rows.where("kind is not null"), rows.where("kind is not null"), keep)


def merged(old: DataFrame, new: DataFrame, keep: int) -> DataFrame:
    """The products of two sets of lines from the products of each."""
    both = old.unionByName(new)
    return _folded(*[both.where(F.col("product") == p).drop("product") for p in ("total", "recent", "event", "message")], keep)


def _folded(total: DataFrame, recent: DataFrame, event: DataFrame, message: DataFrame, keep: int) -> DataFrame:
    def last(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy("shard", "run").orderBy(F.desc_nulls_last("chunk"), F.desc("line"), F.desc("text"))
        return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep)

    def columns(rows: DataFrame, product: str) -> DataFrame:
        return rows.select(F.lit(product).alias("product"), *[F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in PRODUCTS.split(", ")[1:])])

    sums = [F.sum(c).cast("long").alias(c) for c in ("n", "chars")]
    counts = message.groupBy("shard", "run", "kind", "text").agg(F.min(F.struct(*_PLACE)).alias("p"), *sums).select("*", "p.*")
    found = columns(total.groupBy("shard", "run").agg(*sums), "total")
    for part in (columns(last(recent), "recent"), columns(last(event), "event"), columns(counts, "message")):
        found = found.unionByName(part)
    return found
