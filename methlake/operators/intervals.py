"""Point-in-interval and related joins without nested loops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, intervals: DataFrame, pos: str = "pos0", width: int = 8192) -> DataFrame:
    """Every point with each half-open interval [start, stop) of its contig that holds it.

    An interval is listed in the bins it touches, a point has one bin: the join is an equi-join on (chrom, bin) with the
    bounds as the rest of its condition, so no pair is made twice. A point column set and the interval columns other than chrom come back.
    Empty intervals hold nothing. width should be near the usual length of an interval.
    """
    bins = F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width))
    listed = intervals.where("stop > start").withColumn("_bin", F.explode(bins))
    return points.withColumn("_bin", F.floor(F.col(pos) / width)).join(listed, ["chrom", "_bin"]).where((F.col(pos) >= F.col("start")) & (F.col(pos) < F.col("stop"))).drop("_bin")


def interval_counts(points: DataFrame, intervals: DataFrame, pos: str = "pos0", width: int = 8192) -> DataFrame:
    """chrom, start, stop, n: the pairs of interval_join by interval, counted without making them; an interval that is given twice counts twice, one that holds nothing has no row.

    n is the points before its stop less those before its start. Points before a place are those of the bins before, a prefix sum over one row a bin, and those before it in its own bin, where points
    and places are sorted together. Points of one place are one row.
    """
    from pyspark.sql import Window

    spans = intervals.where("stop > start").groupBy("chrom", "start", "stop").agg(F.count("*").alias("times"))
    at = points.groupBy("chrom", F.col(pos).cast("long").alias("at")).agg(F.count("*").alias("c"))
    ends = spans.select("chrom", F.explode(F.array(F.col("start").cast("long"), F.col("stop").cast("long"))).alias("at")).distinct()
    # at a place the end comes before the point, so that the point counts after it
    rows = at.select("chrom", "at", "c", F.lit(1).alias("kind")).unionByName(ends.select("chrom", "at", F.lit(0).cast("long").alias("c"), F.lit(0).alias("kind"))).withColumn("_bin", F.floor(F.col("at") / width))
    inside = Window.partitionBy("chrom", "_bin").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    bins = at.groupBy("chrom", F.floor(F.col("at") / width).alias("_bin")).agg(F.sum("c").alias("c"), F.lit(1).alias("kind"))
    places = rows.withColumn("own", F.sum("c").over(inside)).where("kind = 0").select("chrom", "at", "_bin", "own")
    every = bins.select("chrom", "_bin", "c").unionByName(places.select("chrom", "_bin", F.lit(0).cast("long").alias("c"))).groupBy("chrom", "_bin").agg(F.sum("c").alias("c"))
    before = Window.partitionBy("chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    every = every.select("chrom", "_bin", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    known = places.join(every, ["chrom", "_bin"]).select("chrom", "at", (F.col("own") + F.col("before")).alias("upto"))
    low, high = (known.select("chrom", F.col("at").alias(x), F.col("upto").alias(f"_{x}")) for x in ("start", "stop"))
    n = F.col("times") * (F.col("_stop") - F.col("_start"))
    return spans.join(low, ["chrom", "start"]).join(high, ["chrom", "stop"]).select("chrom", "start", "stop", n.alias("n")).where("n > 0")


def exact_id_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of two tables whose keys must be unique and the same; anything else fails when the result is computed."""
    counted = [d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((left, "_l"), (right, "_r"))]
    checked = counted[0].join(counted[1], key, "full_outer")
    good = (F.coalesce("_l", F.lit(0)) == 1) & (F.coalesce("_r", F.lit(0)) == 1) & F.col(key).isNotNull()
    proven = checked.select(key, F.assert_true(good, F.concat(F.lit("ids differ or repeat: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).alias("_ok"))
    return left.join(proven.where("_ok is null").drop("_ok"), key).join(right, key)


def violations_of_id_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key, left_rows, right_rows where an id is missing on a side or repeated."""
    a = left.groupBy(key).agg(F.count("*").alias("left_rows"))
    b = right.groupBy(key).agg(F.count("*").alias("right_rows"))
    return a.join(b, key, "full_outer").select(key, F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows")).where("left_rows <> 1 or right_rows <> 1")


def covered_positions_with_max_end(intervals: DataFrame, width: int = 1 << 20) -> DataFrame:
    """Intervals with the greatest stop among those that start no later on the contig.

    The maximum runs inside stretches of ``width`` bases; the greatest stop of the stretches before comes from one row for each.
    """
    from pyspark.sql import Window

    rows = intervals.withColumn("_bin", F.floor(F.col("start") / width))
    ends = rows.groupBy("chrom", "_bin").agg(F.max("stop").alias("_end"))
    before = Window.partitionBy("chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("chrom", "_bin", F.max("_end").over(before).alias("_before"))
    inside = Window.partitionBy("chrom", "_bin").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("_run", F.max("stop").over(inside)).join(ends, ["chrom", "_bin"])
    return run.withColumn("max_stop", F.greatest("_run", "_before")).drop("_run", "_before", "_bin")
