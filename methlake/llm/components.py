"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Edges stay distributed. Every step is a minimum per node (pre-aggregated before its shuffle) joined
back to the edges. The minima are exchanged anew for the join, so that both its sides are plain exchanges: then adaptive execution splits
a node with very many edges, which it does not do beside an aggregate. The edges are written to the shared folder after each round, and those of the round before go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _star(edges: DataFrame) -> DataFrame:
    """(u, v) in both directions -> (v, least neighbour of u) for v > u."""
    return _joined(edges, edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))


def _joined(edges: DataFrame, least: DataFrame) -> DataFrame:
    # as a new column the key is not what the aggregate was dealt by
    return edges.join(least.withColumn("u", F.col("u").bitwiseOR(F.lit(0).cast("long"))), "u")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): each node of an edge with the smallest node that it is linked to over any path.

    edges: two bigint columns; null ends, loops and repeated edges are ignored. Nodes without an
    edge don't appear. No edges give no rows.
    """
    e = (
        edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    e = written(e, "edges", few=True)  # u < v
    state = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = large.where(F.col("x") != F.col("y")).distinct()
        # small star: every node and its smaller neighbours go to the least of them
        down = large.select(F.col("x").alias("u"), F.col("y").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = _joined(down, least).select(F.col("v").alias("x"), F.col("m").alias("y"))
        small = small.unionByName(least.select(F.col("u").alias("x"), F.col("m").alias("y")))
        e = small.where(F.col("x") != F.col("y")).select(F.col("y").alias("u"), F.col("x").alias("v")).distinct()
        before, e = e, written(e, "edges", few=True)
        discard(before)
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    least = e.groupBy("v").agg(F.min("u").alias("u"))
    roots = e.select(F.col("u").alias("node")).distinct()
    return least.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        roots.join(least.select(F.col("v").alias("node")), "node", "left_anti").select("node", F.col("node").alias("component"))
    )
