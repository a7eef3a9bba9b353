"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

A unit vector x is stored as x = s*q + e, with q in -127..127. For two vectors |x.y - (s q).(t r)| <= |e_x| + |s q| |e_y|, with norms measured, not
estimated; so a tile of integer products (kept exact in floating point) shows which pairs can reach the threshold, and only these are computed in
double precision.

Vectors with one label and the same numbers are one node. The nodes of a label are dealt by hash into blocks; a task compares two blocks and gives back, per
node, the number of vectors it is linked to, and the edges of a spanning forest of the tile, so what leaves a tile is linear in its
blocks however dense the links are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, tidy, written
from .components import components

THRESHOLD, BLOCK = 0.98, 1024
#: pairs that are recomputed together
SLICE = 4096


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    v = np.asarray(vectors, float)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q int8, scale, norm of s*q, norm of x - s*q) of unit rows; the norms are rounded up."""
    s = np.abs(x).max(1) / 127
    q = np.rint(x / s[:, None]).astype(np.int8)
    near = q * s[:, None]
    slack = 1 + 1e-9
    return q, s, np.sqrt((near * near).sum(1)) * slack, np.sqrt(((x - near) ** 2).sum(1)) * slack + 1e-12


def tile(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(i, j, pairs recomputed): the pairs of unit rows with x_i.y_j >= threshold."""
    q, s, norm, err = quantised(x)
    r, t, _, err_y = quantised(y)
    # int8 products summed in float32 are exact below 2**24, i.e. up to 1040 dimensions; wider vectors use double
    kind = np.float32 if x.shape[1] <= 1040 else np.float64
    about = (q.astype(kind) @ r.astype(kind).T) * s[:, None] * t[None, :]
    i, j = np.nonzero(about + err[:, None] + norm[:, None] * err_y[None, :] + 1e-6 >= threshold)
    # some pairs at a time: a tile of close vectors has a million of them
    exact = [np.einsum("ij,ij->i", x[i[k : k + SLICE]], y[j[k : k + SLICE]]) >= threshold for k in range(0, len(i), SLICE)]
    exact = np.concatenate(exact) if exact else np.zeros(0, bool)
    return i[exact], j[exact], len(i)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    parent = list(range(n))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    edges = []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            edges.append((a, b))
    return edges


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Two vectors are linked if their labels are equal and not null and their cosine, in double precision, is at least threshold. n_links counts the linked other rows;
    component_id is the least id that can be reached; kept means vec_id = component_id. Rows whose vector is null, empty, zero, or holds a null or a non-finite component, and rows with a null id
    or label, are linked with nothing. Vectors of different lengths are never linked. Repeated rows count as rows; other columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.cast("array<double>").alias("v"))
    plain = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & plain)
    # -0.0 and 0.0 are one number
    good = good.withColumn("v", F.transform("v", lambda x: x + 0.0)).withColumn("h", F.xxhash64("v"))
    nodes = good.groupBy("label", "h", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    nodes = written(nodes.withColumn("dim", F.size("v")), "vectors")
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = nodes.join(F.broadcast(sizes) if sizes.count() <= 50_000 else sizes, ["label", "dim"])
    # labels may be few and one may hold a third of all rows: the key is label and block
    blocks = dealt.groupBy("label", "dim", "blocks", F.pmod(F.hash("h"), "blocks").alias("b")).agg(F.collect_list(F.struct("node", "n", "v")).alias("m"))
    blocks = written(blocks.select("label", "dim", "blocks", "b", "m"), "blocks")
    # block b meets itself and the half of the ring after it: each pair of blocks once, every block as often
    reach = F.floor(F.col("blocks") / 2).cast("int")
    left = blocks.withColumn("step", F.explode(F.sequence(F.lit(0), reach))).where(~((F.col("step") * 2 == F.col("blocks")) & (F.col("b") * 2 >= F.col("blocks"))))
    left = left.select("label", "dim", F.col("b").alias("p"), F.pmod(F.col("b") + F.col("step"), "blocks").alias("b"), F.col("m").alias("x"))
    tiles = left.join(blocks.select("label", "dim", "b", F.col("m").alias("y")), ["label", "dim", "b"])
    tiles = tiles.select("x", F.when(F.col("p") != F.col("b"), F.col("y")).alias("y")).repartition(4 * partitions(spark), F.xxhash64("label", "dim", "p", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield _compared(_members(batch.column(0), k), _members(batch.column(1), k), threshold)

    out = written(tiles.mapInArrow(tidy(run), "node long, links long, other long"), "tiles")
    counts = out.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(out.where("other is not null"), "node", "other")
    linked = counts.join(classes, "node", "left")
    copies = good.select("vec_id", "label", "h", "v").join(nodes.select("label", "h", "v", "node", "n"), ["label", "h", "v"])
    found = copies.join(linked, "node", "left").select("vec_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    rest = rows.where(~F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & plain, F.lit(False)))
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _members(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(nodes, copies, unit vectors) of a block."""
    m = column[k].values
    if m is None:
        return None
    nodes, n, v = (m.field(x) for x in ("node", "n", "v"))
    return nodes.to_numpy(), n.to_numpy(), unit(v.flatten().to_numpy().reshape(len(nodes), -1))


def _compared(a: tuple, b: tuple | None, threshold: float) -> pa.RecordBatch:
    """Rows (node, links, null) and (node, 0, other) of one tile."""
    i, j, _ = tile(a[2], (b or a)[2], threshold)
    if b is None:
        i, j = i[i < j], j[i < j]
        nodes, n = a[0], a[1]
    else:
        j = j + len(a[0])
        nodes, n = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    links = np.bincount(i, n[j], len(nodes)) + np.bincount(j, n[i], len(nodes))
    own = np.flatnonzero(links)
    edges = _forest(i, j, len(nodes))
    columns = [
        np.concatenate([nodes[own], nodes[[e for e, _ in edges]]]) if edges else nodes[own],
        np.concatenate([links[own], np.zeros(len(edges))]).astype(np.int64),
    ]
    other = [None] * len(own) + nodes[[e for _, e in edges]].tolist() if edges else [None] * len(own)
    return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(other, pa.int64())], ["node", "links", "other"])


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> links and component of each vector."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
