"""Whitening of embeddings by the principal components of exactly centred integer vectors.

An entry c becomes the integer floor(64 c) + 1000000. Sums over the different integer vectors are exact, and a row is centred in two exact steps (the
nearest integer mean, then the rest of it as one rounded fraction), so no offset costs precision. MLlib's RowMatrix gives the Gram matrix of
the centred rows; divided by their number it is the covariance, whose eigenvectors (a matrix of dimensions squared, the only thing on the driver beside the sums)
are broadcast and applied in Arrow batches of pandas.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: entries from here on are no embedding's: their integers would not be exact in double precision
LIMIT = 2.0**33
#: an eigenvalue below this share of the greatest is numerically zero and no component
LEAST = 1e-10


@dataclass
class Whitening:
    """n vectors with per-dimension sums; mean = near + rest / n with integer near and rest; basis has a unit eigenvector in each column."""

    n: int
    sums: np.ndarray
    near: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    basis: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist() if self.trace else []


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x (array of long) of the usable rows: a vector that is not null nor empty, without null, non-finite or huge (LIMIT) entries."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & sound)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))


def _gram(rows: DataFrame, array: str, n: int, dims: int) -> np.ndarray:
    """Gram matrix of an array column of doubles, by MLlib in the JVM: partial sums in a tree, dims squared to the driver."""
    v = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(array).alias("v")), "v")
    return RowMatrix(v, n, dims).computeGramianMatrix().toArray()


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the different vectors x of rows, each counted once; None without rows.

    Of vectors of several lengths those of the most frequent length (then the longer) count. There are as many components as the covariance has eigenvalues above LEAST of the greatest, at most the given number.
    """
    length = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return None
    dims = length["d"]
    once = written(rows.where(F.size("x") == dims).select("x").distinct(), "vectors")
    sums = np.zeros(dims, np.int64)
    n = 0
    for r in once.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s"), F.count("*").alias("n")).collect():
        sums[r["i"]], n = r["s"], r["n"]
    near = (2 * sums + n) // (2 * n)
    rest = sums - n * near
    at, part = F.lit(near.tolist()), F.lit((rest / n).tolist())
    centred = once.select(F.transform("x", lambda c, i: (c - F.get(at, i)).cast("double") - F.get(part, i)).alias("y"))
    covariance = _gram(centred, "y", n, dims) / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > LEAST * max(values.max(), 0.0)]
    basis = vectors[:, order]
    # either sign is right: the greatest entry is positive
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
    model = Whitening(n, sums, near, rest, values[order], basis, float(np.trace(covariance)))
    if len(order):
        k = len(order)
        # a last entry of 1 gives the sums, so that the measured covariance is centred too
        white = transform(once.select(F.lit(None).cast("string").alias("vec_id"), "x"), model).select(F.concat("whitened", F.array(F.lit(1.0))).alias("y"))
        g = _gram(white, "y", n, k + 1)
        mean = g[k, :k] / n
        model.identity_error = float(np.abs(g[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return model


def _deviations(z: np.ndarray, n: int, rest: np.ndarray) -> list:
    """Sum over dimensions of (n z - rest)^2 of each row, exact; None where it is no 64-bit integer."""
    greatest = n * (int(np.abs(z).max(initial=0)) + 1)
    if greatest * greatest * z.shape[1] < 2**63:
        d = n * z - rest
        return (d * d).sum(1).tolist()
    d = n * z.astype(object) - rest.astype(object)
    return [x if x < 2**63 else None for x in (d * d).sum(1).tolist()]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, whitened (array of double) of rows (vec_id, x) of the model's length.

    deviation is the sum over dimensions of (n x - S)^2, null beyond 64 bits. The basis is a broadcast of dimensions times components numbers.
    """
    sent = rows.sparkSession.sparkContext.broadcast((model.n, model.near, model.rest, model.basis / np.sqrt(model.values)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, near, rest, basis = sent.value
        for batch in batches:
            if len(batch):
                z = np.stack(batch["x"].to_numpy()).astype(np.int64) - near
                white = (z - rest / n) @ basis
                yield pd.DataFrame({"vec_id": batch["vec_id"], "deviation": pd.Series(_deviations(z, n, rest), dtype="object"), "whitened": list(white)})

    # ids pass as text: pandas would turn a column with a null into doubles
    kind = rows.schema["vec_id"].dataType
    some = rows.where(F.size("x") == model.dims).select(F.col("vec_id").cast("string").alias("vec_id"), "x")
    return some.mapInPandas(run, "vec_id string, deviation long, whitened array<double>").withColumn("vec_id", F.col("vec_id").cast(kind))


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every usable row and component.

    Rows whose vector is null or empty, or has a null, non-finite or huge entry (2**33 or more), have no result, nor have vectors of another length than the most frequent one. Repeated rows, and
    different vectors with the same integers, count once in the fit and have a result each; null ids stay null. Constant dimensions are fine: a component without variance is left out, so
    a table with fewer than two different vectors, or none, gives no rows. Other columns are not read.
    """
    rows = integers(vectors, id_col, vector_col)
    model = fit(rows, components)
    if model is None or not len(model.values):
        return rows.where("false").selectExpr("vec_id", "cast(1 as int) component", "cast(0 as long) n", "cast(0 as long) deviation", "cast(0 as double) whitened", "cast(0 as double) explained", "cast(0 as double) identity_error")
    share = F.lit(model.explained)
    out = transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return out.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("k")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> up to 16 whitened components of each vector."""
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
