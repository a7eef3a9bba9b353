"""Group statistics of QC tables: robust fits, histograms, smoothing, correlation, principal components."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methlake.functions.numbers import signed_exp, signed_log


def finite(rows: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        rows = rows.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) != float("inf")))
    return rows


def chromosome_medians(stats: DataFrame, clones: DataFrame) -> DataFrame:
    """Median sites, median mean fraction and cells with a fraction, by clone and contig."""
    return stats.join(clones.select("sample_id", "clone_id"), "sample_id").groupBy("clone_id", "chrom").agg(F.median("sites").cast("double").alias("median_sites"), F.median("mean_fraction").alias("median_fraction"), F.count("mean_fraction").alias("cells"))


def mad_inliers(rows: DataFrame, group: str, value: str, limit: float = 3.5, least: int = 6) -> DataFrame:
    """rows with ``inlier``: modified z-score by the median absolute deviation within limit. Groups under ``least`` keep all; without deviation only values at the median."""
    med = rows.groupBy(group).agg(F.median(value).alias("_med"), F.count(value).alias("_n"))
    d = rows.join(med, group).withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    mad = d.groupBy(group).agg(F.median("_dev").alias("_mad"))
    d = d.join(mad, group)
    near = F.abs(F.col(value) - F.col("_med")) <= 1e-12 + 1e-9 * F.abs(F.col("_med"))
    z = F.when(F.col("_mad") < 1e-12, near).otherwise(0.6745 * F.col("_dev") / F.nullif(F.col("_mad"), F.lit(0.0)) <= limit)
    return d.withColumn("inlier", F.when(F.col("_n") < least, F.col(value).isNotNull()).otherwise(F.coalesce(z, F.lit(False)))).drop("_med", "_n", "_dev", "_mad")


def slope_pairs(rows: DataFrame, group: str, x: str, unique: str, signal: str, limit: float = 3.5, least: int = 6, change: float = 0.05) -> DataFrame:
    """Slopes through the origin of two values over x by group, without confirmed outliers.

    With ``least`` points or more a point is dropped if the log ratio of its two values is an outlier and leaving it out moves the ratio of the slopes by
    ``change`` or more to an outlying value. Groups with fewer than two points, before, have null slopes; if fewer than two would stay, all stay.
    """
    p = rows.where(f"{x} > 0 and {unique} > 0 and {signal} > 0").select(group, F.col(x).cast("double").alias("x"), F.col(unique).cast("double").alias("u"), F.col(signal).cast("double").alias("s"), F.monotonically_increasing_id().alias("_k"))
    t = p.groupBy(group).agg(F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("x") * F.col("u")).alias("xu"), F.sum(F.col("x") * F.col("s")).alias("xs"), F.count("*").alias("n"))
    j = p.join(t, group)
    left = F.try_divide(F.col("xu") - F.col("x") * F.col("u"), F.col("xs") - F.col("x") * F.col("s"))
    j = j.withColumn("point", F.log(F.col("u") / F.col("s"))).withColumn("loo", left)
    j = j.withColumn("log_loo", F.log("loo")).withColumn("moved", F.abs(F.col("loo") / (F.col("xu") / F.col("xs")) - 1) >= change)
    j = mad_inliers(j, group, "point", limit, least).withColumnRenamed("inlier", "point_in")
    j = mad_inliers(j, group, "log_loo", limit, least).withColumnRenamed("inlier", "loo_in")
    drop = (F.col("n") >= least) & ~F.col("point_in") & ~F.col("loo_in") & F.coalesce("moved", F.lit(False))
    j = j.withColumn("keep", ~drop)
    kept = j.groupBy(group).agg(F.count_if("keep").alias("kept"))
    j = j.join(kept, group).withColumn("use", F.col("keep") | (F.col("kept") < 2))
    own = lambda c: F.sum(F.when(F.col("use"), c))
    sums = j.groupBy(group).agg(own(F.col("x") * F.col("u")).alias("xu"), own(F.col("x") * F.col("s")).alias("xs"), own(F.col("x") * F.col("x")).alias("xx"), F.count("*").alias("n"), F.count_if("use").alias("used"))
    enough = F.col("n") >= 2
    return sums.select(group, F.when(enough, F.col("xu") / F.col("xx")).alias("slope_unique"), F.when(enough, F.col("xs") / F.col("xx")).alias("slope_signal"), "n", "used")


def histogram(rows: DataFrame, value: str, group: str, scale: str = "linear", bins: int = 100) -> DataFrame:
    """group, bin, n: equal bins of the value (linear, log10 or signed log1p scale) over all groups' range; the last bin is closed. Empty bins have no row."""
    v = {"linear": F.col(value).cast("double"), "log": F.log10(value), "log1p": signed_log(value)}[scale]
    t = finite(rows.where(F.col(value).isNotNull()), value).select(group, v.alias("v"))
    edge = t.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    b = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))).otherwise(F.lit(bins // 2))
    return t.crossJoin(F.broadcast(edge)).groupBy(group, b.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def bin_edges(rows: DataFrame, value: str, scale: str = "linear", bins: int = 100) -> DataFrame:
    """edge (0..bins) and its value in the value's own unit."""
    v = {"linear": F.col(value).cast("double"), "log": F.log10(value), "log1p": signed_log(value)}[scale]
    r = rows.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).withColumn("edge", F.explode(F.sequence(F.lit(0), F.lit(bins))))
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("edge") / bins
    back = {"linear": x, "log": F.pow(F.lit(10.0), x), "log1p": signed_exp(x)}[scale]
    return r.select("edge", back.alias("value"))


def gaussian_smooth(counts: DataFrame, group: str, bins: int = 100, sigma: float = 1.5, reach: int = 6) -> DataFrame:
    """group, bin, smooth: counts of all bins smoothed by a normalised Gaussian, mirrored at both ends (the edge bin is repeated)."""
    weight = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)]
    kernel = F.array(*[F.lit(w / sum(weight)) for w in weight])
    moved = counts.withColumn("d", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("w", F.element_at(kernel, F.col("d") + reach + 1))
    # a count reaches the bins around it, and once more those whose mirrored window holds it
    direct = moved.select(group, (F.col("bin") + F.col("d")).alias("to"), "n", "w")
    low = moved.select(group, (-F.col("bin") - 1 + F.col("d")).alias("to"), "n", "w")
    high = moved.select(group, (2 * bins - 1 - F.col("bin") + F.col("d")).alias("to"), "n", "w")
    every = direct.unionByName(low).unionByName(high).where((F.col("to") >= 0) & (F.col("to") < bins))
    return every.groupBy(group, F.col("to").cast("int").alias("bin")).agg(F.sum(F.col("n") * F.col("w")).alias("smooth"))


def pearson(values: DataFrame, least: int = 2, rows: int | None = None, columns: int = 1024) -> DataFrame:
    """a, b, n, r of every pair of samples over the contigs both have (sample_id, chrom, value); null under ``least`` or without variance.

    By Gram matrices: samples are dealt into blocks of ``rows`` (None: by their number, and 2**18 values at most) and contigs (or any features) into chunks of ``columns``; a block goes to the tiles of all
    pairs of blocks that it is in, and a task adds up a tile's products of values, squares and presence chunk by chunk. Pairs of samples leave the tasks whole, named and with their r: none is exchanged or joined, and
    no join has a contig for its key.

    Values are centred by their sample's mean first, so that sums don't cancel. A variance under 1e-12 of the mean square is none.
    """
    import numpy as np
    import pyarrow as pa

    from methlake.operators.manifest import _cut, numbered

    # read once: a value a sample and contig, whatever they were made from
    v = _cut(values.where("value is not null").select("sample_id", "chrom", F.col("value").cast("double").alias("value")))
    means = v.groupBy("sample_id").agg(F.avg("value").alias("mean"))
    samples = numbered(means, "sample_id", name="s")
    features = numbered(v.select("chrom").distinct(), "chrom", name="f")
    count, wide = samples.count(), features.count()
    if rows is None:
        # some 300 tiles: a block is sent to as many tiles as there are blocks
        rows = max(256, min(-(-count // 24), (1 << 18) // max(1, min(wide, columns))))
    placed = v.join(samples, "sample_id").join(features, "chrom").select("s", "f", (F.col("value") - F.col("mean")).alias("x"))
    cell = F.struct((F.col("s") % rows).cast("int").alias("s"), (F.col("f") % columns).cast("int").alias("f"), "x")
    # rows * columns entries at most
    blocks = placed.groupBy(F.floor(F.col("s") / rows).alias("k"), F.floor(F.col("f") / columns).alias("c")).agg(F.collect_list(cell).alias("m"))
    names = samples.groupBy(F.floor(F.col("s") / rows).alias("k")).agg(F.array_sort(F.collect_list(F.struct("s", "sample_id"))).alias("m")).select("k", F.col("m.sample_id").alias("names"))
    last = max(0, -(-count // rows) - 1)
    other = F.explode(F.sequence(F.lit(0), F.lit(last)).cast("array<long>")).alias("o")
    sent = blocks.join(names, "k").select("k", "c", "names", F.col("m.s").alias("s"), F.col("m.f").alias("f"), F.col("m.x").alias("x"), other)
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = sent.select(F.least("k", "o").alias("p"), F.greatest("k", "o").alias("q"), "c", "k", "names", "s", "f", "x").repartition(n, "p", "q").sortWithinPartitions("p", "q", "c", "k")

    def dense(r):
        s, f, x = (r[c].values.to_numpy() for c in "sfx")
        full, there = np.zeros((len(r["names"]), min(wide, columns))), np.zeros((len(r["names"]), min(wide, columns)))
        full[s, f], there[s, f] = x, 1.0
        return full, there

    def products(x, a, y, b):
        return np.stack([a @ b.T, x @ b.T, a @ y.T, (x * x) @ b.T, a @ (y * y).T, x @ y.T])

    def pairs(sums, low, left, right, same):
        """The pairs of a strip of a tile whose first row is the left block's row low."""
        there = sums[0] > 0
        i, j = np.nonzero(np.triu(there, low) if same else there)
        n, x, y, xx, yy, xy = sums[:, i, j]
        with np.errstate(divide="ignore", invalid="ignore"):
            vx, vy = xx - x * x / n, yy - y * y / n
            r = (xy - x * y / n) / np.sqrt(vx * vy)
        fine = (n >= least) & (vx > 1e-12 * xx) & (vy > 1e-12 * yy)
        return pa.RecordBatch.from_arrays([left.take(pa.array(i + low)), right.take(pa.array(j)), pa.array(n.astype(np.int64)), pa.array(r, mask=~fine)], ["a", "b", "n", "r"])

    def run(batches):
        half, whole, tile = None, None, None

        def finish():
            if whole is not None:
                yield pairs(whole[0], 0, *whole[1:])

        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k] for c in batch.schema.names}
                p, q, c, own = (r[c].as_py() for c in "pqck")
                if (p, q) != tile:
                    yield from finish()
                    tile, whole = (p, q), None
                if own == p:
                    half = (c, p, r["names"].values, dense(r))
                    if p < q:
                        continue
                if half is None or half[:2] != (c, p):
                    continue
                (x, a), (y, b) = half[3], half[3] if p == q else dense(r)
                left, right = half[2], r["names"].values
                if wide > columns:
                    sums = products(x, a, y, b)
                    whole = (sums if whole is None else whole[0] + sums, left, right, p == q)
                else:
                    step = max(1, (1 << 18) // len(y))
                    for low in range(0, len(x), step):
                        yield pairs(products(x[low : low + step], a[low : low + step], y, b), low, left, right, p == q)
        yield from finish()

    return tiles.mapInArrow(run, "a string, b string, n long, r double")


def principal_components(rows: DataFrame, columns: list[str], key: str = "sample_id") -> DataFrame:
    """key, pc1, pc2 of complete rows, columns standardised by their population deviation. The covariance is one aggregate; its few numbers are decomposed on the driver."""
    import numpy as np

    full = finite(rows, *columns)
    d = full.agg(F.count("*"), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns], *[F.covar_pop(a, b) for a in columns for b in columns]).first()
    k = len(columns)
    if not d or d[0] < 2:
        return full.select(key, F.lit(None).cast("double").alias("pc1"), F.lit(None).cast("double").alias("pc2"))
    mean, std = np.array(d[1 : k + 1]), np.array(d[k + 1 : 2 * k + 1])
    std = np.where(std > 0, std, 1.0)
    cov = np.array(d[2 * k + 1 :]).reshape(k, k) / np.outer(std, std)
    value, vector = np.linalg.eigh(cov)
    top = vector[:, np.argsort(-value)[:2]]
    top = top * np.where(top[np.abs(top).argmax(0), range(top.shape[1])] < 0, -1, 1)
    z = [(F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(columns, mean, std)]
    return full.select(key, *[sum(x * F.lit(float(w)) for x, w in zip(z, top[:, p])).alias(f"pc{p + 1}") for p in range(top.shape[1])])


def column_medians(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*[F.median(c).cast("double").alias(c) for c in columns])


def plate_map(rows: DataFrame, value: str) -> DataFrame:
    """sample_id, row (0-7), col (0-11), value of rows with a valid well, with the least and greatest value of all."""
    good = rows.where(F.col("plate_id").rlike("^[A-H](?:[1-9]|1[0-2])$"))
    out = good.select("sample_id", (F.ascii("plate_id") - 65).alias("row"), (F.substring("plate_id", 2, 2).cast("int") - 1).alias("col"), F.col(value).alias("value"))
    edge = good.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return out.crossJoin(F.broadcast(edge))
