"""Statistics of per-site CpG counts (sample_id, chrom, pos, methyl, unmethyl).

Rates of sites are means of the sites' fractions; rates of signals pool counts. A rate without a site is null, a share of nothing is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from methlake.functions.contigs import contig_class, is_autosome, is_host

BIN, WINDOW = 500_000, 1_000_000
CLASSES = ("host", "lambda", "pUC19", "mt")


def canonical(sites: DataFrame, shift: int = 0) -> DataFrame:
    """Sites with coverage, moved by shift, one row each."""
    return sites.where("methyl + unmethyl > 0").withColumn("pos", F.col("pos") + shift)


def fraction() -> Column:
    return F.col("methyl") / (F.col("methyl") + F.col("unmethyl"))


def coverage() -> Column:
    return F.col("methyl") + F.col("unmethyl")


def cpg_summary(cpg: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Per cell: sites, signals and mean site rate of each contig class, and of all contigs; one conditional aggregate over one scan."""
    kind = contig_class("chrom")
    one = cpg.withColumn("kind", kind)
    columns = [c for k in CLASSES for c in (
        F.count_if(F.col("kind") == k).alias(f"{k.lower()}_sites"),
        F.coalesce(F.sum(F.when(F.col("kind") == k, coverage())), F.lit(0)).cast("long").alias(f"{k.lower()}_signals"),
        (F.avg(F.when(F.col("kind") == k, fraction())) * 100).alias(f"{k.lower()}_rate_pct"),
    )]
    out = one.groupBy("sample_id").agg(F.count("*").alias("total_sites"), F.sum(coverage()).cast("long").alias("total_signals"), *columns)
    if cells is None:
        return out
    out = cells.select("sample_id").distinct().join(out, "sample_id", "left")
    return out.fillna(0, [c for c in out.columns if c.endswith(("_sites", "_signals"))])


def composition(summary: DataFrame) -> DataFrame:
    """Share of each class in all signals, in percent."""
    return summary.select("sample_id", "total_signals", *[F.coalesce(F.try_divide(100.0 * F.col(f"{k.lower()}_signals"), F.col("total_signals")), F.lit(0.0)).alias(f"signal_{k.lower()}_pct") for k in CLASSES])


def chromosome_stats(cpg: DataFrame, cells: DataFrame, contigs: DataFrame) -> DataFrame:
    """Per cell and contig: sites, sums and mean rate; zero rows for host, control and mitochondrial contigs, none for auxiliary ones without a site."""
    seen = cpg.groupBy("sample_id", "chrom").agg(F.count("*").alias("sites"), F.sum("methyl").cast("long").alias("methyl"), F.sum("unmethyl").cast("long").alias("unmethyl"), F.avg(fraction()).alias("mean_fraction"))
    return _all_contigs(seen, cells, contigs)


def _all_contigs(seen: DataFrame, cells: DataFrame, contigs: DataFrame) -> DataFrame:
    grid = cells.select("sample_id").distinct().crossJoin(F.broadcast(contigs.select("chrom", contig_class("chrom").alias("kind"))))
    out = grid.join(seen, ["sample_id", "chrom"], "left").where("sites is not null or kind <> 'auxiliary'")
    return out.select("sample_id", "chrom", "kind", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("sites", "methyl", "unmethyl")], "mean_fraction")


def coverage_bins(cpg: DataFrame, width: int = BIN, base: int = 1) -> DataFrame:
    """Coverage of each observed bin of host contigs."""
    return cpg.where(is_host("chrom")).groupBy("sample_id", "chrom", F.floor((F.col("pos") - base) / width).alias("bin")).agg(F.sum(coverage()).cast("long").alias("cov"))


def gini(bins: DataFrame) -> DataFrame:
    """Gini index of a cell's observed bins. Ranks are by (coverage, contig, bin); the window is one cell's bins, which the genome bounds."""
    w = Window.partitionBy("sample_id").orderBy("cov", "chrom", "bin")
    ranked = bins.withColumn("i", F.row_number().over(w))
    sums = ranked.groupBy("sample_id").agg(F.count("*").alias("n"), F.sum("cov").alias("total"), F.sum(F.col("i") * F.col("cov")).alias("weighted"))
    # (n + 1 - 2 * sum((n - i + 1) x_i) / total) / n
    return sums.select("sample_id", F.when(F.col("total") > 0, (F.col("n") + 1 - 2.0 * ((F.col("n") + 1) * F.col("total") - F.col("weighted")) / F.col("total")) / F.col("n")).alias("gini"))


def windows_1mb(cpg: DataFrame, cells: DataFrame, contigs: DataFrame, width: int = WINDOW, base: int = 1) -> DataFrame:
    """Methylated and total counts of every autosomal window of every cell, zeros included."""
    seen = cpg.where(is_autosome("chrom")).groupBy("sample_id", "chrom", F.floor((F.col("pos") - base) / width).alias("win")).agg(F.sum("methyl").cast("long").alias("mc"), F.sum(coverage()).cast("long").alias("cov"))
    return _all_windows(seen, cells, contigs, width)


def _all_windows(seen: DataFrame, cells: DataFrame, contigs: DataFrame, width: int) -> DataFrame:
    grid = contigs.where(is_autosome("chrom")).select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("len") - 1) / width))).alias("win"))
    grid = cells.select("sample_id").distinct().crossJoin(F.broadcast(grid))
    return grid.join(seen, ["sample_id", "chrom", "win"], "left").fillna(0, ["mc", "cov"])


def interval_sums(cpg: DataFrame, intervals: DataFrame, base: int = 1, width: int = 32768) -> DataFrame:
    """sample_id, chrom, start, stop, sites, methyl, unmethyl, fractions of each cell and interval of host contigs with a site. Overlapping intervals are independent."""
    return met(interval_rows(cpg, intervals, base, width))


def interval_rows(cpg: DataFrame, intervals: DataFrame, base: int = 1, width: int = 32768, keep: str | None = None) -> DataFrame:
    """Intervals and sites by tile, from which ``met`` makes the sums: an interval is a row (p, q its bounds) of the tile of ``width`` bases where it starts, a site a row of each tile whose intervals may hold it.

    The rows grow with sites and intervals, not with their pairs. A column of the intervals that is to be kept comes along as ``kept``.
    """
    spans = intervals.where(is_host("chrom") & (F.col("stop") > F.col("start"))).select("chrom", F.col("start").cast("long").alias("p"), F.col("stop").cast("long").alias("q"), *([F.col(keep).alias("kept")] if keep else [])).distinct()
    spans = spans.withColumn("tile", F.floor(F.col("p") / width))
    ends = spans.groupBy("chrom", "tile").agg(F.max("q").alias("end"))
    reach = ends.select("chrom", F.struct("tile", "end").alias("tile"), F.explode(F.sequence("tile", F.floor((F.col("end") - 1) / width))).alias("bin")).groupBy("chrom", "bin").agg(F.collect_list("tile").alias("tiles"))
    points = cpg.where(is_host("chrom")).select("sample_id", "chrom", (F.col("pos") - base).cast("long").alias("p"), F.col("methyl").cast("long").alias("m"), F.col("unmethyl").cast("long").alias("u"))
    points = points.withColumn("bin", F.floor(F.col("p") / width)).join(reach, ["chrom", "bin"]).withColumn("t", F.explode("tiles")).where("t.tile = bin or p < t.end").withColumn("tile", F.col("t.tile"))
    sites = points.select("chrom", "tile", F.lit(True).alias("site"), "sample_id", "p", F.lit(None).cast("long").alias("q"), "m", "u", *([F.lit(None).cast(spans.schema["kept"].dataType).alias("kept")] if keep else []))
    none = F.lit(None).cast("long")
    return spans.select("chrom", "tile", F.lit(False).alias("site"), F.lit(None).cast("string").alias("sample_id"), "p", "q", none.alias("m"), none.alias("u"), *(["kept"] if keep else [])).unionByName(sites)


def met(rows: DataFrame) -> DataFrame:
    """The sums of interval_sums from interval_rows."""
    return lists_met(rows).select("sample_id", "chrom", F.inline("met"))


def lists_met(rows: DataFrame) -> DataFrame:
    """sample_id, chrom, met: the sums of interval_sums as a list for each site (those of its intervals that none of the cell's sites before lies in), with ``kept`` of the interval if interval_rows has it. A tile's rows are sorted in one task, its intervals first, then cell by cell; a task holds a batch and the intervals of one tile, and no pair is exchanged."""
    kept = f", kept: {rows.schema['kept'].dataType.simpleString()}" if "kept" in rows.columns else ""
    return dealt(rows).mapInArrow(_lists, f"sample_id string, chrom string, met array<struct<start: long, stop: long, sites: long, methyl: long, unmethyl: long, fractions: double{kept}>>")


def features_met(rows: DataFrame) -> DataFrame:
    """sample_id, features: the number of sums that ``met`` makes of a cell, from interval_rows. They are counted and not made: the work grows with the sites and not with their pairs."""
    return dealt(rows).mapInArrow(_features, "sample_id string, features long").groupBy("sample_id").agg(F.sum("features").alias("features"))


def dealt(rows: DataFrame) -> DataFrame:
    """interval_rows as _whole takes them: each tile's in one task, its intervals first (by start and stop), then cell by cell."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = ["kept"] if "kept" in rows.columns else []
    placed = rows.repartition(n, "chrom", "tile").sortWithinPartitions("chrom", "tile", "site", "sample_id", "p", "q")
    sure = [F.coalesce(c, F.lit(0)).alias(c) for c in ("q", "m", "u")]
    return placed.select("chrom", "tile", "site", "sample_id", "p", *sure, F.when(F.col("site"), F.col("m") / (F.col("m") + F.col("u"))).otherwise(0.0).alias("f"), *more)


#: places are below FAR; a tile's or a cell's number stands above GROUP bits of a place
FAR, GROUP = 1 << 41, 42


def _differs(column):
    import numpy as np
    import pyarrow.compute as pc

    a, b = column.slice(1), column.slice(0, len(column) - 1)
    return np.append(True, pc.coalesce(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy())


def _whole(batches):
    """Tables of tiles (see dealt) from batches, each with the intervals of its sites; a batch's last cell waits for the next batch, with the intervals of its tile."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if kept is None else pa.concat_tables([kept, t])
        new = _differs(t["chrom"]) | _differs(t["tile"])
        tile, run = np.flatnonzero(new)[-1], np.flatnonzero(new | _differs(t["site"]) | _differs(t["sample_id"]))[-1]
        spans = t.slice(tile).filter(pc.invert(t["site"].slice(tile)))
        # if the last row is an interval, all of its tile's rows are
        kept = spans if not t["site"][-1].as_py() else pa.concat_tables([spans, t.slice(run)])
        if run:
            yield t.slice(0, run)
    if kept is not None:
        yield kept


def _parts(t):
    """Sites and intervals of a table of tiles in arrays; None without both. ``before`` is the place of the cell's site before in the tile."""
    import numpy as np

    new = _differs(t["chrom"]) | _differs(t["tile"])
    g, site = np.cumsum(new), t["site"].to_numpy()
    p, q = t["p"].to_numpy(), t["q"].to_numpy()
    at, own = np.flatnonzero(~site), np.flatnonzero(site)
    if not len(at) or not len(own):
        return None
    first = (new | _differs(t["sample_id"]) | _differs(t["site"]))[own]
    x = p[own]
    before = np.where(first, -FAR + 1, np.append(0, x[:-1]))  # an interval belongs to the first of its sites
    return at, own, p[at], q[at], g[at], g[own], x, first, before


def _meet(batches):
    """names, contigs, count of sites and their pairs with the intervals that none of the cell's sites before lies in: place of the interval in (start, stop, kept), and for pairs of several sites (some: which pairs) sites, methyl, unmethyl and fractions; a pair of one site has those of the site (m, u, f)."""
    import numpy as np
    import pyarrow as pa

    most = 1 << 18
    for t in _whole(batches):
        parts = _parts(t)
        if parts is None:
            continue
        at, own, start, stop, sg, xg, x, first, before = parts
        end = np.minimum(stop, FAR - 1)
        spans = (sg << GROUP) + start
        longest = np.zeros(max(sg[-1], xg[-1]) + 1, "int64")
        np.maximum.at(longest, sg, end - start)
        # the place of the cell's site behind, beyond all intervals if there is none
        behind = np.append(np.where(first[1:], FAR, x[1:]), FAR)
        hi = np.searchsorted(spans, (xg << GROUP) + x, "right")
        lo = np.searchsorted(spans, (xg << GROUP) + np.maximum(x - longest[xg], before) + 1, "left")
        m, u, f = (t[c].to_numpy()[own] for c in "muf")
        mm, uu = np.append(0, np.cumsum(m)), np.append(0, np.cumsum(u))
        kept = t["kept"].combine_chunks().take(pa.array(at)) if "kept" in t.column_names else None
        names, contigs = (t[c].combine_chunks().take(pa.array(own)) for c in ("sample_id", "chrom"))
        count = np.maximum(hi - lo, 0)
        total = np.append(0, np.cumsum(count))
        done = 0
        while done < len(own):
            upto = max(done + 1, int(np.searchsorted(total, total[done] + most, "right")) - 1)
            c = count[done:upto]
            j = np.arange(total[done], total[upto]) - np.repeat(total[done:upto] - lo[done:upto], c)
            stops = end[j]
            keep = stops > np.repeat(x[done:upto], c)
            upon = np.append(0, np.cumsum(keep))
            c = np.diff(upon[total[done : upto + 1] - total[done]])
            j, stops = j[keep], stops[keep]
            some = np.flatnonzero(stops > np.repeat(behind[done:upto], c))
            if len(some):
                i = np.repeat(np.arange(done, upto), c)[some]
                n, ff, left, ends = np.ones(len(some), "int64"), f[i], np.arange(len(some)), stops[some]
                while len(left):
                    to = i[left] + n[left]
                    ff[left] += f[to]
                    n[left] += 1
                    left = left[ends[left] > behind[to]]
                more = some, n, mm[i + n] - mm[i], uu[i + n] - uu[i], ff
            else:
                more = None
            yield names.slice(done, upto - done), contigs.slice(done, upto - done), c, j, (start, stop, kept), (m[done:upto], u[done:upto], f[done:upto]), more
            done = upto


def _lists(batches):
    """The sums of tiles (see lists_met)."""
    import numpy as np
    import pyarrow as pa

    for names, contigs, count, j, (start, stop, kept), site, more in _meet(batches):
        sums = [np.ones(len(j), "int64"), *(np.repeat(c, count) for c in site)]
        if more is not None:
            for to, c in zip(sums, more[1:]):
                to[more[0]] = c
        fields = {k: pa.array(c) for k, c in zip(("start", "stop", "sites", "methyl", "unmethyl", "fractions"), (start[j], stop[j], *sums))}
        if kept is not None:
            fields["kept"] = kept.take(pa.array(j))
        offsets = pa.array(np.append(0, np.cumsum(count)).astype("int32"))
        found = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))
        yield pa.RecordBatch.from_arrays([names, contigs, found], names=["sample_id", "chrom", "met"])


def _features(batches):
    """Of each cell in a table of tiles the intervals that hold a site of it. A site counts those that hold it, less those that hold the cell's site before too: they start no later than that one and stop behind this one, which a wavelet matrix of the stops' ranks counts bit by bit."""
    import numpy as np
    import pyarrow as pa

    for t in _whole(batches):
        parts = _parts(t)
        if parts is None:
            continue
        _, own, start, stop, sg, xg, x, first, before = parts
        starts, stops = (sg << GROUP) + start, (sg << GROUP) + np.minimum(stop, FAR - 1)
        order = np.argsort(stops, kind="stable")
        ended = np.searchsorted(stops[order], (xg << GROUP) + x, "right")
        found = np.searchsorted(starts, (xg << GROUP) + x, "right") - ended
        held = np.flatnonzero(~first & (found > 0))
        low, high = np.searchsorted(sg, xg[held], "left"), np.searchsorted(starts, (xg[held] << GROUP) + before[held], "right")
        # of the intervals of the tile that start no later than the site before (low to high), those that stop no later than this site
        rank = np.empty(len(order), "int64")
        rank[order] = np.arange(len(order))
        less, limit, s, e = np.zeros(len(held), "int64"), ended[held], low, high
        for bit in range(len(rank).bit_length() - 1, -1, -1):
            zero = (rank >> bit & 1) == 0
            zeros = np.append(0, np.cumsum(zero))
            s0, e0, up = zeros[s], zeros[e], (limit >> bit & 1) == 1
            less += np.where(up, e0 - s0, 0)
            s, e = np.where(up, zeros[-1] + s - s0, s0), np.where(up, zeros[-1] + e - e0, e0)
            rank = np.concatenate([rank[zero], rank[~zero]])
        found[held] -= high - low - less
        cells = np.flatnonzero(first)
        sums = np.add.reduceat(found, cells)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([t["sample_id"].combine_chunks().take(pa.array(own[cells[some]])), pa.array(sums[some])], names=["sample_id", "features"])


def interval_means(cpg: DataFrame, intervals: DataFrame, base: int = 1, width: int = 32768) -> DataFrame:
    """Per cell and interval with a covered site: mean site fraction (as float), sums and sites. Overlapping intervals are independent."""
    return means(interval_sums(cpg, intervals, base, width))


def means(sums: DataFrame) -> DataFrame:
    """interval_means from the sums of interval_sums."""
    return sums.select("sample_id", "chrom", "start", "stop", (F.col("fractions") / F.col("sites")).cast("float").alias("mean_fraction"), "methyl", (F.col("methyl") + F.col("unmethyl")).alias("cov"), "sites")


def tss_bins(genes: DataFrame, flank: int = 2000, step: int = 20) -> DataFrame:
    """Strand-aware bins around transcription starts: gene, chrom, start, stop, offset. Bins that leave the contig are dropped.

    Genes are dealt out first: a table of genes is a small file, which one task would unfold whole.
    """
    n = int(genes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = genes.repartition(n, "gene").withColumn("offset", F.explode(F.sequence(F.lit(-flank), F.lit(flank - step), F.lit(step))))
    start = F.when(F.col("strand") == "+", F.col("g_start") + F.col("offset")).otherwise(F.col("g_end") - F.col("offset") - step)
    return b.withColumn("start", start).withColumn("stop", F.col("start") + step).where("start >= 0 and stop <= len").select("gene", "chrom", "start", "stop", F.col("offset").cast("int").alias("offset"))


def shared_bins(bins: DataFrame) -> DataFrame:
    """bins that lie on the same place as another, with n, the bins there. Bins are exchanged once and counted where they lie: a join with the counts would broadcast them, as a plan takes unfolded bins to be as small as the table of genes."""
    place = Window.partitionBy("chrom", "start", "stop")
    return bins.withColumn("n", F.count("*").over(place)).where("n > 1")


def tss_regions(bins: DataFrame, contigs: DataFrame) -> DataFrame:
    """Bins of host contigs, cut at the contig's end: chrom, start, stop, offset, gene."""
    return bins.where(is_host("chrom")).join(F.broadcast(contigs.select("chrom", "len")), "chrom").withColumn("stop", F.least("stop", "len")).where("stop > start").select("chrom", "start", "stop", "offset", "gene")


def tss_profile(cpg: DataFrame, regions: DataFrame, base: int = 1) -> DataFrame:
    """Per cell and offset: mean of the regions' mean fractions over all memberships, and methylated counts. Regions that several genes share are measured once.

    A region brings its offsets into its tile, so that measured regions are not exchanged to meet them. What a site adds leaves the tile as one row of arrays, and a cell's rows are added up together.
    """
    n = int(cpg.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = regions.groupBy("chrom", "start", "stop").agg(F.collect_list("offset").alias("offsets"))
    sites = lists_met(interval_rows(cpg, shared, base, keep="offsets")).where(F.size("met") > 0)
    mean = F.transform("met", lambda r: (r["fractions"] / r["sites"]).cast("float"))
    dealt = sites.select("sample_id", F.col("met.kept").alias("offset"), mean.alias("mean"), F.col("met.methyl").alias("methyl")).repartition(n, "sample_id")
    measured = dealt.select("sample_id", F.inline(F.arrays_zip("offset", "mean", "methyl")))
    members = measured.select("sample_id", F.explode("offset").alias("offset"), "mean", "methyl")
    return members.groupBy("sample_id", "offset").agg(F.avg(F.col("mean").cast("double")).alias("meth_frac"), F.sum("methyl").cast("long").alias("methyl"), F.count("*").alias("members"))


def tagged_sums(cpg: DataFrame, sets: dict[str, tuple[DataFrame, int]], base: int = 1, width: int = BIN, window: int = WINDOW, windows: bool = True) -> DataFrame:
    """sample_id, product, chrom, a, b, sites, methyl, unmethyl, fractions: sums of all products from one scan of the counts.

    A site counts for its contig (``contig``), its bin (``bin``, a; host contigs), its window (``window``, a; autosomes), and each interval [a, b) that holds it of the named sets, given with the
    width of the bins that they are looked up in. The sums are folded in the scan's tasks before they are exchanged. A site meets its bin's intervals as one array, which overlapping intervals alone make long;
    every pair of a site and an interval that holds it is a row to fold, so sets of many overlapping intervals are for interval_sums.
    """
    rows = cpg.select("sample_id", "chrom", "pos", "methyl", "unmethyl").withColumn("p0", F.col("pos") - base)
    nothing = F.lit(None).cast("long")

    def tag(product: str, a, b=nothing):
        return F.struct(F.lit(product).alias("product"), a.alias("a"), b.alias("b"))

    tags = [
        F.array(tag("contig", nothing)),
        F.when(is_host("chrom"), F.array(tag("bin", F.floor(F.col("p0") / width)))),
        F.when(is_autosome("chrom") & F.lit(windows), F.array(tag("window", F.floor(F.col("p0") / window)))),
    ]
    for name, (intervals, step) in sets.items():
        spans = intervals.where(is_host("chrom") & (F.col("stop") > F.col("start"))).select("chrom", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")).distinct()
        listed = spans.withColumn(f"__{name}_bin", F.explode(F.sequence(F.floor(F.col("start") / step), F.floor((F.col("stop") - 1) / step))))
        listed = listed.groupBy("chrom", f"__{name}_bin").agg(F.collect_list(F.struct("start", "stop")).alias(f"__{name}"))
        rows = rows.withColumn(f"__{name}_bin", F.floor(F.col("p0") / step)).join(listed, ["chrom", f"__{name}_bin"], "left")
        holds = F.filter(f"__{name}", lambda i: (F.col("p0") >= i["start"]) & (F.col("p0") < i["stop"]))
        tags.append(F.arrays_zip(F.transform(holds, lambda _: F.lit(name)).alias("product"), holds["start"].alias("a"), holds["stop"].alias("b")))
    kind = "array<struct<product: string, a: long, b: long>>"
    found = F.explode(F.concat(*[F.coalesce(t.cast(kind), F.array().cast(kind)) for t in tags])).alias("t")
    one = rows.select("sample_id", "chrom", "methyl", "unmethyl", fraction().alias("f"), found)
    sums = [F.count("*").alias("sites"), F.sum("methyl").cast("long").alias("methyl"), F.sum("unmethyl").cast("long").alias("unmethyl"), F.sum("f").alias("fractions")]
    return one.groupBy("sample_id", F.col("t.product").alias("product"), "chrom", F.col("t.a").alias("a"), F.col("t.b").alias("b")).agg(*sums)


def stretch_sums(cpg: DataFrame, base: int = 1, width: int = BIN) -> DataFrame:
    """sample_id, chrom, a, sites, methyl, unmethyl, fractions of each stretch [a * width, (a + 1) * width) with a site. Contigs and windows that are whole stretches add these up: a site is one row to exchange, whatever it counts for."""
    sums = [F.count("*").alias("sites"), F.sum("methyl").cast("long").alias("methyl"), F.sum("unmethyl").cast("long").alias("unmethyl"), F.sum(fraction()).alias("fractions")]
    return cpg.groupBy("sample_id", "chrom", F.floor((F.col("pos") - base) / width).alias("a")).agg(*sums)


def added(sums: DataFrame, *keys) -> DataFrame:
    """sums (see stretch_sums) by cell, contig and further keys."""
    return sums.groupBy("sample_id", "chrom", *keys).agg(*[F.sum(c).alias(c) for c in ("sites", "methyl", "unmethyl", "fractions")])


def summary_of(sums: DataFrame, cells: DataFrame) -> DataFrame:
    """cpg_summary from the sums by contig or stretch."""
    kind = contig_class("chrom")
    signals = F.col("methyl") + F.col("unmethyl")
    columns = [c for k in CLASSES for c in (
        F.coalesce(F.sum(F.when(kind == k, F.col("sites"))), F.lit(0)).alias(f"{k.lower()}_sites"),
        F.coalesce(F.sum(F.when(kind == k, signals)), F.lit(0)).alias(f"{k.lower()}_signals"),
        (100 * F.sum(F.when(kind == k, F.col("fractions"))) / F.sum(F.when(kind == k, F.col("sites")))).alias(f"{k.lower()}_rate_pct"),
    )]
    out = sums.groupBy("sample_id").agg(F.sum("sites").alias("total_sites"), F.sum(signals).alias("total_signals"), *columns)
    out = cells.select("sample_id").distinct().join(out, "sample_id", "left")
    return out.fillna(0, [c for c in out.columns if c.endswith(("_sites", "_signals"))])


def bins_of(sums: DataFrame) -> DataFrame:
    """coverage_bins from the sums by bin of host contigs."""
    return sums.select("sample_id", "chrom", F.col("a").alias("bin"), (F.col("methyl") + F.col("unmethyl")).alias("cov"))


def single_pass(cpg: DataFrame, cells: DataFrame, contigs: DataFrame, intervals: DataFrame, regions: DataFrame | None = None, base: int = 1) -> dict[str, DataFrame]:
    """All products of one table of counts: ``summary``, ``chromosomes``, ``gini``, ``windows``, ``intervals``, ``features`` (a cell's number of intervals), and with TSS regions ``profile``.

    The sums of bins, which a cell has a bounded number of, come from one scan and are written once; contigs and windows add them up. A cell's sums of intervals are as
    many as its pairs of a site and an interval, so they are never written: ``intervals``, ``features`` and ``profile`` each read the counts when they are computed.
    """
    from methlake.operators.manifest import _cut

    sums = _cut(stretch_sums(cpg, base))
    contig = added(sums)
    window = added(sums.where(is_autosome("chrom")), F.floor(F.col("a") / (WINDOW // BIN)).alias("win"))
    products = {
        "summary": summary_of(sums, cells),
        "chromosomes": _all_contigs(contig.select("sample_id", "chrom", "sites", "methyl", "unmethyl", (F.col("fractions") / F.col("sites")).alias("mean_fraction")), cells, contigs),
        "gini": gini(bins_of(sums.where(is_host("chrom")))),
        "windows": _all_windows(window.select("sample_id", "chrom", "win", F.col("methyl").alias("mc"), (F.col("methyl") + F.col("unmethyl")).alias("cov")), cells, contigs, WINDOW),
        "intervals": interval_means(cpg, intervals, base),
        "features": features_met(interval_rows(cpg, intervals, base)),
    }
    return products if regions is None else products | {"profile": tss_profile(cpg, regions, base)}


def pooled_controls(cpg: DataFrame) -> DataFrame:
    """Pooled rate of the control contigs: chrom, sites, modified, unmodified, pct (null without counts)."""
    return cpg.where(F.col("chrom").isin("lambda", "pUC19")).groupBy("chrom").agg(F.count("*").alias("sites"), F.sum("methyl").cast("long").alias("modified"), F.sum("unmethyl").cast("long").alias("unmodified")).withColumn("pct", 100.0 * F.col("modified") / F.nullif(F.col("modified") + F.col("unmodified"), F.lit(0)))


def chr1_share(cpg: DataFrame) -> DataFrame:
    return cpg.groupBy("sample_id").agg((F.sum(F.when(F.col("chrom") == "chr1", coverage()).otherwise(0)) / F.nullif(F.sum(coverage()), F.lit(0))).alias("chr1_share"))


def pivot_by_chromosome(stats: DataFrame, value: str, names: list[str]) -> DataFrame:
    """A cell's value by contig, a column for each name."""
    return stats.groupBy("sample_id").pivot("chrom", names).agg(F.first(value))
