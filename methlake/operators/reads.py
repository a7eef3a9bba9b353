"""Reads: pairing, barcode lookup, plate and droplet layouts, cell calling and the barcode error screen."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from methlake.functions import sequence as S

# fixed values: the anchors of the two layouts, the gap after them, and the shortest plate read
PLATE_ANCHOR = "AGATGTGTATAAGAGACAG"
DROPLET_ANCHOR = "TTTCTTATATGGGCGTCCGTCGTTGCTCGTAGATGTGTATAAGAGACAG"
GAP, SHORTEST = 9, 20
#: bins of the histogram of barcode counts
BINS = 200
#: rows of a barcode index (some 50 for each barcode) up to which it is broadcast
SMALL = 200_000


def mate_join(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Mates by lane and ordinal: lane, ordinal, id, seq1, seq2, problem (missing mate, differing ids, or null)."""
    a = r1.select("lane", "ordinal", S.read_id("id").alias("id1"), F.col("seq").alias("seq1"))
    b = r2.select("lane", "ordinal", S.read_id("id").alias("id2"), F.col("seq").alias("seq2"))
    j = a.join(b, ["lane", "ordinal"], "full_outer")
    problem = F.when(F.col("id1").isNull() | F.col("id2").isNull(), "missing_mate").when(F.col("id1") != F.col("id2"), "ids_differ")
    return j.select("lane", "ordinal", F.coalesce("id1", "id2").alias("id"), "seq1", "seq2", problem.alias("problem"))


def barcode_index(barcodes: DataFrame, alphabet: str = "ACGT", protected: DataFrame | None = None, shifted: bool = True) -> DataFrame:
    """key -> id, ambiguous: each barcode and its one-substitution neighbours; the nearer wins, a tie of two is ambiguous.

    shifted adds barcodes without their first letter, exactly (keys one letter shorter). protected: barcodes of a design, which are nobody's neighbour.
    The index has 3 * length + 2 rows per barcode.
    """
    own = barcodes.select(F.upper(F.trim("barcode")).alias("id")).distinct()
    full = own.select("id", F.col("id").alias("key"), F.lit(0).alias("d")).unionByName(own.select("id", F.explode(S.neighbours("id", alphabet)).alias("key"), F.lit(1).alias("d")))
    if protected is not None:
        design = protected.select(F.col("barcode").alias("key")).distinct()
        full = full.where("d = 0").unionByName(full.where("d > 0").join(design, "key", "left_anti").select("id", "key", "d"))
    if shifted:
        full = full.unionByName(own.select("id", F.substring("id", F.lit(2), F.length("id")).alias("key"), F.lit(0).alias("d")))
    best = full.groupBy("key").agg(F.min(F.struct("d", "id")).alias("low"), F.collect_set(F.struct("d", "id")).alias("all"))
    ties = F.size(F.filter("all", lambda x: x["d"] == F.col("low.d")))
    return best.select("key", F.when(ties == 1, F.col("low.id")).alias("id"), (ties > 1).alias("ambiguous"))


def bounded(rows: DataFrame, most: int = SMALL) -> DataFrame:
    """rows, marked for broadcast if there are ``most`` at most; otherwise the join is planned by size."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def barcode_lookup(observed: DataFrame, index: DataFrame, column: str = "observed") -> DataFrame:
    """observed with id, ambiguous (both null where nothing matches; N never matches)."""
    return observed.join(bounded(index).withColumnRenamed("key", column), column, "left")


def plate_demux(reads: DataFrame, barcodes: DataFrame, bisulfite: bool = True, length: int = 8) -> DataFrame:
    """lane, ordinal, fate (dna_assigned, ambiguous, unmatched, short), barcode, trim_start.

    The anchor is looked for behind the barcode at its place, one before and one after (two mismatches at most after folding); the first of these whose barcode is
    unique and which leaves bases after the gap decides. Other reads get the nearest alignment of the anchor (three edits at most) in their
    first 60 bases. An ambiguous barcode in any attempt makes an unassigned read ambiguous; a null read is unmatched.
    """
    n = len(PLATE_ANCHOR)
    tries = [(length, 0, length), (length - 1, 0, length - 1), (length + 1, 1, length + 1)]
    index = bounded(barcode_index(barcodes))
    out = reads.select("lane", "ordinal", "seq")

    def looked_up(df: DataFrame, k: int, observed: Column, trim: Column) -> DataFrame:
        """df with hit{k} (barcode and place of the payload, if there is one) and amb{k}."""
        found = index.select(F.col("key").alias("__key"), F.col("id").alias("__id"), F.col("ambiguous").alias("__amb"))
        j = df.join(found, observed == F.col("__key"), "left")
        hit = F.when(F.col("__id").isNotNull() & (trim < F.length("seq")), F.struct(F.col("__id").alias("id"), trim.cast("int").alias("trim")))
        return j.select(*df.columns, hit.alias(f"hit{k}"), F.coalesce("__amb", F.lit(False)).alias(f"amb{k}"))

    long = F.length("seq") >= SHORTEST
    out = out.withColumn("d", anchor_distances(F.col("seq"), [at for at, _, _ in tries], PLATE_ANCHOR, bisulfite))
    for k, (at, b, e) in enumerate(tries):
        near = long & (F.col(f"d.p{k}") <= 2)
        out = looked_up(out, k, F.when(near, F.substring("seq", b + 1, e - b)), F.lit(at + n + GAP))
    # the alignment sees only what is still undecided: it gets null for the rest
    out = out.withColumn("al", anchor_alignment(F.when(long & F.coalesce("hit0", "hit1", "hit2").isNull(), F.substring("seq", 1, 60)), bisulfite))
    placed = F.col("al.start").between(length - 1, length + 1)
    out = looked_up(out, 3, F.when(placed, F.expr(f"substring(seq, greatest(al.start - {length}, 0) + 1, al.start - greatest(al.start - {length}, 0))")), F.col("al.stop") + GAP)
    hit = F.coalesce(*[f"hit{k}" for k in range(4)])
    fate = F.when(~long, "short").when(hit.isNotNull(), "dna_assigned").when(S.any_of(*[F.col(f"amb{k}") for k in range(4)]), "ambiguous").otherwise("unmatched")
    return out.select("lane", "ordinal", fate.alias("fate"), hit["id"].alias("barcode"), hit["trim"].alias("trim_start"))


def _padded(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(the first ``width`` bytes of each text, 0 beyond its end; its length); null is empty."""
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"\0", "u1") if len(texts) else np.zeros(1, "u1")
    at = offsets[:-1, None] + np.arange(width)
    return np.where(at < offsets[1:, None], data[np.minimum(at, len(data) - 1)] if len(data) else 0, 0).astype("u1"), np.diff(offsets)


def anchor_distances(column: Column, places: list[int], anchor: str, bisulfite: bool) -> Column:
    """p0, p1, ...: mismatches of a fixed anchor with the bases from each 0-based place on after folding, null where the read is too short. All places of a batch are compared as one array."""
    n = len(anchor)
    want = np.frombuffer(anchor.replace("G", "A").encode() if bisulfite else anchor.encode(), "u1")
    fold = np.arange(256, dtype=np.uint8)
    if bisulfite:
        fold[[ord("G"), ord("g")]] = ord("A")
    else:
        fold[ord("a") : ord("z") + 1] -= 32

    @arrow_udf(", ".join(f"p{k} int" for k in range(len(places))))
    def run(texts: pa.Array) -> pa.Array:
        data, length = _padded(texts, max(places) + n)
        data = fold[data]
        found = [pa.array((data[:, p : p + n] != want).sum(1).astype(np.int32), mask=length < p + n) for p in places]
        return pa.StructArray.from_arrays(found, [f"p{k}" for k in range(len(places))])

    return run(column)


def align(texts: pa.Array, anchor: str = PLATE_ANCHOR, bisulfite: bool = True, most: int = 3, width: int = 60) -> pa.StructArray:
    """Best alignment (start, stop, edits) of anchor anywhere in each text, the earliest end among equals; null beyond ``most`` edits.

    Semi-global edit distance, one column of all texts at a time; a path keeps its start, and among equal paths the one that pairs letters, then the one that skips one of the text's.
    """
    some = texts.is_valid().to_numpy(zero_copy_only=False)
    data, n = _padded(texts.filter(pa.array(some)), width)
    if bisulfite:
        data = np.where((data == ord("G")) | (data == ord("g")), ord("A"), data)
        anchor = anchor.replace("G", "A")
    rows, letters = len(data), anchor.encode()
    # a path is one small number: its cost, two bits for its last step (0 pairs letters), its start; the least of them is the path to keep
    bits = width.bit_length()
    one, skips, drops, keep = 4 << bits, 1 << bits, 2 << bits, ~(3 << bits)
    small = np.int16 if (len(letters) + 2) * one < 1 << 15 else np.int32
    data = np.ascontiguousarray(data.T)
    paths = np.repeat((np.arange(len(letters) + 1) * one).astype(small)[:, None], rows, axis=1)
    miss = {a: (data != a).astype(small) * small(one) for a in set(letters)}
    best = np.full(rows, most + 1)
    found = np.zeros((rows, 2), int)
    for j in range(width):
        new = np.empty_like(paths)
        new[0] = j + 1
        for i, a in enumerate(letters, 1):
            least = np.minimum(paths[i - 1] + miss[a][j], paths[i] + small(one + skips))
            np.bitwise_and(np.minimum(least, new[i - 1] + small(one + drops)), small(keep), out=new[i])
        paths = new
        cost = paths[-1] // small(one)
        better = (cost < best) & (j < n)
        best[better] = cost[better]
        found[better, 0], found[better, 1] = paths[-1][better] & small(skips - 1), j + 1
    out = np.full((len(texts), 3), most + 1, np.int32)
    out[some] = np.column_stack([found, best])
    return pa.StructArray.from_arrays([pa.array(c) for c in out.T], ["start", "stop", "edits"], mask=pa.array(out[:, 2] > most))


def anchor_alignment(column: Column, bisulfite: bool = True) -> Column:
    @arrow_udf("start int, stop int, edits int")
    def run(texts: pa.Array) -> pa.Array:
        return align(texts, bisulfite=bisulfite)

    # a filter on the alignment, pushed below it, would align every read twice
    return run.asNondeterministic()(column)


def _droplet_distance(data: np.ndarray, start: int, length: int, ct: bool) -> np.ndarray:
    """Mismatches of the droplet anchor with data[:, start:start+length]; a length off by one costs one indel at the best place."""
    anchor = np.frombuffer(DROPLET_ANCHOR.encode(), "u1")

    def miss(a: np.ndarray, o: np.ndarray) -> np.ndarray:
        allowed = (a == ord("C")) & (o == ord("T")) if ct else (a == ord("G")) & (o == ord("A"))
        return ((a != o) & ~allowed).astype(int)

    o = data[:, start : start + length]
    n = len(anchor)
    if length == n:
        return miss(anchor, o).sum(1)
    if length < n:
        same, moved = miss(anchor[:length], o), miss(anchor[1 : length + 1], o)
    else:
        same, moved = miss(anchor, o[:, :n]), miss(anchor, o[:, 1 : n + 1])
    before = np.concatenate([np.zeros((len(o), 1), int), np.cumsum(same, 1)], 1)
    after = np.concatenate([np.cumsum(moved[:, ::-1], 1)[:, ::-1], np.zeros((len(o), 1), int)], 1)
    return 1 + (before + after).min(1)


def _droplet_boundaries(texts: pa.Array) -> pa.StructArray:
    """start and stop of the anchor in each text (-1 if it is nowhere within two mismatches), and whether two boundaries are as good."""
    data, full = _padded(texts, 90)
    places = [(start, length) for start in (28, 29, 30) for length in (48, 49, 50)]
    scores = np.stack([np.where(a + n <= full, np.minimum(_droplet_distance(data, a, n, True), _droplet_distance(data, a, n, False)), 9) for a, n in places], 1)
    best = scores.min(1)
    where = np.array(places)[scores.argmin(1)]
    some = best <= 2
    start = np.where(some, where[:, 0], -1).astype(np.int32)
    return pa.StructArray.from_arrays([pa.array(start), pa.array(np.where(some, where.sum(1), -1).astype(np.int32)), pa.array(some & ((scores == best[:, None]).sum(1) > 1))], ["start", "stop", "tied"])


def droplet_extract(reads: DataFrame) -> DataFrame:
    """reads with the struct ``layout``: fate and, where it is ``assigned``, barcode (17), umi (12) and trim_start. Two best boundaries are ambiguous."""

    @arrow_udf("start int, stop int, tied boolean")
    def run(texts: pa.Array) -> pa.Array:
        return _droplet_boundaries(texts)

    n, a, b = F.coalesce(F.length("seq"), F.lit(0)), F.col("__b.start"), F.col("__b.stop")
    barcode, umi = F.expr("substring(seq, __b.start - 28, 17)"), F.expr("substring(seq, __b.start - 11, 12)")
    fate = (
        F.when(n < 28 + len(DROPLET_ANCHOR) - 1, "short").when(F.col("__b.tied"), "ambiguous").when(a < 0, "unmatched").when((a < 29) | (b + GAP >= n), "short")
        .when(~barcode.rlike("^[ACGT]{17}$") | ~umi.rlike("^[ACGTN]{12}$"), "unmatched").otherwise("assigned")
    )
    good = F.col("__fate") == "assigned"
    layout = F.struct(F.col("__fate").alias("fate"), F.when(good, barcode).alias("barcode"), F.when(good, umi).alias("umi"), F.when(good, b + GAP).alias("trim_start"))
    return reads.withColumn("__b", run("seq")).withColumn("__fate", fate).select(*[F.col(f"`{c}`") for c in reads.columns], layout.alias("layout"))


def barcode_counts(reads: DataFrame) -> DataFrame:
    """barcode, count, below_q20[], q30[] of reads (barcode, qual): reads and, per base, those of low and of high quality."""
    q = reads.select("barcode", F.posexplode(S.qualities("qual")).alias("j", "q"))
    per = q.groupBy("barcode", "j").agg(F.count("*").alias("n"), F.count_if(F.col("q") < 20).alias("low"), F.count_if(F.col("q") >= 30).alias("high"))
    lists = per.groupBy("barcode").agg(F.max("n").alias("count"), F.array_sort(F.collect_list(F.struct("j", "low", "high"))).alias("x"))
    return lists.select("barcode", "count", F.col("x.low").alias("below_q20"), F.col("x.high").alias("q30"))


def eligible_barcodes(counts: DataFrame, least: int = 100) -> DataFrame:
    return counts.where(~F.col("barcode").contains("C") & (F.col("count") > least))


def fate_counts(reads: DataFrame, fates: tuple[str, ...] = ("dna_assigned", "ambiguous", "unmatched", "short")) -> DataFrame:
    """One row: reads by fate, usable (all but short) and all."""
    row = reads.agg(*[F.count_if(F.col("fate") == f).alias(f) for f in fates], F.count("*").alias("input"))
    return row.withColumn("usable", F.col("input") - F.col("short"))


def cell_counts(cells: DataFrame, assigned: DataFrame, key: str = "sample_id") -> DataFrame:
    """Reads of every cell, 0 for cells without any."""
    return cells.select(key).distinct().join(assigned.groupBy(key).agg(F.count("*").alias("reads")), key, "left").fillna(0, ["reads"])


def log_histogram(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """b, n, low, width: every bin of log10(count + 1) between the least and the greatest value with its barcodes. No rows without two different counts."""
    v = counts.select(F.log10(F.col("count") + 1).alias("v"))
    ends = v.agg(F.min("v").alias("low"), ((F.max("v") - F.min("v")) / bins).alias("width")).where("width > 0")
    # one row on the broadcast side
    n = v.join(F.broadcast(ends)).groupBy(F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("low")) / F.col("width"))).alias("b")).agg(F.count("*").alias("n"))
    every = ends.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("b"), "low", "width")
    return every.join(n, "b", "left").select("b", F.coalesce("n", F.lit(0)).alias("n"), "low", "width")


def moving_mean(histogram: DataFrame, reach: int = 11) -> DataFrame:
    """histogram with m: the sum over +-reach bins divided by the full window, also at the ends. The window has the histogram's rows, BINS at most."""
    w = Window.partitionBy().orderBy("b").rowsBetween(-reach, reach)
    return histogram.withColumn("m", F.sum("n").over(w) / (2 * reach + 1))


def _plateaus(smooth: DataFrame) -> DataFrame:
    """Islands of bins in a row with one value (within 1e-12): first, last, m, and the values before and after (null at the ends)."""
    w = Window.partitionBy().orderBy("b")
    new = F.coalesce((F.abs(F.col("m") - F.lag("m").over(w)) > 1e-12).cast("int"), F.lit(1))
    rows = smooth.withColumn("new", new).withColumn("island", F.sum("new").over(w))
    islands = rows.groupBy("island").agg(F.min("b").alias("first"), F.max("b").alias("last"), F.min_by("m", "b").alias("m"))
    v = Window.partitionBy().orderBy("first")
    return islands.withColumn("before", F.lag("m").over(v)).withColumn("after", F.lead("m").over(v))


def peaks(smooth: DataFrame, apart: int = 20) -> DataFrame:
    """place, b, m of the strict local maxima of (b, m), highest first, a plateau at its middle; none lies within ``apart`` of one before it."""
    top = _plateaus(smooth).where("m > before and m > after").select(F.floor((F.col("first") + F.col("last")) / 2).alias("b"), "m")
    ranked = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("m")).alias("h"), "b"))).alias("x"))
    kept = F.expr(f"aggregate(x, cast(array() as array<struct<h: double, b: bigint>>), (s, p) -> if(exists(s, o -> abs(o.b - p.b) < {apart}), s, concat(s, array(p))))")
    return ranked.select(F.posexplode(kept).alias("place", "p")).select(F.col("place").cast("long").alias("place"), F.col("p.b").alias("b"), (-F.col("p.h")).alias("m"))


def valley(smooth: DataFrame, tops: DataFrame) -> DataFrame:
    """threshold (one row): the count at the middle of the lowest stretch between the two highest peaks; null without two, or if the stretch isn't below both."""
    two = tops.where("place < 2").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.min("m").alias("lower"), F.count("*").alias("tops"))
    between = smooth.join(F.broadcast(two)).where("tops = 2 and b > lo and b < hi")
    least = between.agg(F.min("m").alias("least"))
    low = between.join(F.broadcast(least)).where("m <= least + 1e-12")
    # the first stretch of such bins
    w = Window.partitionBy().orderBy("b")
    first = low.withColumn("k", F.col("b") - F.row_number().over(w)).withColumn("k0", F.min("k").over(Window.partitionBy())).where("k = k0")
    mid = first.agg(F.min("b").alias("a"), F.max("b").alias("z"), F.min("m").alias("m"), F.min("lower").alias("lower"), F.min("low").alias("low"), F.min("width").alias("width"))
    value = F.pow(F.lit(10.0), F.col("low") + (F.floor((F.col("a") + F.col("z")) / 2) + 0.5) * F.col("width")) - 1
    return mid.select(F.when(F.col("m") < F.col("lower") - 1e-12, value).alias("threshold"))


def call_cells(counts: DataFrame, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """(called barcodes with their counts, the one row of their threshold, which is null if none can be told). Nothing but rows of the histogram is gathered in one task."""
    e = eligible_barcodes(counts, least)
    smooth = moving_mean(log_histogram(e))
    limit = valley(smooth, peaks(smooth))
    return e.join(F.broadcast(limit)).where("count >= threshold").drop("threshold"), limit


def higher_neighbours(called: DataFrame, alphabet: str = "AGT") -> DataFrame:
    """barcode, count, parent, parent_count, place: called barcodes one substitution away with a higher count (an equi-join on the neighbours)."""
    near = called.select("barcode", "count", F.explode(S.neighbours("barcode", alphabet)).alias("parent"))
    up = called.select(F.col("barcode").alias("parent"), F.col("count").alias("parent_count"))
    differing = F.array_position(F.zip_with(S.letters("barcode"), S.letters("parent"), lambda a, b: (a != b).cast("int")), 1)
    return near.join(up, "parent").where("parent_count > count").withColumn("place", differing.cast("int")).select("barcode", "count", "parent", "parent_count", "place")


#: multipliers and shifts of the rank of a molecule key (fixed values: they say which molecules a sample keeps)
RANK_SHIFTS, RANK_FACTORS = (30, 27, 31), (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
MOLECULE_CAP = 4096


def molecule_ranks(keys: list[str]) -> np.ndarray:
    """64-bit ranks of molecule keys (44 bases of ACGT, two bits each, mixed)."""
    bases = np.frombuffer("".join(keys).encode(), np.uint8).reshape(len(keys), -1)
    digit = np.zeros(256, np.uint64)
    digit[[ord(b) for b in "ACGT"]] = range(4)
    high, low = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
    for k in range(bases.shape[1]):
        high = (high << np.uint64(2)) | (low >> np.uint64(62))
        low = (low << np.uint64(2)) | digit[bases[:, k]]

    def mix(x: np.ndarray) -> np.ndarray:
        for shift, factor in zip(RANK_SHIFTS, RANK_FACTORS):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(RANK_SHIFTS[2]))

    return mix(low ^ mix(high))


def _sketches(cap: int, held: int = 1 << 18):
    """Rows (barcode, key) -> rows (barcode, rank, key, reads): the cap + 1 least distinct keys of each barcode among at most ``held`` rows and what was kept before; reads is on a barcode's first row."""
    import pyarrow as pa

    def least(barcode: np.ndarray, rank: np.ndarray, key: np.ndarray, reads: np.ndarray):
        o = np.lexsort((key, rank, barcode))
        barcode, rank, key, reads = barcode[o], rank[o], key[o], reads[o]
        new = np.ones(len(o), bool)
        new[1:] = barcode[1:] != barcode[:-1]
        first = np.flatnonzero(new)
        if len(first):
            total = np.add.reduceat(reads, first)
            reads = np.zeros(len(o), np.int64)
            reads[first] = total
        once = new.copy()
        once[1:] |= key[1:] != key[:-1]
        n = np.cumsum(once)
        keep = once & (n - np.repeat(n[first], np.diff(np.append(first, len(o)))) <= cap)
        return barcode[keep], rank[keep], key[keep], reads[keep]

    def table(now):
        # ranks order as unsigned, the column is signed
        return pa.RecordBatch.from_arrays([pa.array(now[0], pa.string()), pa.array((now[1] ^ np.uint64(1 << 63)).view(np.int64)), pa.array(now[2], pa.string()), pa.array(now[3])], ["barcode", "rank", "key", "reads"])

    def run(batches):
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(1).to_pylist()
            new = (np.array(batch.column(0).to_pylist(), object), molecule_ranks(keys), np.array(keys, object), np.ones(len(keys), np.int64))
            now = least(*(new if now is None else (np.concatenate(x) for x in zip(now, new))))
            if len(now[0]) > held:
                yield table(now)
                now = None
        if now is not None:
            yield table(now)

    return run


def molecule_samples(reads: DataFrame, cap: int = MOLECULE_CAP) -> DataFrame:
    """barcode, key, reads, saturated: of each barcode the cap molecule keys (umi and 32 bases) of least rank, with its reads that have a key (12 and 32 plain bases) and whether it has more than cap different keys.

    A mergeable sketch: each task keeps the cap + 1 least keys of its barcodes (a bounded number of rows, given out when there are more), and only these are exchanged. The last of a barcode's
    keys are found by a rank whose limit is applied before the exchange as well.
    """
    keys = reads.select("barcode", S.molecule_key("umi", "insert").alias("key")).where("barcode is not null and length(key) = 44")
    parts = keys.mapInArrow(_sketches(cap), "barcode string, rank long, key string, reads long")
    ranked = parts.withColumn("place", F.dense_rank().over(Window.partitionBy("barcode").orderBy("rank", "key"))).where(F.col("place") <= cap + 1)
    once = ranked.groupBy("barcode", "place", "key").agg(F.lit(1).alias("one")).drop("one")
    totals = parts.groupBy("barcode").agg(F.sum("reads").alias("reads"))
    full = once.where(F.col("place") == cap + 1).select("barcode", F.lit(True).alias("saturated"))
    out = once.where(F.col("place") <= cap).join(totals, "barcode").join(full, "barcode", "left")
    return out.select("barcode", "key", "reads", F.coalesce("saturated", F.lit(False)).alias("saturated"))


def molecules(reads: DataFrame, cap: int | None = MOLECULE_CAP) -> DataFrame:
    """barcode, key of molecule_samples; without a cap every different key of each barcode."""
    if cap is None:
        keys = reads.select("barcode", S.molecule_key("umi", "insert").alias("key"))
        return keys.where("barcode is not null and length(key) = 44").distinct()
    return molecule_samples(reads, cap).select("barcode", "key")


def error_candidates(called: DataFrame, qualities: DataFrame, threshold: float) -> DataFrame:
    """Called barcodes with a higher neighbour (barcode, count, parent, parent_count) and the reason for which one is no error of it, null if none shows in counts and qualities."""
    pairs = higher_neighbours(called)
    ups = pairs.groupBy("barcode").agg(F.count("*").alias("ups"))
    q = qualities.select("barcode", "below_q20", "q30")
    at = pairs.join(ups, "barcode").join(q, "barcode").join(q.select(F.col("barcode").alias("parent"), F.col("below_q20").alias("parent_q20")), "parent")
    low, high, plow = (F.element_at(c, F.col("place")) for c in ("below_q20", "q30", "parent_q20"))
    reason = (
        F.when(F.col("ups") > 1, "multiple_higher_neighbors")
        .when(F.col("parent_count") < 5 * F.col("count"), "insufficient_abundance_ratio")
        .when(high >= threshold, "independent_q30_support")
        .when((low < 0.2 * F.col("count")) | (low * F.col("parent_count") < 5 * plow * F.col("count")), "insufficient_quality_evidence")
    )
    return at.select("barcode", "count", "parent", "parent_count", reason.alias("reason"))


def shared_molecules(pairs: DataFrame, reads: DataFrame) -> DataFrame:
    """pairs (barcode, parent) with the UMIs and inserts of the molecules (see molecules()) that both have; pairs without any are left out."""
    pairs = pairs.select("barcode", "parent").distinct()
    parents = reads.select(F.col("barcode").alias("parent"), S.molecule_key("umi", "insert").alias("key")).where("key is not null").distinct()
    both = molecules(reads).join(pairs, "barcode").join(parents, ["parent", "key"])
    return both.groupBy("barcode", "parent").agg(F.countDistinct(F.substring("key", 1, 12)).alias("umis"), F.countDistinct(F.substring("key", 13, 32)).alias("inserts"))


def error_screen(called: DataFrame, qualities: DataFrame, reads: DataFrame, threshold: float) -> DataFrame:
    """barcode, decision, reason of the called barcodes with a higher neighbour: probable sequencing errors of it are removed.

    An error has one higher neighbour, at least five times as frequent, little high-quality support at the differing base, clearly more low-quality bases there than
    the neighbour, and shares at least three UMIs and three inserts with it; not if the neighbour is itself such an error.
    """
    at = error_candidates(called, qualities, threshold)
    pending = at.where("reason is null").select("barcode", "parent")
    evidence = shared_molecules(pending, reads)
    judged = pending.join(evidence, ["barcode", "parent"], "left").withColumn("proposed", F.coalesce((F.col("umis") >= 3) & (F.col("inserts") >= 3), F.lit(False)))
    chained = judged.where("proposed").select(F.col("barcode").alias("parent"), F.lit(True).alias("parent_proposed"))
    judged = judged.join(chained, "parent", "left")
    late = F.when(~F.col("proposed"), "insufficient_shared_molecules").when(F.col("parent_proposed"), "parent_is_error_candidate").otherwise("quality_and_shared_molecules")
    out = at.where("reason is not null").select("barcode", "reason").distinct().unionByName(judged.select("barcode", late.alias("reason")))
    return out.select("barcode", F.when(F.col("reason") == "quality_and_shared_molecules", "remove").otherwise("retain").alias("decision"), "reason")


def in_design(called: DataFrame, design: DataFrame) -> DataFrame:
    return called.join(design.select("barcode").distinct(), "barcode", "left_semi")


def droplet_replay(reads: DataFrame, called: DataFrame, design: DataFrame) -> DataFrame:
    """Reads (lane, ordinal, barcode) with the called barcode they belong to: exact, or one substitution away unless that is another design barcode."""
    own = called.select(F.upper(F.trim("barcode")).alias("id")).distinct()
    seen = reads.select("barcode").where("barcode is not null").distinct()
    # an observed barcode that is called or in the design is nobody's neighbour
    kinds = own.select(F.col("id").alias("barcode"), F.lit(True).alias("own")).unionByName(design.select("barcode", F.lit(False).alias("own"))).groupBy("barcode").agg(F.max("own").alias("own"))
    known = seen.join(kinds, "barcode", "left")
    near = nearest(known.where("own is null").select("barcode"), own)
    found = known.where("own").select("barcode", F.col("barcode").alias("id"), F.lit(False).alias("ambiguous")).unionByName(near)
    j = reads.join(found, "barcode", "left")
    return j.select("lane", "ordinal", "barcode", F.col("id").alias("cell_barcode"), F.when(F.col("id").isNotNull(), "dna_assigned").when(F.col("ambiguous"), "ambiguous").otherwise("unmatched").alias("fate"))


def nearest(observed: DataFrame, own: DataFrame, alphabet: str = "ACGT") -> DataFrame:
    """Different observed barcodes (barcode) that are one substitution away from a barcode of own (id): barcode, id (null if there are several), ambiguous.

    Two such barcodes agree in one half, so each is exchanged twice, by length and either half, and the neighbours of an own barcode are made and counted where its half lies: they are not exchanged.
    """
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = own.where("length(id) > 0").select(F.col("id").alias("b"), F.lit(True).alias("own")).unionByName(observed.select(F.col("barcode").alias("b"), F.lit(False).alias("own")))
    size, first = F.length("b"), F.floor(F.length("b") / 2).cast("int")
    both = F.array(F.struct(F.lit(0).alias("side"), F.substring("b", F.lit(1), first).alias("half")), F.struct(F.lit(1).alias("side"), F.substring("b", first + 1, size - first).alias("half")))
    dealt = rows.select("b", "own", size.alias("size"), F.inline(both)).repartition(n, "size", "side", "half")
    first = F.floor(F.col("size") / 2).cast("int")
    # the half that agrees is the side's; the other one has the substitution: its place and the own barcode's letter there, as a number
    none = F.array().cast("array<int>")
    places = F.when(F.col("side") == 0, F.sequence(first + 1, F.col("size"))).when(first > 0, F.sequence(F.lit(1), first)).otherwise(none)

    def around(i: Column) -> Column:
        letter = F.substring("b", i, F.lit(1))
        return F.transform(F.filter(F.array(*[F.lit(x) for x in alphabet]), lambda x: x != letter), lambda x: F.struct(F.overlay("b", x, i, F.lit(1)).alias("barcode"), (i * 256 + F.ascii(letter)).cast("long").alias("code")))

    made = F.when(F.col("own"), F.flatten(F.transform(places, around))).otherwise(F.array(F.struct(F.col("b").alias("barcode"), F.lit(None).cast("long").alias("code"))))
    met = dealt.select("size", "side", "half", F.inline(made)).groupBy("size", "side", "half", "barcode").agg(F.count("code").alias("k"), F.min("code").alias("code"), F.count("*").alias("rows"))
    met = met.where("k > 0 and rows > k").groupBy("barcode").agg(F.sum("k").alias("k"), F.min("code").alias("code"))
    id = F.overlay("barcode", F.char(F.col("code") % 256), F.floor(F.col("code") / 256).cast("int"), F.lit(1))
    return met.select("barcode", F.when(F.col("k") == 1, id).alias("id"), (F.col("k") > 1).alias("ambiguous"))


def sampled_pairs(reads: DataFrame, n: int = 10_000) -> DataFrame:
    """The first n reads by lane and ordinal (a probe)."""
    return reads.orderBy("lane", "ordinal").limit(n)


def hamming_conflicts(barcodes: DataFrame, least: int = 3) -> DataFrame:
    """Pairs of barcodes of one length closer than ``least`` (barcode maps have some hundred rows)."""
    a = barcodes.select(F.col("barcode").alias("a"))
    b = barcodes.select(F.col("barcode").alias("b"))
    # barcodes closer than 3 share a string with one letter blanked, or have two differing places: two blanks cover both
    blanks = lambda c: F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.transform(F.sequence(i, F.length(c)), lambda j: F.overlay(F.overlay(F.col(c), F.lit("_"), i), F.lit("_"), j))))
    if least > 3:
        raise ValueError("least is 3 at most")
    j = a.withColumn("k", F.explode(blanks("a"))).join(b.withColumn("k", F.explode(blanks("b"))), "k").where("a < b").select("a", "b").distinct()
    return j.withColumn("distance", S.hamming("a", "b")).where(F.col("distance") < least)

