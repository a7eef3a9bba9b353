"""Reference sequences as chunks: chrom, chunk, start (0-based), seq.

Chunk k of a contig holds its bases from k * WIDTH on, WIDTH of them and OVERLAP more from the next chunk, so that a motif over a border is seen in the chunk where
it starts. No row, and no task, holds a contig. Places inside a chunk are read from bytes, whose access does not depend on the place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH, OVERLAP = 1 << 13, 1
#: lines that are numbered together
LINES = 1 << 10


def _bytes(seq: str | Column, at: Column, n) -> Column:
    return F.substring(F.col(seq).cast("binary") if isinstance(seq, str) else seq, at, n)


def chunked(pieces: DataFrame, width: int = WIDTH, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of pieces (chrom, at, seq): parts of contigs of any length with their places, which cover them without gaps or overlaps.

    Every piece goes to the chunks that it touches; a chunk gathers the pieces of its own bases.
    """
    p = pieces.where("length(seq) > 0").withColumn("stop", F.col("at") + F.length("seq"))
    first = F.greatest(F.floor((F.col("at") - overlap) / width), F.lit(0))
    p = p.withColumn("chunk", F.explode(F.sequence(first, F.floor((F.col("stop") - 1) / width))))
    low, high = F.col("chunk") * width, F.col("chunk") * width + width + overlap
    begin = F.greatest("at", low)
    part = _bytes("seq", (begin - F.col("at") + 1).cast("int"), (F.least("stop", high) - begin).cast("int")).cast("string")
    p = p.where(begin < F.least("stop", high)).select("chrom", "chunk", begin.alias("begin"), F.upper(part).alias("part"))
    rows = p.groupBy("chrom", "chunk").agg(F.array_sort(F.collect_list(F.struct("begin", "part"))).alias("x"))
    return rows.select("chrom", "chunk", (F.col("chunk") * width).alias("start"), F.array_join("x.part", "").alias("seq"))


def lengths(chunks: DataFrame, width: int = WIDTH) -> DataFrame:
    """chrom, len of each contig."""
    own = F.least(F.length("seq"), F.lit(width))
    return chunks.groupBy("chrom").agg(F.max(F.col("start") + own).alias("len"))


def cpg_intervals(chunks: DataFrame) -> DataFrame:
    """Every CG as [start, start+2): the prefix sums of the lengths between them, chunk by chunk."""
    places = F.expr("""aggregate(slice(gaps, 1, size(gaps) - 1), named_struct('at', start, 'out', cast(array() as array<bigint>)),
        (s, n) -> named_struct('at', s.at + n + 2, 'out', concat(s.out, array(s.at + n))), s -> s.out)""")
    found = chunks.select("chrom", "start", F.transform(F.split("seq", "CG"), F.length).alias("gaps")).select("chrom", F.explode(places).alias("start"))
    return found.withColumn("stop", F.col("start") + 2)


def reference_base(sites: DataFrame, chunks: DataFrame, width: int = WIDTH) -> DataFrame:
    """Sites (chrom, pos0) with the reference base and the CpG start they belong to (a G belongs to the C before it). Sites beyond a contig are left out.

    A site meets the chunk that it lies in.
    """
    j = sites.withColumn("chunk", F.floor(F.col("pos0") / width)).join(chunks.select("chrom", "chunk", F.col("start").alias("__start"), F.col("seq").alias("__seq")), ["chrom", "chunk"])
    base = _bytes("__seq", (F.col("pos0") - F.col("__start") + 1).cast("int"), F.lit(1)).cast("string")
    j = j.withColumn("base", base).where("base <> ''").drop("chunk", "__start", "__seq")
    return j.withColumn("cpg_start", F.when(F.col("base") == "C", F.col("pos0")).when(F.col("base") == "G", F.col("pos0") - 1))


def masked(chunks: DataFrame, intervals: DataFrame, width: int = WIDTH, overlap: int = OVERLAP) -> DataFrame:
    """Chunks with N over the intervals (chrom, start, stop). An interval goes to the chunks that it touches; a chunk gets one span for each start."""
    first, last = F.greatest(F.floor((F.col("start") - overlap) / width), F.lit(0)), F.floor((F.col("stop") - 1) / width)
    spans = intervals.where("start < stop and stop > 0").withColumn("chunk", F.explode(F.sequence(first, last)))
    low = F.col("chunk") * width
    spans = spans.select("chrom", "chunk", F.greatest(F.col("start") - low, F.lit(0)).cast("int").alias("b"), F.least(F.col("stop") - low, F.lit(width + overlap)).cast("int").alias("e")).where("b < e")
    spans = spans.groupBy("chrom", "chunk", "b").agg(F.max("e").alias("e")).groupBy("chrom", "chunk").agg(F.collect_list(F.struct("b", "e")).alias("spans"))

    def over(s: Column, x: Column) -> Column:
        n = F.least(x["e"], F.length(s)) - x["b"]
        return F.when(n > 0, F.overlay(s, F.repeat(F.lit("N"), n), x["b"] + 1, n)).otherwise(s)

    cut = F.aggregate(F.coalesce("spans", F.array()), F.col("seq"), over)
    return chunks.join(spans, ["chrom", "chunk"], "left").select("chrom", "chunk", "start", cut.alias("seq"))


def appended(chunks: DataFrame, spike_in: DataFrame) -> DataFrame:
    """Both references as one; a contig name that both have fails the job."""
    both = spike_in.select("chrom").distinct().join(chunks.select("chrom").distinct(), "chrom", "left_semi")
    clash = both.agg(F.max("chrom").alias("clash"))
    extra = spike_in.join(F.broadcast(clash)).withColumn("chrom", F.when(F.col("clash").isNull(), F.col("chrom")).otherwise(F.raise_error(F.concat(F.lit("contig in both references: "), "clash")).cast("string")))
    return chunks.select("chrom", "chunk", "start", "seq").unionByName(extra.select("chrom", "chunk", "start", "seq"))


def fai_problems(chunks: DataFrame, fai: DataFrame, width: int = WIDTH) -> DataFrame:
    """chrom, problem of contigs in which a sequence and its index (chrom, len) disagree."""
    j = lengths(chunks, width).join(fai.select("chrom", F.col("len").alias("listed")), "chrom", "full_outer")
    problem = F.when(F.col("len").isNull(), "not in the sequence").when(F.col("listed").isNull(), "not in the index").when(F.col("len") != F.col("listed"), "another length")
    return j.select("chrom", problem.alias("problem")).where("problem is not null")


def placed_lines(lines: DataFrame) -> DataFrame:
    """Pieces (chrom, at, seq) of FASTA lines (file, block, n, value), n counting up inside a block of a file.

    Places are prefix sums in two levels: inside each stretch of LINES lines of a block, as a block of a scan may be large, and over one row for each stretch. Lines before the first header of a file
    belong to no contig and are dropped.
    """
    lines = lines.withColumn("block", F.struct("block", F.floor(F.col("n") / LINES).alias("stretch")))
    text = F.rtrim("value")
    head = text.startswith(">")
    rows = lines.withColumn("name", F.when(head, F.split(F.substr(text, F.lit(2)), r"\s")[0])).withColumn("seq", F.when(~head, F.regexp_replace(text, r"\s", "")))
    rows = rows.withColumn("len", F.coalesce(F.length("seq"), F.lit(0)).cast("long"))
    inside = Window.partitionBy("file", "block").orderBy("n")
    rows = rows.withColumn("own", F.last("name", True).over(inside)).withColumn("end", F.sum("len").over(inside))
    since = F.coalesce(F.last(F.when(F.col("name").isNotNull(), F.col("end")), True).over(inside), F.lit(0))
    rows = rows.withColumn("at", F.col("end") - F.col("len") - since)
    blocks = rows.groupBy("file", "block").agg(F.max_by("own", "n").alias("name"), F.max_by(F.col("at") + F.col("len"), "n").alias("tail"))
    over = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # what a block starts with: the last header before it, and the bases of that contig up to it
    group = F.count("name").over(Window.partitionBy("file").orderBy("block"))
    blocks = blocks.withColumn("g", group).withColumn("before", F.last("name", True).over(over))
    blocks = blocks.withColumn("sum", F.sum("tail").over(Window.partitionBy("file", "g").orderBy("block")))
    blocks = blocks.withColumn("upto", F.lag("sum").over(Window.partitionBy("file").orderBy("block"))).select("file", "block", "before", F.coalesce("upto", F.lit(0)).alias("upto"))
    j = rows.where("len > 0").join(blocks, ["file", "block"])
    return j.select(F.coalesce("own", "before").alias("chrom"), F.when(F.col("own").isNull(), F.col("at") + F.col("upto")).otherwise(F.col("at")).alias("at"), "seq").where("chrom is not null")
