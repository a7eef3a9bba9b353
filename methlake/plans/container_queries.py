"""Queries that write a shim into the containers of sequencing tools and read it back in ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from methlake.plans.io_queries import place
from methlake.plans.registry import query
from methlake.plans.shims import CONTIGS, kmer
from methlake.sources import bam as B

#: alignments with bases: the tenth part of the reads is unmapped, odd ones have a clipped base
ROWS = f"""select qname, flag, case when k % 10 > 0 then rname end rname, case when k % 10 > 0 then pos end pos, mapq, case when k % 10 = 0 then '' when k % 2 = 1 then '1S10M' else '11M' end cigar,
    {kmer('k * 7919 + flag', 11)} seq, case when k % 7 > 0 then repeat(substr('ABCDEFGHI', cast(k % 9 + 1 as int), 1), 11) end qual, sample_id cell
    from (select *, cast(substr(qname, 2) as bigint) k from alignments) a"""


def _written(alignments) -> str:
    """A folder of sorted alignment files of ROWS."""
    ops = F.when(F.col("cigar") == "", F.array().cast("array<struct<op: int, len: int>>")).when(F.col("cigar") == "11M", F.expr("array(named_struct('op', 0, 'len', 11))")).otherwise(F.expr("array(named_struct('op', 4, 'len', 1), named_struct('op', 0, 'len', 10))"))
    rows = alignments.sparkSession.sql(ROWS.replace("from alignments", "from {alignments}"), alignments=alignments)
    rows = rows.select(
        "qname", F.col("flag").cast("int").alias("flag"), "rname", "pos", F.col("mapq").cast("int").alias("mapq"), ops.alias("cigar"), F.lit(None).cast("string").alias("rnext"), F.lit(None).cast("long").alias("pnext"),
        F.lit(0).alias("tlen"), "seq", "qual", F.create_map(F.lit("RG"), F.col("cell")).alias("tags"))
    path = place(alignments.sparkSession)
    B.write_bam(rows, path, [(name, size) for _, name, size in CONTIGS])
    return path


@query("A12_scan_bam", "alignments", ROWS)
def _(alignments):
    found = B.read_bam(alignments.sparkSession, _written(alignments), tags=True, split=1 << 16)
    cigar = F.array_join(F.transform("cigar", lambda c: F.concat(c["len"].cast("string"), F.when(c["op"] == 4, "S").otherwise("M"))), "")
    return found.select("qname", "flag", "rname", "pos", F.col("mapq").cast("long").alias("mapq"), cigar.alias("cigar"), "seq", "qual", F.col("tags")["RG"].alias("cell"))


@query("A13_scan_bam_contigs", "alignments", f"select rname, cell, count(*) n, min(pos) first, max(pos) last from ({ROWS}) r where rname in ('chr2', 'chr3') group by 1, 2")
def _(alignments):
    found = B.read_bam(alignments.sparkSession, _written(alignments), ["chr2", "chr3"], tags=True, split=1 << 16)
    return found.groupBy("rname", F.col("tags")["RG"].alias("cell")).agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))
