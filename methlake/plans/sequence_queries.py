"""Queries of the reference-sequence operators: contigs made of all documents' letters, written as FASTA with lines of any length and scanned into chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from methlake.operators import sequences as S
from methlake.plans.io_queries import place
from methlake.plans.registry import ORACLE_SQL, QUERIES
from methlake.sources import readers as IN

LETTERS = "regexp_replace(translate(coalesce(text, ''), 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,', 'ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTACGCG'), '[^ACGT]', 'N'{every})"
#: the contigs, their bases by place, and their chunks
BASE = f"""with seqs as (select 'c' || cast(doc_id % 2 as string) chrom, string_agg({LETTERS.format(every=", 'g'")}, '' order by doc_id) seq from documents group by 1),
    pos as (select chrom, unnest(string_split(seq, '')) base, cast(generate_subscripts(string_split(seq, ''), 1) - 1 as bigint) pos0 from seqs)"""
W = S.WIDTH


def chunks_of(source: str) -> str:
    return f"select chrom, k chunk, k * {W} \"start\", substr(seq, k * {W} + 1, {W + S.OVERLAP}) seq from (select chrom, seq, unnest(generate_series(0, cast(floor((length(seq) - 1) / {W}.0) as bigint))) k from {source}) x"


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("concat('c', cast(doc_id % 2 as string)) chrom", "doc_id", LETTERS.format(every="") + " value")
    heads = docs.select("chrom").distinct().select("chrom", F.lit(-1).cast("long").alias("doc_id"), F.concat(F.lit(">"), "chrom", F.lit(" made of texts")).alias("value"))
    path = place(spark)
    docs.unionByName(heads).repartitionByRange("chrom", "doc_id").sortWithinPartitions("chrom", "doc_id").select("value").write.text(path)
    return IN.fasta(spark, path, one=True)


def register(name: str, sql: str):
    def put(f):
        QUERIES[name] = lambda spark, sf_dir: f(spark, sf_dir, reference(spark, sf_dir))
        ORACLE_SQL[name] = sql
        return f

    return put


@register("A21_scan_fasta", f"{BASE} {chunks_of('seqs')}")
def _(spark, sf_dir, chunks):
    return chunks


@register("J14_cpg_intervals", f"{BASE} select chrom, pos0 \"start\", pos0 + 2 stop from (select *, lead(base) over (partition by chrom order by pos0) after from pos) x where base = 'C' and after = 'G'")
def _(spark, sf_dir, chunks):
    return S.cpg_intervals(chunks)


@register("D8_ref_lookup", f"{BASE} select o_orderkey, s.chrom, s.pos0, base, case base when 'C' then s.pos0 when 'G' then s.pos0 - 1 end cpg_start from (select o_orderkey, 'c' || cast(o_orderkey % 2 as string) chrom, o_orderkey * 7919 % 900000 pos0 from orders) s join pos on pos.chrom = s.chrom and pos.pos0 = s.pos0")
def _(spark, sf_dir, chunks):
    sites = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "concat('c', cast(o_orderkey % 2 as string)) chrom", "o_orderkey * 7919 % 900000 pos0")
    return S.reference_base(sites, chunks).select("o_orderkey", "chrom", "pos0", "base", "cpg_start")


MASKED = f"{BASE}, cut as (select chrom, string_agg(case when pos0 >= 17 and (pos0 - 17) % 1000 < 20 + (pos0 - (pos0 - 17) % 1000) % 700 or pos0 >= {W - 5} and (pos0 - {W - 5}) % {W} < 40 then 'N' else base end, '' order by pos0) seq from pos group by 1) {chunks_of('cut')}"


@register("J15_mask_reference", MASKED)
def _(spark, sf_dir, chunks):
    size = S.lengths(chunks)
    some = size.select("chrom", F.explode(F.sequence(F.lit(17), F.col("len"), F.lit(1000))).alias("start")).withColumn("stop", F.expr("start + 20 + start % 700"))
    borders = size.select("chrom", F.explode(F.sequence(F.lit(W - 5), F.greatest("len", F.lit(W)), F.lit(W))).alias("start")).withColumn("stop", F.expr("start + 40"))
    return S.masked(chunks, some.unionByName(borders))


def _spike(spark: SparkSession) -> DataFrame:
    return S.chunked(spark.createDataFrame([("lambda", 0, "ACGTN" * 2000), ("lambda", 10000, "ccg"), ("pUC19", 0, "TTTT")], "chrom string, at long, seq string"))


@register("J15_spike_in", f"{BASE} select chrom, cast(length(seq) as bigint) len from seqs union all values ('lambda', 10003), ('pUC19', 4)")
def _(spark, sf_dir, chunks):
    return S.lengths(S.appended(chunks, _spike(spark)))


@register("J15_fai_contract", f"{BASE} select chrom, case chrom when 'c0' then 'another length' else 'not in the index' end problem from seqs union all select 'cX', 'not in the sequence'")
def _(spark, sf_dir, chunks):
    listed = S.lengths(chunks).where("chrom <> 'c1'").selectExpr("chrom", "len + 1 len").unionByName(spark.createDataFrame([("cX", 5)], "chrom string, len long"))
    return S.fai_problems(chunks, listed)
