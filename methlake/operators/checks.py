"""Integrity constraints as queries of their violations: rule, key, detail. Good data give no rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methlake.functions import sequence as S
from methlake.functions import text as X


def violations(rows: DataFrame, rule: str, bad: Column, key: Column, detail: Column | None = None) -> DataFrame:
    return rows.where(F.coalesce(bad, F.lit(True))).select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def repeated(rows: DataFrame, rule: str, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(F.lit(rule).alias("rule"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"), F.col("_n").cast("string").alias("detail"))


def together(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def cpg_rows(cpg: DataFrame, contigs: DataFrame, base: int = 1) -> DataFrame:
    """Counts are whole and not negative, coverage 1..65535, contigs known, places inside them, no site twice."""
    j = cpg.join(F.broadcast(contigs.select("chrom", "len")), "chrom", "left")
    key = F.concat_ws(":", "sample_id", "chrom", F.col("pos").cast("string"))
    cov = F.col("methyl") + F.col("unmethyl")
    return together(
        violations(j, "unknown_contig", F.col("len").isNull(), key),
        violations(j, "position", (F.col("pos") < base) | (F.col("pos") >= F.coalesce("len", F.lit(2**62)) + base), key),
        violations(j, "coverage", (F.col("methyl") < 0) | (F.col("unmethyl") < 0) | (cov < 1) | (cov > 65535), key, cov),
        repeated(cpg, "repeated_site", "sample_id", "chrom", "pos"),
    )


def order_violations(rows: DataFrame) -> DataFrame:
    """Sites (sample_id, chrom, line, pos) not after the one on the line before."""
    from pyspark.sql import Window

    w = Window.partitionBy("sample_id", "chrom").orderBy("line")
    return rows.withColumn("before", F.lag("pos").over(w)).where("pos <= before").select("sample_id", "chrom", "line", "pos", "before")


def unique_ids(rows: DataFrame, key: str = "sample_id") -> DataFrame:
    return together(repeated(rows, "repeated_id", key), violations(rows, "blank_id", F.trim(F.coalesce(key, F.lit(""))) == "", F.coalesce(key, F.lit(""))))


def contig_rows(contigs: DataFrame) -> DataFrame:
    return together(repeated(contigs, "repeated_contig", "chrom"), violations(contigs, "contig_length", F.col("len") <= 0, F.col("chrom")))


def barcode_map(barcodes: DataFrame, lengths: tuple[int, ...] = (8, 10)) -> DataFrame:
    """Letters, lengths, uniqueness, and at least three differing places between barcodes of one length."""
    from methlake.operators.reads import hamming_conflicts

    near = hamming_conflicts(barcodes)
    return together(
        violations(barcodes, "letters", ~F.col("barcode").rlike("^[ACGT]+$"), F.col("barcode")),
        violations(barcodes, "length", ~F.length("barcode").isin(*lengths), F.col("barcode")),
        repeated(barcodes, "repeated_barcode", "barcode"), repeated(barcodes, "repeated_plate", "plate_id"), repeated(barcodes, "repeated_order", "cell_order"),
        near.select(F.lit("too_near").alias("rule"), F.concat_ws("|", "a", "b").alias("key"), F.col("distance").cast("string").alias("detail")),
    )


def manifest_rows(manifest: DataFrame, species: str, protocol: str) -> DataFrame:
    return together(
        violations(manifest, "species", F.col("species") != species, F.col("sample_id")), violations(manifest, "protocol", F.col("protocol") != protocol, F.col("sample_id")),
        violations(manifest, "identifier", ~X.safe_identifier("sample_id"), F.col("sample_id")), repeated(manifest, "repeated_id", "sample_id"), repeated(manifest, "repeated_raw", "dna_raw_sample"),
    )


def cell_identity(cells: DataFrame) -> DataFrame:
    """sample_id is project and plate, or project and barcode where there is no plate."""
    want = F.concat_ws("_", "project_sample_id", F.when(F.col("plate_id") != "", F.col("plate_id")).otherwise(F.col("dna_barcode")))
    return violations(cells, "cell_id", F.col("sample_id") != want, F.col("sample_id"), want)


def demux_accounting(report: DataFrame) -> DataFrame:
    """Fates add up to the usable reads, usable and short ones to the input, cells to the matched reads."""
    return together(
        violations(report, "usable", F.col("usable") != F.col("input") - F.col("short"), F.col("sample")),
        violations(report, "fates", F.col("assigned") + F.col("unmatched") + F.col("ambiguous") != F.col("usable"), F.col("sample")),
        violations(report, "cells", F.col("cell_reads") != F.col("assigned"), F.col("sample")),
    )


def generation_agreement(merged: DataFrame) -> DataFrame:
    return violations(merged, "project", ~F.col("agrees"), F.col("sample_id"), F.col("demux_project"))


def pair_funnel(pairs: DataFrame) -> DataFrame:
    """Each step keeps a part of the one before; final and removed pairs are the accepted ones without duplicates."""
    return together(
        violations(pairs, "negative", F.least("input_pairs", "trimmed_pairs", "accepted_pairs", "duplicate_pairs", "final_pairs") < 0, F.col("sample_id")),
        violations(pairs, "order", (F.col("trimmed_pairs") > F.col("input_pairs")) | (F.col("accepted_pairs") > F.col("trimmed_pairs")), F.col("sample_id")),
        violations(pairs, "closure", F.col("accepted_pairs") - F.col("duplicate_pairs") - F.col("removed_pairs") != F.col("final_pairs"), F.col("sample_id")),
    )


def high_cph_accounting(summary: DataFrame) -> DataFrame:
    return together(
        violations(summary, "rows", F.col("excluded_rows") + F.col("missing_rows") + F.col("metric_rows") != F.col("rows"), F.col("sample_id")),
        violations(summary, "flagged", (F.col("flagged_reads") > F.col("assessed_reads")) | (F.col("high_rows") > F.col("metric_rows")), F.col("sample_id")),
    )


def umi_accounting(sites: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "sample_id", "chrom", F.col("pos").cast("string"))
    called = F.col("methyl") + F.col("unmethyl")
    return together(violations(sites, "umis", called + F.col("merged") + F.col("ambiguous") != F.col("umis"), key), violations(sites, "order", (called > F.col("umis")) | (F.col("umis") > F.col("reads")), key))


def composition_rows(summary: DataFrame) -> DataFrame:
    parts = F.col("host_signals") + F.col("lambda_signals") + F.col("puc19_signals") + F.col("mt_signals")
    return violations(summary, "composition", parts > F.coalesce("total_signals", F.lit(0)), F.col("sample_id"))


def qc_domain(qc: DataFrame, may_miss: tuple[str, ...]) -> DataFrame:
    """Values outside 0..100 (0..1 for gini), and nulls where they are not allowed."""
    percents = [c for c in qc.columns if c.endswith("_pct")]
    out = [violations(qc, f"range:{c}", F.coalesce((F.col(c) < 0) | (F.col(c) > 100), F.lit(False)), F.col("sample_id"), F.col(c)) for c in percents]
    out += [violations(qc, f"missing:{c}", F.col(c).isNull(), F.col("sample_id")) for c in qc.columns if c not in may_miss]
    return together(*out, violations(qc, "range:gini", F.coalesce((F.col("gini") < 0) | (F.col("gini") > 1), F.lit(False)), F.col("sample_id"), F.col("gini")))


def tss_rows(profile: DataFrame) -> DataFrame:
    return together(repeated(profile, "repeated_key", "sample_id", "offset"), violations(profile, "fraction", (F.col("meth_frac") < 0) | (F.col("meth_frac") > 1) | ((F.col("methyl") == 0) != (F.col("meth_frac") == 0)), F.concat_ws("|", "sample_id", F.col("offset").cast("string"))))


def tss_bed(bins: DataFrame) -> DataFrame:
    return together(violations(bins, "gene", F.trim(F.coalesce("gene", F.lit(""))) == "", F.col("gene")), violations(bins, "bounds", (F.col("start") < 0) | (F.col("stop") <= F.col("start")), F.col("gene")), repeated(bins, "repeated_bin", "chrom", "start", "stop", "gene"))


def inventory(files: DataFrame) -> DataFrame:
    """Relative safe paths, unique, with a size and a SHA-256."""
    safe = F.col("path").rlike(r"^[A-Za-z0-9_.-]+(/[A-Za-z0-9_.-]+)*$") & ~F.col("path").rlike(r"(^|/)\.{1,2}(/|$)")
    return together(violations(files, "path", ~safe, F.col("path")), violations(files, "size", F.col("size_bytes") < 0, F.col("path")), violations(files, "digest", ~F.col("sha256").rlike("^[0-9a-f]{64}$"), F.col("path")), repeated(files, "repeated_path", "path"))


def mates(alignments: DataFrame) -> DataFrame:
    """Every name has one first and one second primary mate, both paired, on one contig if both are mapped."""
    primary = alignments.where(S.lacks_flags("flag", 256 | 2048))
    p = primary.groupBy("qname").agg(F.count_if(S.has_flag("flag", 64)).alias("a"), F.count_if(S.has_flag("flag", 128)).alias("b"), F.bool_and(S.has_flag("flag", 1)).alias("paired"))
    return violations(p, "mates", (F.col("a") != 1) | (F.col("b") != 1) | ~F.col("paired"), F.col("qname"))


def genes(rows: DataFrame) -> DataFrame:
    return together(violations(rows, "bounds", (F.col("g_start") < 0) | (F.col("g_end") <= F.col("g_start")), F.col("gene")), violations(rows, "strand", ~F.col("strand").isin("+", "-"), F.col("gene")), repeated(rows, "repeated_gene", "gene"))


def empty_when_unmapped(cells: DataFrame, cpg: DataFrame) -> DataFrame:
    """Cells without a mapped pair that have sites."""
    return cells.where("mapped = 0").join(cpg.select("sample_id").distinct(), "sample_id", "left_semi").select(F.lit("unmapped_with_sites").alias("rule"), F.col("sample_id").alias("key"), F.lit("").alias("detail"))


def read_groups(alignments: DataFrame, groups: DataFrame) -> DataFrame:
    """Alignments whose read group is not one of their sample's."""
    return alignments.join(groups.select("sample_id", "rg"), ["sample_id", "rg"], "left_anti").select(F.lit("read_group").alias("rule"), F.col("qname").alias("key"), F.col("rg").alias("detail"))


def config_rows(settings: DataFrame) -> DataFrame:
    """Settings of projects (project, coordinate_base, tss_fraction, protocol, high_cph_threshold) outside their domain; null means the default."""
    key = F.col("project")

    def outside(rule: str, bad: Column, detail: Column | None = None) -> DataFrame:
        return violations(settings, rule, F.coalesce(bad, F.lit(False)), key, detail)

    return together(
        outside("coordinate_base", ~F.col("coordinate_base").isin(0, 1), F.col("coordinate_base")), outside("tss_fraction", (F.col("tss_fraction") <= 0) | (F.col("tss_fraction") > 1)),
        outside("protocol", ~F.col("protocol").isin("cabernet", "taps", "droplet", "bismark"), F.col("protocol")), outside("high_cph_threshold", ~F.col("high_cph_threshold").between(0, 1)),
    )
