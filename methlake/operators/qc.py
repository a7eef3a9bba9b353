"""The per-cell QC table and what is derived from it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from methlake import schemas
from methlake.functions.contigs import is_host
from methlake.functions.numbers import percentage
from methlake.functions.text import sampling_digest
from methlake.operators import cpg as C


def active_cells(cells: DataFrame) -> DataFrame:
    """Cells that passed demultiplexing, analysis and backend QC and have counts."""
    return cells.where("dna_status = 'Pass' and analysis_status = 'PASS' and backend_qc_status = 'PASS' and coalesce(cpg_path, '') <> ''")


def funnel(pairs: DataFrame) -> DataFrame:
    """Ratios of the read-pair funnel. Duplicates are null for droplets (their molecules are merged per site), CpH flags for TAPS."""
    return pairs.select(
        "sample_id", "clone_id", "plate_id", F.col("mapping_pct").alias("native_mapping_pct"), F.col("cph_pct").alias("non_cpg_pct"),
        percentage("trimmed_pairs", "input_pairs").alias("trim_retention_pct"),
        F.when(F.col("protocol") != "droplet", percentage("duplicate_pairs", "accepted_pairs")).alias("duplicate_pct"),
        percentage("final_pairs", "input_pairs").alias("final_yield_pct"),
        F.when(F.col("protocol") != "taps", percentage("flagged_pairs", "assessed_pairs")).alias("high_cph_pct"),
    )


def qc_table(cpg: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per cell of pairs with the 20 QC columns. The counts are read once: sums by bin are written, and give both the summary and the Gini index."""
    from methlake.operators.manifest import _cut

    sums = _cut(C.stretch_sums(cpg))
    return qc_rows(pairs, C.summary_of(sums, pairs), C.gini(C.bins_of(sums.where(is_host("chrom")))))


def qc_rows(pairs: DataFrame, summary: DataFrame, gini: DataFrame) -> DataFrame:
    """The QC table from its parts."""
    rates = summary.select("sample_id", F.col("host_sites").alias("unique_cpg_sites"), F.col("host_rate_pct").alias("cpg_rate_pct"), "lambda_sites", "lambda_rate_pct", "puc19_sites", "puc19_rate_pct")
    shares = C.composition(summary).drop("total_signals")
    out = funnel(pairs).join(rates, "sample_id", "left").join(shares, "sample_id", "left").join(gini, "sample_id", "left")
    return out.select(*schemas.QC_COLUMNS)


def filter_reasons(qc: DataFrame, mapping_min: float | None = None, lambda_max: float = 10.0, puc19_min: float = 90.0, sites_min: float = 500_000, gini_max: float = 0.5) -> DataFrame:
    """Pass flags of each criterion, the number and the names of those failed (``x_missing`` or ``x_threshold``; ``pass`` if none), and hq."""
    criteria = [("Lambda", "lambda_rate_pct", "<", lambda_max), ("pUC19", "puc19_rate_pct", ">", puc19_min), ("nCG", "unique_cpg_sites", ">", sites_min), ("Gini", "gini", "<", gini_max)]
    if mapping_min is not None:
        criteria.append(("Mapping", "native_mapping_pct", ">", mapping_min))

    def passed(column: str, sign: str, limit: float) -> Column:
        return F.coalesce(F.expr(f"{column} {sign} {limit!r}D"), F.lit(False))

    flags = [passed(c, s, x).alias(f"pass_{n.lower()}") for n, c, s, x in criteria]
    reasons = F.concat_ws(";", *[F.when(~passed(c, s, x), F.when(F.col(c).isNull(), f"{n}_missing").otherwise(f"{n}_threshold")) for n, c, s, x in criteria])
    failed = sum((~passed(c, s, x)).cast("int") for _, c, s, x in criteria)
    return qc.select("sample_id", "clone_id", "plate_id", *flags, F.lit(mapping_min is not None).alias("mapping_evaluated"), failed.alias("failed_criteria"), F.when(reasons == "", "pass").otherwise(reasons).alias("reasons"), (failed == 0).alias("hq"))


def tss_cells(qc: DataFrame, share: float = 0.1, seed: int = 0, small: int = 10, most: int = 100) -> DataFrame:
    """A fixed sample of cells per clone, by digest: all of clones under ``small``, else ceil(n * share), ``most`` at most."""
    if not 0 < share <= 1 or not math.isfinite(share):
        raise ValueError("share must be in (0, 1]")
    w = Window.partitionBy("clone_id")
    n = F.count("*").over(w)
    take = F.when((n < small) | F.lit(share == 1), n).otherwise(F.least(F.lit(most), F.ceil(n * share)))
    rank = F.row_number().over(w.orderBy(sampling_digest(seed, "sample_id"), "sample_id"))
    return qc.select("sample_id", "clone_id", rank.alias("rank"), take.cast("int").alias("take")).where("rank <= take").select("sample_id", "clone_id", "rank")


def clone_summary(qc: DataFrame, reasons: DataFrame) -> DataFrame:
    """Per clone: cells, passing cells, their share, median and mean of sites and rates."""
    j = qc.join(reasons.select("sample_id", "hq"), "sample_id")
    return j.groupBy("clone_id").agg(F.count("*").alias("cells"), F.sum(F.col("hq").cast("long")).alias("passing"), F.avg(F.col("hq").cast("double")).alias("passing_share"), F.median("unique_cpg_sites").alias("median_sites"), F.avg("unique_cpg_sites").alias("mean_sites"), F.median("cpg_rate_pct").alias("median_rate"), F.avg("gini").alias("mean_gini"))


def tree_export(qc: DataFrame, import_cutoff: int, pass_cutoff: int) -> DataFrame:
    """Cells with enough sites under the names that tree building uses; percent values become fractions."""
    return qc.where(F.col("unique_cpg_sites") >= import_cutoff).select("sample_id", F.col("unique_cpg_sites").alias("nCG"), (F.col("cpg_rate_pct") / 100).alias("mCG_frac"), (F.col("lambda_rate_pct") / 100).alias("lambda_frac"), (F.coalesce(F.col("signal_lambda_pct") / 100, F.lit(0.0)) + F.coalesce(F.col("signal_puc19_pct") / 100, F.lit(0.0))).alias("control_frac"), (F.col("unique_cpg_sites") > pass_cutoff).alias("pass_metQC"))


def density_frame(qc: DataFrame, pairs: DataFrame, composition: DataFrame) -> DataFrame:
    """QC with read pairs and signals; the three must hold the same cells."""
    from methlake.operators.intervals import exact_id_join

    j = exact_id_join(qc.select("sample_id", "clone_id", "unique_cpg_sites"), pairs.select("sample_id", "final_pairs"), "sample_id")
    return exact_id_join(j, composition.select("sample_id", "total_signals"), "sample_id")
