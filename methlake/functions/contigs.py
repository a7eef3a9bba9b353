"""Contig classes and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = r"^chr([1-9]|1[0-9]|2[0-2]|X|Y)$"
AUTOSOME = r"^chr([1-9]|1[0-9]|2[0-2])$"


def contig_class(chrom) -> Column:
    """host, lambda, pUC19, mt or auxiliary. lambda and pUC19 by exact case, mitochondrial names in any case."""
    c = F.col(chrom) if isinstance(chrom, str) else chrom
    return F.when(c.rlike(HOST), "host").when(c == "lambda", "lambda").when(c == "pUC19", "pUC19").when(F.lower(c).isin("chrm", "mt", "chrmt"), "mt").otherwise("auxiliary")


def is_host(chrom) -> Column:
    return (F.col(chrom) if isinstance(chrom, str) else chrom).rlike(HOST)


def is_autosome(chrom) -> Column:
    return (F.col(chrom) if isinstance(chrom, str) else chrom).rlike(AUTOSOME)


def pos0(pos, base: int = 1) -> Column:
    """0-based position of a position counted from base (0 or 1)."""
    return (F.col(pos) if isinstance(pos, str) else pos) - base


def interval_label(chrom, start, stop, base: int = 1) -> Column:
    """``chrom:start+base-stop`` of a 0-based half-open interval."""
    chrom, start, stop = (F.col(x) if isinstance(x, str) else x for x in (chrom, start, stop))
    return F.concat(chrom, F.lit(":"), (start + base).cast("string"), F.lit("-"), stop.cast("string"))


def resolve_contig(requested, known: str = "chrom") -> Column:
    """Join condition of a requested contig name with a known one, whatever the case."""
    return F.lower(requested) == F.lower(F.col(known))
