"""Functions on texts and small documents: attributes, identifiers, labels, digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_identifier(x) -> Column:
    """Whether x is made of letters, digits, dot, underscore and hyphen and is not ``.`` or ``..``."""
    return _c(x).rlike(r"^[A-Za-z0-9_.-]+$") & ~_c(x).isin(".", "..")


def gtf_attribute(x, key: str) -> Column:
    """The quoted value of a GTF attribute, null if it has none."""
    return F.nullif(F.regexp_extract(_c(x), rf'(?:^|;\s*){key}\s+"([^"]*)"', 1), F.lit(""))


def vcf_format(keys, values) -> Column:
    """A sample's FORMAT fields as a map."""
    return F.map_from_arrays(F.split(_c(keys), ":"), F.split(_c(values), ":"))


def base_counts(x) -> Column:
    """``C3Y12`` as a map from base (A, C, G, T, Y, R) to count."""
    bases = F.regexp_extract_all(_c(x), F.lit("([ACGTYR])([0-9]+)"), F.lit(1))
    counts = F.regexp_extract_all(_c(x), F.lit("([ACGTYR])([0-9]+)"), F.lit(2))
    return F.map_from_arrays(bases, F.transform(counts, lambda n: n.cast("long")))


def natural_order(x) -> list[Column]:
    """Sort columns: whole numbers of 64 bits by value first, then other texts."""
    n = F.when(_c(x) == F.trim(_c(x)), _c(x).try_cast("long"))
    return [n.isNull(), n, _c(x)]


def lane(x) -> Column:
    """A lane number with two or more digits."""
    return F.lpad(_c(x).cast("string"), 2, "0")


def label(x) -> Column:
    """A trimmed label, null if it is blank."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


def file_safe(x) -> Column:
    """A name with what file systems refuse turned into underscores."""
    return F.regexp_replace(_c(x), r"[/\\:*?\"<>| ]", "_")


def sampling_digest(seed: int, x) -> Column:
    """SHA-256 of the JSON list of a seed and an id."""
    return F.sha2(F.concat(F.lit(f'[{seed}, "'), _c(x), F.lit('"]')), 256)
