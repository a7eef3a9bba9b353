"""Numeric functions: exact integers, packed counts, scales, ratios, tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_integer(x) -> Column:
    """A decimal text as a whole number: ``12.0`` is 12; ``1.5`` and other texts are null."""
    d = F.expr(f"try_cast({x} as decimal(38,9))") if isinstance(x, str) else x.try_cast("decimal(38,9)")
    return F.when(d == F.floor(d), d.cast("long"))


def grouped_count(x) -> Column:
    """A count as reports print it: thousands grouped by commas, a trailing ``(..%)`` left out; null if it is none."""
    t = F.trim(F.regexp_replace(_c(x), r"\s*\(.*\)\s*$", ""))
    plain = t.rlike("^[0-9]+$") | t.rlike("^[0-9]{1,3}(,[0-9]{3})+$")
    return F.when(plain, F.regexp_replace(t, ",", "").cast("long"))


def packed(methyl, unmethyl) -> Column:
    """methyl << 16 | coverage, null if the coverage is not 1..65535."""
    m, cov = _c(methyl).cast("long"), (_c(methyl) + _c(unmethyl)).cast("long")
    return F.when((cov >= 1) & (cov <= 65535), F.shiftleft(m, 16).bitwiseOR(cov))


def unpacked(x) -> tuple[Column, Column]:
    """(methyl, coverage) of a packed count."""
    return F.shiftright(_c(x), 16), _c(x).bitwiseAND(65535)


def quantised(x, digits: int = 6) -> Column:
    """x to a number of digits by floor(x*10^d + 0.50001)/10^d: plain arithmetic that all engines share, with halves (which sums reach from either side) going up."""
    f = float(10**digits)
    return F.floor(_c(x) * f + 0.50001) / F.lit(f)


def percentage(part, whole) -> Column:
    """100 * part / whole; 0 where whole is 0."""
    return F.coalesce(F.try_divide(F.lit(100.0) * _c(part), _c(whole)), F.lit(0.0))


def log_count(x) -> Column:
    return F.log10(_c(x) + 1)


def signed_log(x) -> Column:
    return F.signum(_c(x)) * F.log1p(F.abs(_c(x)))


def signed_exp(x) -> Column:
    return F.signum(_c(x)) * F.expm1(F.abs(_c(x)))


def humanised(x) -> Column:
    """1234567 -> 1.2M, 1234 -> 1.2K, smaller numbers with four significant digits at most."""
    v = _c(x)
    return F.when(F.abs(v) >= 1e6, F.format_string("%.1fM", v / 1e6)).when(F.abs(v) >= 1e3, F.format_string("%.1fK", v / 1e3)).otherwise(F.format_string("%.4g", v))


def size_tier(x, small: int, medium: int, large: int) -> Column:
    """S, M, L or XL by inclusive upper bounds."""
    v = _c(x)
    return F.when(v <= small, "S").when(v <= medium, "M").when(v <= large, "L").otherwise("XL")


def attempt_memory(first_mb, attempt) -> Column:
    """Memory of a job's first, second and later attempts: 1, 1.5 and 2 times, rounded up."""
    a = _c(attempt)
    return F.ceil(_c(first_mb) * F.when(a <= 1, 1.0).when(a == 2, 1.5).otherwise(2.0)).cast("long")
