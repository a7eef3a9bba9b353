"""Functions on reads: ids, qualities, distances, contexts, keys. All are column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def read_id(x) -> Column:
    """Read id: up to the first space, without one /1 or /2 at its end; empty becomes null."""
    return F.nullif(F.regexp_replace(F.substring_index(_c(x), " ", 1), "/[12]$", ""), F.lit(""))


def letters(x) -> Column:
    """Array of the letters of a string."""
    return F.filter(F.split(_c(x), ""), lambda a: a != "")


def hamming(a, b) -> Column:
    """Differing places of two strings of one length, null for two lengths."""
    same = F.zip_with(letters(a), letters(b), lambda x, y: (x != y).cast("int"))
    return F.when(F.length(_c(a)) == F.length(_c(b)), F.aggregate(same, F.lit(0), lambda s, x: s + x))


def folded(x, bisulfite: bool) -> Column:
    """Bases for comparison: as they are in upper case, or with G (and g) read as A for bisulfite reads."""
    return F.translate(_c(x), "Gg", "AA") if bisulfite else F.upper(_c(x))


def folded_distance(a, b, bisulfite: bool) -> Column:
    """Hamming distance after folding plus the difference of lengths."""
    x, y = folded(a, bisulfite), folded(b, bisulfite)
    n = F.least(F.length(x), F.length(y))
    return F.coalesce(hamming(F.substring(x, F.lit(1), n), F.substring(y, F.lit(1), n)), F.lit(0)) + F.abs(F.length(x) - F.length(y))


def reverse_complement(x) -> Column:
    return F.translate(F.reverse(_c(x)), "ACGTacgt", "TGCAtgca")


def cytosine_context(triple) -> Column:
    """CpG, CHG or CHH of a reference triple that starts with C, else null."""
    t = F.upper(_c(triple))
    return F.when(t.rlike("^CG"), "CpG").when(t.rlike("^C[ACT]G"), "CHG").when(t.rlike("^C[ACT][ACT]"), "CHH")


def molecule_key(umi, insert) -> Column:
    """umi and the first 32 bases of the insert as one key; null if a base is not A, C, G or T or the insert is short."""
    k = F.concat(_c(umi), F.substring(_c(insert), 1, 32))
    return F.when((F.length(_c(insert)) >= 32) & k.rlike("^[ACGT]+$"), k)


def qualities(x) -> Column:
    """Phred values of a quality string (offset 33)."""
    return F.transform(letters(x), lambda a: F.ascii(a) - 33)


def trimmed(seq, qual, start) -> tuple[Column, Column]:
    """Sequence and qualities from a 0-based start on; one N with quality # where nothing is left."""
    left = F.length(_c(seq)) > start
    return F.when(left, F.substring(_c(seq), start + 1, F.length(_c(seq)))).otherwise("N"), F.when(left, F.substring(_c(qual), start + 1, F.length(_c(qual)))).otherwise("#")


def with_umi(name, umi) -> Column:
    return F.concat_ws(":", _c(name), _c(umi))


def umi_of(name) -> Column:
    """The last part of a name after a colon."""
    return F.substring_index(_c(name), ":", -1)


def neighbours(x, alphabet: str = "ACGT") -> Column:
    """Array of all strings one substitution away."""
    s = _c(x)

    def at(i: Column) -> Column:
        return F.transform(F.filter(F.array(*map(F.lit, alphabet)), lambda b: b != F.substring(s, i, F.lit(1))), lambda b: F.concat(F.substring(s, F.lit(1), i - 1), b, F.substring(s, i + 1, F.length(s))))

    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(s)), at))


def has_flag(flag, bits: int) -> Column:
    return _c(flag).bitwiseAND(bits) == bits


def lacks_flags(flag, bits: int) -> Column:
    return _c(flag).bitwiseAND(bits) == 0


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def fnv1a_shard(x, shards: int) -> Column:
    """64-bit FNV-1a of an ASCII text, modulo a number of shards. The hash is kept as two halves of 32 bits, so that no product leaves 64 bits."""
    # fixed values: offset basis and prime (2^40 + 435) of the hash
    basis, low_prime = 0xCBF29CE484222325, 435
    mask, low = F.lit(0xFFFFFFFF), F.lit(1 << 32)

    def step(h: Column, byte: Column) -> Column:
        xored = h["lo"].bitwiseXOR(byte)
        product = xored * low_prime
        carry = F.floor(product / low)
        return F.struct(product.bitwiseAND(mask).alias("lo"), (h["hi"] * low_prime + carry + xored * 256).bitwiseAND(mask).alias("hi"))

    codes = F.transform(letters(x), lambda c: F.ascii(c).cast("long"))
    start = F.struct(F.lit(basis & 0xFFFFFFFF).cast("long").alias("lo"), F.lit(basis >> 32).cast("long").alias("hi"))
    return F.aggregate(codes, start, step, lambda h: ((h["hi"] % shards) * ((1 << 32) % shards) + h["lo"]) % shards)
