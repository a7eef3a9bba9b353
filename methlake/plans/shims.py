"""Driver tables turned into methylation-shaped inputs.

Every shim is one SELECT that means the same in Spark SQL and in DuckDB, so that an operator and its oracle start from
the same rows. ``{lineitem}`` and the like stand for the driver tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents".split()

#: (index, name, length) of the reference contigs used by the shims
CONTIGS = [(i, f"chr{i + 1}", 3_000_000 - 100_000 * i) for i in range(22)] + [
    (22, "chrX", 900_000),
    (23, "chrY", 500_000),
    (24, "chrM", 16_000),
    (25, "lambda", 48_502),
    (26, "pUC19", 2_686),
    (27, "chrUn_decoy", 10_000),
]


def kmer(expr: str, n: int, alphabet: str = "ACGT") -> str:
    """SQL for n letters from an integer's digits, least digit first."""
    b = len(alphabet)
    return "concat(" + ", ".join(f"substr('{alphabet}', cast(cast(floor(({expr}) / {float(b**i)}) as bigint) % {b} + 1 as int), 1)" for i in range(n)) + ")"


SHIMS: dict[str, str] = {
    "contigs": "select i, chrom, cast(len as bigint) len from (values " + ", ".join(f"({i}, '{c}', {n})" for i, c, n in CONTIGS) + ") as t(i, chrom, len)",
    "cells": """
        select concat('S', cast(s_suppkey as string)) sample_id, concat('P', cast(s_suppkey % 4 as string)) project_sample_id, n_name clone_id,
               concat(substr('ABCDEFGH', cast(cast(floor(s_suppkey / 12.0) as bigint) % 8 + 1 as int), 1), cast(s_suppkey % 12 + 1 as string)) plate_id,
               case s_suppkey % 3 when 0 then 'cabernet' when 1 then 'taps' else 'droplet' end protocol, s_suppkey, s_acctbal
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "cpg": """
        select sample_id, chrom, pos, cast(sum(m) as bigint) methyl, cast(sum(u) as bigint) unmethyl from (
            select concat('S', cast(l_suppkey as string)) sample_id, chrom, (l_orderkey * 37 + l_partkey * 11) % len + 1 pos,
                   cast(floor(l_quantity) as bigint) % 7 m, cast(floor(l_quantity) as bigint) % 5 u
            from {lineitem} join contigs on l_partkey % 28 = i) x
        group by sample_id, chrom, pos having sum(m) + sum(u) > 0""",
    "intervals": """
        select chrom, (p_partkey * 7919) % len start, (p_partkey * 7919) % len + 200 + p_size * 400 stop
        from {part} join contigs on p_partkey % 24 = i""",
    "genes": """
        select concat('G', cast(p_partkey as string)) gene, chrom, (p_partkey * 104729) % len g_start,
               (p_partkey * 104729) % len + 500 + p_size * 100 g_end, case when p_size % 2 = 0 then '+' else '-' end strand, len
        from {part} join contigs on p_partkey % 24 = i where p_partkey % 20 = 0""",
    "pairs": """
        select sample_id, protocol, clone_id, plate_id, n input_pairs, n - n % 7 trimmed_pairs, n - n % 7 - n % 11 accepted_pairs,
               cast(floor((n - n % 7 - n % 11) / 5.0) as bigint) duplicate_pairs,
               n - n % 7 - n % 11 - cast(floor((n - n % 7 - n % 11) / 5.0) as bigint) - n % 3 final_pairs,
               n % 3 removed_pairs, n - n % 7 assessed_pairs, n % 13 flagged_pairs, cast(100 as double) * (n % 17) / 17 cph_pct,
               cast(100 as double) * (n - n % 7 - n % 11) / n mapping_pct
        from (select sample_id, protocol, clone_id, plate_id, c * 20 + 40 + s_suppkey % 9 n
              from cells join (select l_suppkey, count(*) c from {lineitem} group by l_suppkey) l on s_suppkey = l_suppkey) x""",
    "barcode_map": f"""
        select barcode, concat(substr('ABCDEFGH', cast(cast(floor(k / 12.0) as bigint) % 8 + 1 as int), 1), cast(k % 12 + 1 as string)) plate_id, cast(k + 1 as string) cell_order
        from (select n_nationkey k, {kmer('n_nationkey * 2731 + 17', 8)} barcode from {{nation}}) x""",
    "reads": f"""
        select cast(1 as int) lane, o_orderkey ordinal, concat('read', cast(o_orderkey as string)) id,
               concat(substr(prefix, cast(1 + skip as int), 60), anchor, 'CCCCCCCCC', {kmer('o_orderkey * 7919 + o_custkey', 20)}) seq, kind
        from (select o_orderkey, o_custkey, o_orderkey % 8 kind, case when o_orderkey % 8 = 1 then 1 else 0 end skip,
                     case when o_orderkey % 8 = 2 then concat('T', bc) when o_orderkey % 8 = 3 then concat(substr(bc, 1, 3), 'A', substr(bc, 5, 4))
                          when o_orderkey % 8 = 4 then concat(substr(bc, 1, 6), 'N', substr(bc, 8, 1)) else bc end prefix,
                     case when o_orderkey % 8 = 5 then 'AGATGTATATAAGAAACAG' when o_orderkey % 8 = 6 then 'CTTTTTGTATAAGAGACAG' else 'AGATGTGTATAAGAGACAG' end anchor
              from (select o_orderkey, o_custkey, {kmer('(o_custkey % 25) * 2731 + 17', 8)} bc from {{orders}}) a) b""",
    "umi_obs": f"""
        select concat('S', cast(user_id % 20 as string)) sample_id, concat('chr', cast(event_id % 3 + 1 as string)) chrom, event_id % 97 pos,
               case event_id % 3 when 0 then 'CpG' when 1 then 'CHG' else 'CHH' end context, {kmer('user_id % 37', 3)} umi,
               case when event_type = 'click' or event_type = 'view' then 0 else 1 end state, cast(floor(abs(value)) as bigint) % 40 qual,
               case event_id % 4 when 0 then '1F' when 1 then '1R' when 2 then '2F' else '2R' end mate, event_id % 50 + 1 readpos, cast(60 as bigint) readlen
        from {{events}}""",
    "alignments": """
        select concat('q', cast(cast(floor(event_id / 2.0) as bigint) as string)) qname, concat('S', cast(cast(floor(event_id / 2.0) as bigint) % 20 as string)) sample_id,
               case when event_id % 2 = 0 then 64 else 128 end + 1
               + case when cast(floor(event_id / 2.0) as bigint) % 7 = 0 then 4 + 8 else 2 end
               + case when cast(floor(event_id / 2.0) as bigint) % 5 = 1 then 1024 else 0 end flag,
               concat('chr', cast(user_id % 4 + 1 as string)) rname, event_id % 5000 pos, event_id % 61 mapq, value
        from {events} where event_id < (select 2 * cast(floor(count(*) / 2.0) as bigint) from {events})""",
    "bsconv": """
        select concat('q', cast(event_id as string)) qname, concat('S', cast(user_id % 20 as string)) sample_id, event_id % 3 r0, 2 + event_id % 11 c0,
               event_id % 2 r1, 3 + event_id % 7 c1, event_id % 5 cg_r, event_id % 4 cg_c, event_id % 4 r2, event_id % 9 c2
        from {events}""",
    "variants": f"""
        select concat('chr', cast(p_partkey % 5 + 1 as string)) chrom, p_partkey * 3 pos, substr('ACGT', cast(p_partkey % 4 + 1 as int), 1) ref,
               substr('ACGT', cast(p_size % 4 + 1 as int), 1) alt, case when p_size % 5 = 0 then 'LOWQ' else 'PASS' end filters,
               p_size % 3 gt1, cast(floor(p_retailprice) as bigint) % 2 gt2, concat('S', cast(p_partkey % 20 as string)) sample_id,
               p_partkey % 9 + 1 sp_y, p_partkey % 6 sp_r, p_partkey % 14 cv
        from {{part}}""",
    "demux_cells": """
        select sample_id, project_sample_id, plate_id, cast(s_suppkey as string) cell_order, case when s_suppkey % 10 = 0 then 0 else c end reads
        from cells left join (select l_suppkey, count(*) c from {lineitem} group by l_suppkey) l on s_suppkey = l_suppkey""",
    "barcode_counts": f"""
        select {kmer('cast(floor(c_custkey / 2.0) as bigint) * 93 + c_custkey % 2', 17, 'AGT')} barcode, c_custkey, n, cast(floor(n / 4.0) as bigint) low_q20, cast(floor(n / 2.0) as bigint) high_q30
        from (select c_custkey, 90 + c_custkey % 60 + 1000 * (c_custkey % 5) n from {{customer}}) x""",
}

_DEPENDS = {k: [d for d in SHIMS if d != k and re.search(rf"\b(?:from|join) {d}\b", v)] for k, v in SHIMS.items()}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPENDS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_shims(names: list[str], braces: bool) -> str:
    """``with ... `` clause that defines the named shims and what they need."""
    text = ", ".join(f"{n} as ({SHIMS[n]})" for n in _closure(names))
    return "with " + (text if braces else text.format(**{t: t for t in TABLES}))


def _counted(sql: str) -> str:
    """sql with count_if(x), which is a HUGEINT in DuckDB, as a count of 64 bits."""
    while (at := sql.find("count_if(")) >= 0:
        depth, end = 1, at + 9
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}count(case when {sql[at + 9 : end - 1]} then 1 end){sql[end:]}"
    return sql


def oracle(names: str, body: str) -> str:
    """DuckDB SQL: body over the named shims (space separated)."""
    body = _counted(body)
    clause = with_shims(names.split(), braces=False) if names else ""
    body = body.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {clause[5:]}, {body[15:]}" if clause else body
    if body.lower().startswith("with "):
        return f"{clause}, {body[5:]}" if clause else body
    return f"{clause} {body}"


def shim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shim as a DataFrame."""
    text = with_shims([name], braces=True)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(f"{text} select * from {name}", **used)
