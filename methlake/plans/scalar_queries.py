"""Queries of the scalar functions and of the resource and report formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from methlake.functions import numbers as N
from methlake.functions import sequence as S
from methlake.functions import text as X
from methlake.plans.cpg_queries import q6, rounded
from methlake.plans.registry import query


@query("I1_read_id", "reads", "select ordinal, case when ordinal % 3 = 0 then 'r' || cast(ordinal as string) when ordinal % 3 = 1 then '@r/' || cast(ordinal as string) else 'r/1' end rid from reads")
def _(reads):
    raw = F.expr("case when ordinal % 3 = 0 then concat('r', cast(ordinal as string), '/1 lane x') when ordinal % 3 = 1 then concat('@r/', cast(ordinal as string), '/2') else 'r/1/1 other' end")
    return reads.select("ordinal", S.read_id(raw).alias("rid"))


@query("I2_hamming", "reads", "select ordinal, cast(hamming(substr(seq, 1, 8), substr(seq, 9, 8)) as int) d from reads")
def _(reads):
    return reads.select("ordinal", S.hamming(F.substring("seq", 1, 8), F.substring("seq", 9, 8)).alias("d"))


@query("I3_folded_distance", "reads", "select ordinal, cast(hamming(translate(substr(seq, 9, 19), 'Gg', 'AA'), translate('AGATGTGTATAAGAGACAG', 'Gg', 'AA')) as int) d from reads where length(seq) >= 28")
def _(reads):
    return reads.where(F.length("seq") >= 28).select("ordinal", S.folded_distance(F.substring("seq", 9, 19), F.lit("AGATGTGTATAAGAGACAG"), True).alias("d"))


@query("I6_reverse_complement", "reads", "select ordinal, translate(reverse(seq), 'ACGT', 'TGCA') rc from reads")
def _(reads):
    return reads.select("ordinal", S.reverse_complement("seq").alias("rc"))


@query("I7_context", "reads", "select t, count(*) n, case when substr(t, 1, 2) = 'CG' then 'CpG' when substr(t, 1, 1) = 'C' and substr(t, 2, 1) in ('A', 'C', 'T') and substr(t, 3, 1) = 'G' then 'CHG' when substr(t, 1, 1) = 'C' and substr(t, 2, 1) in ('A', 'C', 'T') and substr(t, 3, 1) in ('A', 'C', 'T') then 'CHH' end context from (select substr(seq, cast(ordinal % 20 + 1 as int), 3) t from reads) x group by t")
def _(reads):
    t = reads.select(F.expr("substr(seq, cast(ordinal % 20 + 1 as int), 3)").alias("t"))
    return t.groupBy("t").agg(F.count("*").alias("n")).select("t", "n", S.cytosine_context("t").alias("context"))


@query("I8_molecule_key", "reads", "select ordinal, case when length(substr(seq, 13)) >= 32 and regexp_full_match(substr(seq, 1, 12) || substr(seq, 13, 32), '[ACGT]+') then substr(seq, 1, 12) || substr(seq, 13, 32) end k from reads")
def _(reads):
    return reads.select("ordinal", S.molecule_key(F.substring("seq", 1, 12), F.expr("substr(seq, 13)")).alias("k"))


@query("I12_phred", "reads", "select ordinal, list_sum(list_transform(string_split(substr(seq, 1, 10), ''), lambda c: case when ascii(c) - 33 < 35 then 1 else 0 end))::bigint low from reads")
def _(reads):
    q = S.qualities(F.substring("seq", 1, 10))
    return reads.select("ordinal", F.aggregate(F.transform(q, lambda x: (x < 35).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("low"))


@query("I13_packed", "cpg", "select sample_id, chrom, pos, methyl * 65536 + methyl + unmethyl packed from cpg")
def _(cpg):
    return cpg.select("sample_id", "chrom", "pos", N.packed("methyl", "unmethyl").alias("packed"))


@query("I13_unpacked", "cpg", "select sample_id, cast(sum(methyl) as bigint) m, cast(sum(methyl + unmethyl) as bigint) c from cpg group by 1")
def _(cpg):
    m, c = N.unpacked("p")
    return cpg.select("sample_id", N.packed("methyl", "unmethyl").alias("p")).select("sample_id", m.alias("m"), c.alias("c")).groupBy("sample_id").agg(F.sum("m").cast("long").alias("m"), F.sum("c").cast("long").alias("c"))


@query("I16_base_counts", "variants", "select chrom, pos, sp_y y, sp_r r from variants where sp_r > 0")
def _(variants):
    b = X.base_counts(F.concat(F.lit("C9Y"), F.col("sp_y").cast("string"), F.lit("R"), F.col("sp_r").cast("string")))
    f = X.vcf_format(F.lit("GT:SP"), F.concat(F.lit("0/1:C9Y"), F.col("sp_y").cast("string"), F.lit("R"), F.col("sp_r").cast("string")))
    return variants.where("sp_r > 0").select("chrom", "pos", b["Y"].alias("y"), X.base_counts(f["SP"])["R"].alias("r"))


@query("I17_gtf_attribute", "genes", "select gene, case when strand = '+' then 'protein_coding' end kind from genes")
def _(genes):
    attributes = F.expr("""concat('gene_id "', gene, '"; ', case when strand = '+' then 'gene_type "protein_coding";' else 'level 2;' end)""")
    return genes.select(X.gtf_attribute(attributes, "gene_id").alias("gene"), X.gtf_attribute(attributes, "gene_type").alias("kind"))


@query("I18_json", "umi_obs", "select sample_id, cast(max(qual) as bigint) top from umi_obs group by 1")
def _(obs):
    j = obs.select(F.to_json(F.struct("sample_id", "qual")).alias("j")).select(F.from_json("j", "sample_id string, qual long").alias("r"))
    return j.groupBy("r.sample_id").agg(F.max("r.qual").alias("top"))


@query("I19_grouped_count", "pairs", "select sample_id, input_pairs n from pairs")
def _(pairs):
    return pairs.select("sample_id", N.grouped_count(F.concat(F.format_number("input_pairs", 0), F.lit(" (12.5%)"))).alias("n"))


@query("I21_humanised", "pairs", "select sample_id, printf('%.1fK', input_pairs / 1000.0) s from pairs where input_pairs >= 1000")
def _(pairs):
    return pairs.where("input_pairs >= 1000").select("sample_id", N.humanised("input_pairs").alias("s"))


@query("I22_log_count", "pairs", f"select sample_id, {q6('log10(input_pairs + 1)')} l, {q6('pow(10.0, log10(input_pairs + 1)) - 1')} back from pairs")
def _(pairs):
    return rounded(pairs.select("sample_id", N.log_count("input_pairs").alias("l"), (F.pow(F.lit(10.0), N.log_count("input_pairs")) - 1).alias("back")))


@query("I23_signed_log", "cells", f"select sample_id, {q6('case when s_acctbal < 0 then -1.0 else 1.0 end * ln(1 + abs(s_acctbal))')} l from cells")
def _(cells):
    return rounded(cells.select("sample_id", N.signed_log("s_acctbal").alias("l")))


@query("I24_resolve_contig", "cpg contigs", "select requested, chrom, len, n from (select case when pos % 2 = 0 then upper(chrom) else lower(chrom) end requested, count(*) n from cpg group by 1) r join contigs on lower(requested) = lower(chrom)")
def _(cpg, contigs):
    from methlake.functions.contigs import resolve_contig

    asked = cpg.groupBy(F.expr("case when pos % 2 = 0 then upper(chrom) else lower(chrom) end").alias("requested")).agg(F.count("*").alias("n"))
    return asked.join(contigs, resolve_contig(F.col("requested"))).select("requested", "chrom", "len", "n")


@query("I25_lane", "cells", "select sample_id, lpad(cast(s_suppkey % 12 as string), 2, '0') lane from cells")
def _(cells):
    return cells.select("sample_id", X.lane(F.col("s_suppkey") % 12).alias("lane"))


@query("I26_file_safe", "cells", "select sample_id, replace(replace(clone_id || ' a/b', ' ', '_'), '/', '_') safe from cells")
def _(cells):
    return cells.select("sample_id", X.file_safe(F.concat("clone_id", F.lit(" a/b"))).alias("safe"))


@query("I27_exact_integer", "cells", "select sample_id, case when s_suppkey % 2 = 0 then s_suppkey end v from cells")
def _(cells):
    return cells.select("sample_id", F.expr("concat(cast(s_suppkey as string), case when s_suppkey % 2 = 0 then '.0' else '.5' end)").alias("t")).select("sample_id", N.exact_integer("t").alias("v"))


@query("I29_trim", "reads", "select ordinal, case when length(seq) > 40 then substr(seq, 41) else 'N' end s, case when length(seq) > 40 then length(seq) - 40 else 1 end n from reads")
def _(reads):
    s, q = S.trimmed("seq", "seq", 40)
    return reads.select("ordinal", s.alias("s"), F.length(q).cast("long").alias("n"))


@query("I30_qname_umi", "reads", "select ordinal, id || ':' || substr(seq, 1, 12) q, substr(seq, 1, 12) umi from reads")
def _(reads):
    q = S.with_umi("id", F.substring("seq", 1, 12))
    return reads.select("ordinal", q.alias("q"), S.umi_of(q).alias("umi"))


@query("I31_attempt_memory", "cells", "select sample_id, cast(ceil(1001 * case s_suppkey % 3 + 1 when 1 then 1.0 when 2 then 1.5 else 2.0 end) as bigint) mb from cells")
def _(cells):
    return cells.select("sample_id", N.attempt_memory(F.lit(1001), F.col("s_suppkey") % 3 + 1).alias("mb"))


@query("I32_label", "cells", "select sample_id, case when s_suppkey % 4 = 0 then null else clone_id end label from cells")
def _(cells):
    return cells.select("sample_id", X.label(F.expr("case when s_suppkey % 4 = 0 then '  ' else concat(' ', clone_id, ' ') end")).alias("label"))


@query("I11_sha256", "cells", "select sample_id, sha256('[3, \"' || sample_id || '\"]') d from cells")
def _(cells):
    return cells.select("sample_id", X.sampling_digest(3, "sample_id").alias("d"))


@query("C19_alias_projection", "pairs", f"select sample_id CellID, {q6('cph_pct / 100')} CCC_frac, {q6('mapping_pct / 100')} MappingRate from pairs")
def _(pairs):
    return rounded(pairs.select(F.col("sample_id").alias("CellID"), (F.col("cph_pct") / 100).alias("CCC_frac"), (F.col("mapping_pct") / 100).alias("MappingRate")))


@query("C22_tissue", "pairs", "select sample_id, split_part(clone_id, '_', 1) tissue, mapping_pct > 50 mapping_valid from pairs")
def _(pairs):
    return pairs.select("sample_id", F.split_part("clone_id", F.lit("_"), F.lit(1)).alias("tissue"), (F.col("mapping_pct") > 50).alias("mapping_valid"))


@query("C18_report_source", "cells", "select sample_id || '_dupsifter.txt' p from cells where s_suppkey % 3 <> 0")
def _(cells):
    p = F.expr("concat(sample_id, case when s_suppkey % 3 = 0 then '_dup_report.txt' else '_dupsifter.txt' end)")
    return cells.select(p.alias("p")).where(F.col("p").rlike(r"_(dupsifter|cutadapt)\.(txt|json)$"))


@query("E33_trimming", "pairs", f"select sample_id, {q6('100.0 * cast(trimmed_pairs as double) / input_pairs')} kept_pct from pairs")
def _(pairs):
    return rounded(pairs.select("sample_id", N.percentage("trimmed_pairs", "input_pairs").alias("kept_pct")))


@query("C21_metric_aliases", "pairs", "select sample_id, input_pairs total_pairs, final_pairs kept_pairs from pairs")
def _(pairs):
    return pairs.select("sample_id", "input_pairs", "final_pairs").withColumnsRenamed({"input_pairs": "total_pairs", "final_pairs": "kept_pairs"})
