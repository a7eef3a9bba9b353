"""Queries of the manifest, set, ordering and delivery operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from methlake.functions import text as X
from methlake.functions.numbers import size_tier
from methlake.operators import checks as K
from methlake.operators import manifest as M
from methlake.operators import reads as R
from methlake.plans.registry import query

PROJECTS = "(select distinct project_sample_id from cells) p"
STATUS = "case when coalesce(reads, 0) = 0 then 'Zero_Output' when reads < 590 then 'Low_Reads_Removed' else 'Pass' end"


@query("C1_active_cells", "demux_cells", f"select sample_id from (select sample_id, {STATUS} st, cast(cell_order as bigint) % 3 k from demux_cells) x where st = 'Pass' and k <> 1")
def _(cells):
    from methlake.operators.qc import active_cells

    k = F.col("cell_order").cast("long") % 3
    full = cells.select("sample_id", M.cell_status("reads", 590).alias("dna_status"), F.lit("PASS").alias("analysis_status"), F.lit("PASS").alias("backend_qc_status"), F.when(k == 1, "").otherwise("x").alias("cpg_path"))
    return active_cells(full).select("sample_id")


@query("C11_status", "demux_cells", f"select sample_id, {STATUS} status from demux_cells")
def _(cells):
    return cells.withColumn("reads", F.coalesce("reads", F.lit(0))).select("sample_id", M.cell_status("reads", 590).alias("status"))


@query("D1_expand_cells", "cells barcode_map", f"select project_sample_id, b.barcode, b.plate_id, b.cell_order, project_sample_id || '_' || b.plate_id sample_id from {PROJECTS} cross join barcode_map b")
def _(cells, barcodes):
    return M.expand_cells(cells.select("project_sample_id").distinct(), barcodes)


@query("D1_expand_droplet_cells", "barcode_counts", "select project_sample_id, barcode, count, cast(row_number() over (partition by project_sample_id order by count desc, barcode) as string) cell_order, '' plate_id, project_sample_id || '_' || barcode sample_id from (select distinct 'P' || cast(c_custkey % 3 as string) project_sample_id, barcode, n count from barcode_counts) x")
def _(counts):
    called = counts.select(F.concat(F.lit("P"), (F.col("c_custkey") % 3).cast("string")).alias("project_sample_id"), "barcode", F.col("n").alias("count")).distinct()
    return M.expand_droplet_cells(called.select("project_sample_id").distinct(), called)


BODY = f"select project_sample_id, sample_id, plate_id, cell_order, cast(coalesce(reads, 0) as bigint) reads, {STATUS} status from demux_cells"


@query("E36_demux_summary_row", "demux_cells", f"with b as ({BODY}) select * from b union all select '__SUMMARY__', '', '', '', cast(coalesce(sum(reads), 0) as bigint), '' from b")
def _(cells):
    return M.demux_manifest(cells, 590)


@query("E13_cell_counts", "demux_cells reads", "select c.sample_id, coalesce(n, 0) reads from (select distinct sample_id from demux_cells) c left join (select 'S' || cast(ordinal % 60 as string) sample_id, count(*) n from reads group by 1) r on r.sample_id = c.sample_id")
def _(cells, reads):
    return R.cell_counts(cells, reads.select(F.concat(F.lit("S"), (F.col("ordinal") % 60).cast("string")).alias("sample_id")))


@query("D15_demux_generations", "cells demux_cells", f"select c.sample_id, c.project_sample_id, d.project_sample_id demux_project, reads, status, coalesce(d.project_sample_id = c.project_sample_id, true) agrees from cells c left join (select *, from ({BODY}) x where cast(cell_order as bigint) % 7 <> 0) d on c.sample_id = d.sample_id".replace("select *, from", "select * from"))
def _(cells, demux):
    d = M.demux_manifest(demux, 590).where("project_sample_id <> '__SUMMARY__' and cast(cell_order as bigint) % 7 <> 0")
    return M.merge_generations(cells.select("sample_id", "project_sample_id"), d)


@query("J18_final_manifest", "cells demux_cells pairs", f"select c.sample_id, c.project_sample_id, c.plate_id, d.cell_order, d.reads, d.status, case when p.protocol <> 'taps' then p.input_pairs end input_pairs, case when p.protocol <> 'taps' then p.flagged_pairs end flagged_pairs, case when p.protocol = 'taps' then p.mapping_pct end mapping_pct from cells c left join ({BODY}) d on c.sample_id = d.sample_id left join pairs p on p.sample_id = c.sample_id")
def _(cells, demux, pairs):
    base = cells.select("sample_id", "project_sample_id", "plate_id").join(demux.select("sample_id", "cell_order"), "sample_id")
    d = M.demux_manifest(demux, 590).where("project_sample_id <> '__SUMMARY__'")
    metrics = [pairs.where("protocol <> 'taps'").select("sample_id", "input_pairs", "flagged_pairs"), pairs.where("protocol = 'taps'").select("sample_id", "mapping_pct")]
    return M.final_manifest(base, d, metrics)


@query("D16_cell_metrics", "cells pairs", "select c.sample_id, c.clone_id, case when p.input_pairs % 2 = 0 then coalesce(p.mapping_pct, c.s_acctbal) else c.s_acctbal end s_acctbal, case when p.input_pairs % 2 = 0 then p.input_pairs end input_pairs from cells c left join pairs p on c.sample_id = p.sample_id")
def _(cells, pairs):
    metrics = pairs.where("input_pairs % 2 = 0").select("sample_id", "input_pairs", F.col("mapping_pct").alias("s_acctbal"))
    return M.attach_metrics(cells.select("sample_id", "clone_id", F.col("s_acctbal").cast("double").alias("s_acctbal")), metrics)


@query("D17_map_fastq", "cells", "select sample_id, 'raw' || cast(s_suppkey as string) dna_raw_sample, 'f' || cast(s_suppkey as string) path from cells where s_suppkey % 4 <> 1")
def _(cells):
    raw = F.concat(F.lit("raw"), F.col("s_suppkey").cast("string")).alias("dna_raw_sample")
    return M.map_fastq(cells.select("sample_id", raw), cells.where("s_suppkey % 4 <> 1").select(raw, F.concat(F.lit("f"), F.col("s_suppkey").cast("string")).alias("path")))


@query("D17_missing_fastq", "cells", "select sample_id, 'raw' || cast(s_suppkey as string) dna_raw_sample from cells where s_suppkey % 4 = 1")
def _(cells):
    raw = F.concat(F.lit("raw"), F.col("s_suppkey").cast("string")).alias("dna_raw_sample")
    return M.missing_fastq(cells.select("sample_id", raw), cells.where("s_suppkey % 4 <> 1").select(raw))


@query("D18_refresh_manifest", "cells", "select coalesce(a.sample_id, b.sample_id) sample_id, a.project_sample_id, case when a.sample_id is not null and b.sample_id is not null then 'kept' when a.sample_id is not null then 'lost' else 'new' end status from (select * from cells where s_suppkey % 3 <> 0) a full join (select * from cells where s_suppkey % 5 <> 0) b on a.sample_id = b.sample_id")
def _(cells):
    return M.refresh(cells.where("s_suppkey % 3 <> 0").select("sample_id", "project_sample_id"), cells.where("s_suppkey % 5 <> 0").select("sample_id"))


@query("D19_dna_rna_link", "cells", "select a.sample_id, b.sample_id rna from cells a join cells b on a.plate_id = b.plate_id and a.s_suppkey = b.s_suppkey - 96")
def _(cells):
    b = cells.select("plate_id", (F.col("s_suppkey") - 96).alias("s_suppkey"), F.col("sample_id").alias("rna"))
    return cells.select("sample_id", "plate_id", "s_suppkey").join(b, ["plate_id", "s_suppkey"]).select("sample_id", "rna")


@query("D20_index_value_map", "cells pairs", "select c.sample_id, p.cph_pct from cells c left join pairs p on c.sample_id = p.sample_id")
def _(cells, pairs):
    return cells.select("sample_id").join(pairs.select("sample_id", "cph_pct"), "sample_id", "left")


@query("D21_reindex", "cells", "select sample_id, clone_id from cells")
def _(cells):
    from methlake.operators.intervals import exact_id_join

    return exact_id_join(cells.select("sample_id").orderBy(F.desc("sample_id")), cells.select("sample_id", "clone_id"), "sample_id")


@query("F11_sequence_numbering", "cells", "select sample_id, cast(row_number() over (partition by project_sample_id order by sample_id) as int) cell_order from cells")
def _(cells):
    from pyspark.sql import Window

    return cells.select("sample_id", F.row_number().over(Window.partitionBy("project_sample_id").orderBy("sample_id")).alias("cell_order"))


#: plate places as manifests have them: signed, padded and plain numbers, numbers beyond 64 bits, wells and other names
PLACES = """select case c_custkey % 7 when 0 then cast(c_custkey as string) when 1 then concat('-', cast(c_custkey as string)) when 2 then concat('00', cast(c_custkey as string)) when 3 then concat('+', cast(c_custkey as string))
    when 4 then concat('99999999999999', cast(100000 + c_custkey as string)) when 5 then concat(substr('ABCDEFGH', cast(c_custkey % 8 + 1 as int), 1), cast(c_custkey % 12 + 1 as string)) else concat(cast(c_custkey as string), 'z') end x from barcode_counts"""


@query("F12_cell_order", "barcode_counts", f"select x, row_number() over (order by try_cast(x as bigint) is null, try_cast(x as bigint), x) - 1 place from ({PLACES}) p")
def _(counts):
    return M.numbered(counts.sparkSession.sql(PLACES.replace("from barcode_counts", "from {counts}"), counts=counts), *X.natural_order("x"))


@query("G1_barcode_order", "barcode_counts", "select barcode, n, row_number() over (order by n desc, barcode, c_custkey) - 1 place from barcode_counts")
def _(counts):
    return M.numbered(counts, F.desc("n"), "barcode", "c_custkey").select("barcode", "n", "place")


@query("G10_original_order", "reads", "select id, row_number() over (order by lane, ordinal) - 1 place from reads")
def _(reads):
    # rows come back from parallel work in any order; lane and ordinal, carried along, restore it
    return M.numbered(reads.repartition(13, "seq"), "lane", "ordinal").select("id", "place")


@query("G2_manifest_order", "demux_cells", "select sample_id from demux_cells order by project_sample_id, try_cast(cell_order as bigint), plate_id, sample_id")
def _(cells):
    return M.ordered(cells).select("sample_id")


@query("G4_report_sample", "cells", "select sample_id from cells order by sha256(sample_id), sample_id limit 20")
def _(cells):
    return M.report_sample(cells, 20).select("sample_id")


@query("G8_probe", "reads", "select ordinal, id from reads order by lane, ordinal limit 100")
def _(reads):
    return R.sampled_pairs(reads, 100).select("ordinal", "id")


@query("H2_sort_u_names", "bsconv", "select distinct sample_id from bsconv")
def _(rows):
    return rows.select("sample_id").distinct()


@query("H3_set_difference", "cells", "select sample_id, case when s_suppkey % 2 = 0 then 'missing' else 'extra' end side from cells where (s_suppkey % 2 = 0) <> (s_suppkey % 3 = 0)")
def _(cells):
    return M.set_differences(cells.where("s_suppkey % 2 = 0"), cells.where("s_suppkey % 3 = 0"), "sample_id")


@query("H4_whitelist", "barcode_counts", "select distinct barcode from barcode_counts where barcode in (select barcode from barcode_counts where c_custkey % 2 = 0)")
def _(counts):
    return R.in_design(counts.select("barcode").distinct(), counts.where("c_custkey % 2 = 0"))


@query("H6_concat_frames", "cells", "select sample_id from cells union all select sample_id from cells where s_suppkey % 2 = 0")
def _(cells):
    return cells.select("sample_id").unionByName(cells.where("s_suppkey % 2 = 0").select("sample_id"))


@query("H7_column_union", "pairs", "select sample_id, case when protocol = 'taps' then cph_pct end cph_pct, case when protocol <> 'taps' then flagged_pairs end flagged_pairs from pairs")
def _(pairs):
    return pairs.where("protocol = 'taps'").select("sample_id", "cph_pct").unionByName(pairs.where("protocol <> 'taps'").select("sample_id", "flagged_pairs"), allowMissingColumns=True)


@query("H8_keep_last", "umi_obs", "select sample_id, chrom, pos, umi, readpos from (select *, row_number() over (partition by sample_id, chrom, pos order by readpos desc, umi desc, qual desc) r from umi_obs) x where r = 1")
def _(obs):
    return M.last_by(obs, ["sample_id", "chrom", "pos"], ["readpos", "umi", "qual"]).select("sample_id", "chrom", "pos", "umi", "readpos")


@query("E35_cell_set_digest", "cells", "select project_sample_id, sha256(string_agg(sample_id, chr(10) order by sample_id) || chr(10)) digest from cells group by 1")
def _(cells):
    return M.id_set_digests(cells, "project_sample_id", "sample_id")


@query("I20_short_labels", "pairs", """with p as (select 'run_' || sample_id || '_x' v, * from pairs), k as (select unnest(generate_series(0, (select min(length(v)) from p))) k),
    h as (select max(k) h from k where (select count(distinct substr(v, 1, k)) from p) = 1), t as (select max(k) t from k where (select count(distinct right(v, k)) from p) = 1)
    select v, case when h + t < (select min(length(v)) from p) then substr(v, h + 1, length(v) - h - t) else v end label from p, h, t""")
def _(pairs):
    return M.short_labels(pairs.select(F.concat(F.lit("run_"), "sample_id", F.lit("_x")).alias("v")), "v")


@query("B13_report_section", "pairs", "select 'funnel' id, sample_id key, cast(to_json({'input_pairs': input_pairs, 'final_pairs': final_pairs}) as varchar) \"value\" from pairs")
def _(pairs):
    return M.report_section(pairs, "funnel", "sample_id", ["input_pairs", "final_pairs"])


@query("J21_restrict_section", "pairs cells", "select 'funnel' id, '{' || string_agg('\"' || sample_id || '\":' || cast(to_json({'input_pairs': input_pairs}) as varchar), ',' order by sample_id) || '}' \"data\" from pairs where sample_id in (select sample_id from cells order by sha256(sample_id), sample_id limit 15)")
def _(pairs, cells):
    return M.section_json(M.restrict_section(M.report_section(pairs, "funnel", "sample_id", ["input_pairs"]), M.report_sample(cells, 15)))


@query("J22_append_plan", "reads", "select sample, mate, segment, path, cast(row_number() over (partition by sample, mate order by segment, path) as int) step, count(*) over (partition by sample, mate, digest) > 1 repeated from (select 's' || cast(ordinal % 40 as string) sample, cast(ordinal % 2 + 1 as string) mate, 'L' || cast(ordinal % 7 as string) segment, id path, substr(seq, 1, 8) digest from reads) x")
def _(reads):
    x = reads.selectExpr("concat('s', cast(ordinal % 40 as string)) sample", "cast(ordinal % 2 + 1 as string) mate", "concat('L', cast(ordinal % 7 as string)) segment", "id path", "substr(seq, 1, 8) sha256")
    return M.append_plan(x).drop("sha256")


NAMES = "select 'in/S' || cast(s_suppkey as string) || case when s_suppkey % 2 = 0 then '_L00' || cast(s_suppkey % 4 as string) else '' end"


@query("A6_fastq_discovery", "cells", f"with f as ({NAMES} || '_R1.fastq.gz' p, 'S' || cast(s_suppkey as string) sample, case when s_suppkey % 2 = 0 then 'L00' || cast(s_suppkey % 4 as string) else '' end segment, 1 m from cells union all {NAMES} || '_R2.fastq.gz', 'S' || cast(s_suppkey as string), case when s_suppkey % 2 = 0 then 'L00' || cast(s_suppkey % 4 as string) else '' end, 2 from cells where s_suppkey % 9 <> 0) select sample, segment, max(case when m = 1 then p end) r1, max(case when m = 2 then p end) r2 from f group by 1, 2")
def _(cells):
    stem = F.expr("concat('in/S', cast(s_suppkey as string), case when s_suppkey % 2 = 0 then concat('_L00', cast(s_suppkey % 4 as string)) else '' end)")
    files = cells.select(F.concat(stem, F.lit("_R1.fastq.gz")).alias("path")).unionByName(cells.where("s_suppkey % 9 <> 0").select(F.concat(stem, F.lit("_R2.fastq.gz")).alias("path")))
    return M.fastq_groups(files)


@query("J24_retained_files", "demux_cells", f"select sample_id || '.' || k path from ({BODY}) b, (values ('bam'), ('bai')) t(k) where status = 'Pass'")
def _(cells):
    return M.retained_files(M.demux_manifest(cells, 590), ["bam", "bai"])


@query("J24_stale_files", "demux_cells", f"select sample_id || '.bam' path from demux_cells where sample_id not in (select sample_id from ({BODY}) b where status = 'Pass')")
def _(cells):
    return M.stale_files(cells.select(F.concat("sample_id", F.lit(".bam")).alias("path")), M.retained_files(M.demux_manifest(cells, 590), ["bam"]))


@query("J23_dependency_closure", "cells", "with recursive e as (select s_suppkey a, s_suppkey * 2 + 1 b from cells union select s_suppkey, s_suppkey + 10 from cells where s_suppkey % 3 = 0), c(x) as (select 1 union select b from c join e on e.a = c.x) select cast(x as string) name from c where x < 1000000")
def _(cells):
    e = cells.selectExpr("cast(s_suppkey as string) source", "cast(s_suppkey * 2 + 1 as string) target").union(cells.where("s_suppkey % 3 = 0").selectExpr("cast(s_suppkey as string)", "cast(s_suppkey + 10 as string)"))
    return M.dependency_closure(e, cells.where("s_suppkey = 1").selectExpr("cast(s_suppkey as string) name"))


@query("I28_size_tier", "pairs", "select sample_id, case when input_pairs <= 12000 then 'S' when input_pairs <= 12500 then 'M' when input_pairs <= 13000 then 'L' else 'XL' end tier from pairs")
def _(pairs):
    return pairs.select("sample_id", size_tier("input_pairs", 12000, 12500, 13000).alias("tier"))


@query("N2_unique_ids", "cpg", "select 'repeated_id' rule, sample_id key, cast(count(*) as string) detail from (select distinct sample_id, chrom from cpg) x group by sample_id having count(*) > 1")
def _(cpg):
    return K.unique_ids(cpg.select("sample_id", "chrom").distinct())


@query("N4_barcode_map", "barcode_map", """with p as (select a.barcode a, b.barcode b, hamming(a.barcode, b.barcode) d from barcode_map a join barcode_map b on a.barcode < b.barcode)
    select 'repeated_barcode' rule, barcode key, cast(count(*) as string) detail from barcode_map group by barcode having count(*) > 1 union all select 'too_near', a || '|' || b, cast(d as string) from p where d < 3 group by a, b, d""")
def _(barcodes):
    return K.barcode_map(barcodes)


@query("N5_manifest", "cells", "select 'protocol' rule, sample_id key, '' detail from cells where protocol <> 'taps'")
def _(cells):
    rows = cells.select("sample_id", F.lit("hg38").alias("species"), "protocol", F.col("sample_id").alias("dna_raw_sample"))
    return K.manifest_rows(rows, "hg38", "taps")


@query("N6_cell_id", "cells", "select 'cell_id' rule, sample_id key, project_sample_id || '_' || plate_id detail from cells")
def _(cells):
    return K.cell_identity(cells.withColumn("dna_barcode", F.lit("")))


@query("N7_demux_accounting", "pairs", "select 'usable' rule, sample_id key, '' detail from pairs where input_pairs % 2 = 1")
def _(pairs):
    r = pairs.selectExpr("sample_id sample", "input_pairs input", "10L short", "input_pairs - 10 - input_pairs % 2 usable", "5L ambiguous", "7L unmatched", "input_pairs - 22 - input_pairs % 2 assigned", "input_pairs - 22 - input_pairs % 2 cell_reads")
    return K.demux_accounting(r)


@query("N8_route_agreement", "cells demux_cells", "select 'project' rule, sample_id key, case when s_suppkey % 6 = 0 then 'other' else project_sample_id end detail from cells where s_suppkey % 6 = 0")
def _(cells, demux):
    d = M.demux_manifest(demux, 590).where("project_sample_id <> '__SUMMARY__'").withColumn("project_sample_id", F.expr("case when cast(cell_order as bigint) % 6 = 0 then 'other' else project_sample_id end"))
    return K.generation_agreement(M.merge_generations(cells.select("sample_id", "project_sample_id"), d))


@query("N16_inventory", "cells", "select 'path' rule, case when s_suppkey % 5 = 0 then '../' else 'a/' end || sample_id key, '' detail from cells where s_suppkey % 5 = 0 union all select 'size', case when s_suppkey % 5 = 0 then '../' else 'a/' end || sample_id, '' from cells where s_suppkey % 7 = 0")
def _(cells):
    return K.inventory(cells.selectExpr("concat(case when s_suppkey % 5 = 0 then '../' else 'a/' end, sample_id) path", "case when s_suppkey % 7 = 0 then -1L else 5L end size_bytes", "sha2(sample_id, 256) sha256"))


@query("N19_config", "cells", """select 'coordinate_base' rule, sample_id key, cast(s_suppkey % 4 as string) detail from cells where s_suppkey % 4 > 1 union all select 'tss_fraction', sample_id, '' from cells where s_suppkey % 5 = 0 or s_suppkey % 5 > 2
    union all select 'protocol', sample_id, 'other' from cells where s_suppkey % 7 = 0 union all select 'high_cph_threshold', sample_id, '' from cells where s_suppkey % 3 = 2""")
def _(cells):
    return K.config_rows(cells.selectExpr("sample_id project", "cast(s_suppkey % 4 as int) coordinate_base", "(s_suppkey % 5) / 2.0D tss_fraction", "if(s_suppkey % 7 = 0, 'other', 'taps') protocol", "(s_suppkey % 3) / 1.5D high_cph_threshold"))
