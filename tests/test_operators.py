"""Operators on small literal fixtures."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from methlake import schemas
from methlake.functions import numbers as N
from methlake.functions import sequence as S
from methlake.functions import text as X
from methlake.operators import alignments as A
from methlake.operators import checks as K
from methlake.operators import cpg as C
from methlake.operators import intervals as I
from methlake.operators import manifest as M
from methlake.operators import qc as Q
from methlake.operators import reads as R
from methlake.operators import stats as T

ANCHOR, DROP = R.PLATE_ANCHOR, R.DROPLET_ANCHOR


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.fixture(scope="module")
def cpg(spark):
    rows = [("S1", "chr1", 10, 1, 3), ("S1", "chr1", 11, 9, 3), ("S1", "chrM", 5, 0, 4), ("S1", "lambda", 7, 0, 9), ("S1", "pUC19", 8, 5, 0), ("S1", "chrUn_x", 3, 2, 2)]
    return spark.createDataFrame(rows, schemas.CPG)


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([("S1",), ("S2",)], "sample_id string")


@pytest.fixture(scope="module")
def contigs(spark):
    return spark.createDataFrame([("chr1", 2_500_000), ("chrY", 100), ("chrM", 100), ("lambda", 100), ("pUC19", 100), ("chrUn_x", 100)], schemas.CONTIGS)


def test_summary_means_fractions_and_keeps_empty_cells(spark, cpg, cells):
    r = {x.sample_id: x for x in C.cpg_summary(cpg, cells).collect()}
    assert (r["S1"].host_sites, r["S1"].host_rate_pct, r["S1"].total_sites, r["S1"].total_signals) == (2, 50.0, 6, 38)
    assert r["S1"].lambda_rate_pct == 0 and r["S1"].puc19_rate_pct == 100
    assert (r["S2"].host_sites, r["S2"].host_rate_pct, r["S2"].total_signals) == (0, None, 0)
    c = {x.sample_id: x for x in C.composition(C.cpg_summary(cpg, cells)).collect()}
    assert c["S2"].signal_host_pct == 0.0 and c["S1"].signal_host_pct == pytest.approx(100 * 16 / 38)


def test_interval_mean_is_not_pooled(spark, cpg):
    iv = spark.createDataFrame([("chr1", 9, 11), ("chr1", 10, 12), ("chr1", 500, 600)], schemas.INTERVALS)
    got = {(r.start, r.stop): (r.mean_fraction, r.cov, r.sites) for r in C.interval_means(cpg, iv).collect()}
    assert got == {(9, 11): (0.5, 16, 2), (10, 12): (0.75, 12, 1)}
    plan = I.interval_join(cpg.withColumn("pos0", F.col("pos") - 1), iv)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_random(spark):
    rng = random.Random(1)
    pts = [("chr%d" % rng.randrange(2), rng.randrange(3000)) for _ in range(300)]
    ivs = [("chr%d" % rng.randrange(2), a := rng.randrange(3000), a + rng.randrange(0, 700)) for _ in range(60)]
    got = I.interval_join(spark.createDataFrame(pts, "chrom string, pos0 long"), spark.createDataFrame(ivs, schemas.INTERVALS), width=100).select("chrom", "pos0", "start", "stop").collect()
    assert sorted(map(tuple, got)) == sorted((c, p, a, b) for c, p in pts for d, a, b in ivs if c == d and a <= p < b)


def test_chromosomes_windows_gini(spark, cpg, cells, contigs):
    rows = C.chromosome_stats(cpg, cells, contigs).collect()
    assert sum(r.sites for r in rows) == 6 and len(rows) == 6 + 5
    w = C.windows_1mb(cpg, cells, contigs).collect()
    assert len(w) == 6 and sum(r["cov"] for r in w) == 16
    bins = spark.createDataFrame([("S1", "chr1", k, v) for k, v in enumerate((1, 1, 1, 1))] + [("S2", "chr1", k, v) for k, v in enumerate((0, 0, 0, 8))], "sample_id string, chrom string, bin long, cov long")
    assert {r.sample_id: r.gini for r in C.gini(bins).collect()} == {"S1": 0.0, "S2": 0.75}


def test_tss_two_level_mean(spark, contigs):
    genes = spark.createDataFrame([("A", "chr1", 5000, 9000, "+", 2_500_000), ("B", "chr1", 2000, 5020, "-", 2_500_000)], "gene string, chrom string, g_start long, g_end long, strand string, len long")
    bins = C.tss_bins(genes)
    assert bins.count() == 400 and {(r.start, r.stop) for r in bins.where("offset = 0").collect()} == {(5000, 5020)}
    cpg = spark.createDataFrame([("S1", "chr1", 5001, 1, 0), ("S1", "chr1", 5002, 0, 1), ("S1", "chr1", 5003, 0, 1)], schemas.CPG)
    r = C.tss_profile(cpg, C.tss_regions(bins, contigs)).where("offset = 0").first()
    assert r.members == 2 and r.meth_frac == pytest.approx(1 / 3, abs=1e-6) and r.methyl == 2


def test_filter_reasons(spark):
    row = {c: 50.0 for c in schemas.QC_COLUMNS} | {"sample_id": "a", "clone_id": "c", "plate_id": "A1", "lambda_rate_pct": None, "puc19_rate_pct": 90.0, "unique_cpg_sites": 600000, "gini": 0.4}
    kinds = ", ".join(f"{c} string" if c in ("sample_id", "clone_id", "plate_id") else f"{c} double" for c in schemas.QC_COLUMNS)
    values = tuple(float(row[c]) if isinstance(row[c], int) else row[c] for c in schemas.QC_COLUMNS)
    r = Q.filter_reasons(spark.createDataFrame([values], kinds), mapping_min=60).first()
    assert r.reasons == "Lambda_missing;pUC19_threshold;Mapping_threshold" and r.failed_criteria == 3 and not r.hq and r.pass_ncg and r.pass_gini


def test_read_ids(spark):
    want = {"read-1/1 lane": "read-1", "read-1/2 other": "read-1", "@read/1": "@read", "read/1/1": "read/1", "": None, " ": None}
    got = spark.createDataFrame([(k,) for k in want], "x string").select("x", S.read_id("x").alias("y")).collect()
    assert {r.x: r.y for r in got} == want


def test_scalar_functions(spark):
    r = one(spark, S.reverse_complement(F.lit("AACGTN")).alias("a"), S.hamming(F.lit("ACGT"), F.lit("AGGA")).alias("b"), S.hamming(F.lit("A"), F.lit("AG")).alias("c"), S.cytosine_context(F.lit("CGA")).alias("d"), S.cytosine_context(F.lit("CTG")).alias("e"), S.cytosine_context(F.lit("CAA")).alias("f"), S.cytosine_context(F.lit("CNA")).alias("g"), S.neighbours(F.lit("AC")).alias("h"), S.molecule_key(F.lit("ACGN"), F.lit("A" * 32)).alias("i"))
    assert tuple(r)[:7] == ("NACGTT", 2, None, "CpG", "CHG", "CHH", None) and sorted(r.h) == ["AA", "AG", "AT", "CC", "GC", "TC"] and r.i is None
    r = one(spark, N.grouped_count(F.lit("1,234,567 (12.3%)")).alias("a"), N.grouped_count(F.lit("12,34")).alias("b"), N.exact_integer(F.lit("12.0")).alias("c"), N.exact_integer(F.lit("1.5")).alias("d"), N.packed(F.lit(3), F.lit(65533)).alias("e"), N.packed(F.lit(3), F.lit(5)).alias("f"), N.percentage(F.lit(1), F.lit(0)).alias("g"), N.humanised(F.lit(1234567.0)).alias("h"), N.attempt_memory(F.lit(1001), F.lit(2)).alias("i"))
    assert tuple(r) == (1234567, None, 12, None, None, (3 << 16) | 8, 0.0, "1.2M", 1502)
    r = one(spark, X.gtf_attribute(F.lit('gene_id "G1"; gene_type "x y";'), "gene_type").alias("a"), X.gtf_attribute(F.lit('gene_id "G1"'), "level").alias("b"), X.base_counts(F.lit("C3Y12")).alias("c"), X.safe_identifier(F.lit("a.b-1")).alias("d"), X.safe_identifier(F.lit("..")).alias("e"))
    assert tuple(r) == ("x y", None, {"C": 3, "Y": 12}, True, False)
    assert one(spark, *[S.fnv1a_shard(F.lit("a"), n).alias(f"s{n}") for n in (7, 64, 1 << 20)]) == tuple(0xAF63DC4C8601EC8C % n for n in (7, 64, 1 << 20))


def plate(spark, seqs, barcodes=("ACGTACGT",), **kw):
    reads = spark.createDataFrame([(1, k, s) for k, s in enumerate(seqs)], "lane int, ordinal long, seq string")
    out = R.plate_demux(reads, spark.createDataFrame([(b,) for b in barcodes], "barcode string"), **kw).orderBy("ordinal").collect()
    return [(r.fate, r.barcode, r.trim_start) for r in out]


def test_plate_layouts(spark):
    b, tail = "ACGTACGT", "CCCCCCCCC" + "GACTACGTACGT"
    got = plate(spark, [
        b + ANCHOR + tail, b[1:] + ANCHOR + tail, "T" + b + ANCHOR + tail, b[:7] + "A" + ANCHOR + tail, b[:7] + "N" + ANCHOR + tail,
        b + ANCHOR[:4] + "CCC" + ANCHOR[4:] + tail, b + ANCHOR + "CCCCCCCCC", b + ANCHOR + "CCCCCCCCCA", "ACGT", "T" * 60, "GGGGGGGG" + ANCHOR + tail,
        b + "AGATATATATAAAAAACAA" + tail,
    ])
    assert got == [("dna_assigned", b, 36), ("dna_assigned", b, 35), ("dna_assigned", b, 37), ("dna_assigned", b, 36), ("unmatched", None, None), ("dna_assigned", b, 39), ("unmatched", None, None), ("dna_assigned", b, 36), ("short", None, None), ("unmatched", None, None), ("unmatched", None, None), ("dna_assigned", b, 36)]
    assert plate(spark, [b + "AGATATATATAAAAAACAA" + tail], bisulfite=False)[0][0] == "unmatched"
    assert plate(spark, [b + ANCHOR.lower() + tail, None, ""], bisulfite=False) == [("dna_assigned", b, 36), ("unmatched", None, None), ("short", None, None)]


def test_ambiguous_barcodes(spark):
    three = spark.createDataFrame([("AAAAAAAA",), ("AAAAAAAC",), ("AAAAAAAG",)], "barcode string")
    index = {r.key: (r.id, r.ambiguous) for r in R.barcode_index(three, shifted=False).collect()}
    assert index["AAAAAAAG"] == ("AAAAAAAG", False) and index["AAAAAAAT"] == (None, True) and index["CAAAAAAG"] == ("AAAAAAAG", False)
    wide = spark.createDataFrame([("A" * 17,), ("TG" + "A" * 15,)], "barcode string")
    index = {r.key: (r.id, r.ambiguous) for r in R.barcode_index(wide, shifted=False).collect()}
    assert index["T" + "A" * 16] == (None, True) and index["C" + "A" * 16] == ("A" * 17, False) and "N" + "A" * 16 not in index
    kept = {r.key for r in R.barcode_index(three, protected=spark.createDataFrame([("AAAAAAAT",)], "barcode string"), shifted=False).collect()}
    assert "AAAAAAAT" not in kept and "AAAAAAAC" in kept


def test_droplet_layouts(spark):
    cb, umi, end = "AGTAGTAGTAGTAGTAG", "ACGTNACGTACG", "A" * 9 + "C" * 20
    seqs = [cb + umi + DROP + end, "G" + cb + umi + DROP + end, cb + umi + DROP[:22] + "A" + DROP[22:] + end, cb + umi + DROP[:22] + DROP[23:] + end, (cb + umi + DROP)[:70], cb + umi + "T" * 49 + end, cb + umi + DROP.replace("C", "T") + end, None, "N" + cb[1:] + umi + DROP + end]
    got = [r.layout for r in R.droplet_extract(spark.createDataFrame(list(enumerate(seqs)), "k int, seq string")).orderBy("k").collect()]
    assert [(r["fate"], r["trim_start"]) for r in got] == [("assigned", 87), ("assigned", 88), ("assigned", 88), ("assigned", 86), ("short", None), ("unmatched", None), ("assigned", 87), ("short", None), ("unmatched", None)]
    assert got[0]["barcode"] == cb and got[1]["umi"] == umi and got[5]["barcode"] is None


def test_alignment_finds_least_edits():
    texts = ["ACGTACGT" + ANCHOR[:8] + "C" + ANCHOR[8:], "ACGTACGT" + ANCHOR[:8] + ANCHOR[9:], "T" * 50, None]
    r = R.align(pa.array(texts), bisulfite=False).to_pylist()
    assert R.align(pa.array(["x", *texts]).slice(1), bisulfite=False).to_pylist() == r and len(R.align(pa.array([], pa.string()))) == 0
    assert r == [{"start": 8, "stop": 28, "edits": 1}, {"start": 8, "stop": 26, "edits": 1}, None, None]


def test_cell_calling(spark):
    rng = random.Random(5)
    bc = lambda: "".join(rng.choice("AGT") for _ in range(17))
    rows = [(bc(), max(101, int(rng.gauss(300, 60)))) for _ in range(3000)] + [(bc(), int(rng.gauss(20000, 3000))) for _ in range(400)] + [("C" * 17, 10**6)]
    called, limit = R.call_cells(spark.createDataFrame(rows, "barcode string, count long"))
    assert 600 < limit.first().threshold < 12000 and called.count() == 400
    smooth = lambda values: spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "b long, m double")
    top = lambda values, apart: [r.b for r in R.peaks(smooth(values), apart).orderBy("place").collect()]
    assert top([0, 1, 1, 0, 2, 0], 1) == [4, 1] and top([0, 1, 0, 2, 0], 5) == [3] and top([3, 1, 0], 1) == [] and top([0, 2, 2, 2, 1, 2, 0, 2, 0], 4) == [2, 7]
    for few in ([("A" * 17, 500)], []):
        called, limit = R.call_cells(spark.createDataFrame(few, "barcode string, count long"))
        assert limit.first().threshold is None and called.count() == 0


def test_error_screen(spark):
    parent, child = "A" * 17, "A" * 16 + "G"
    called = spark.createDataFrame([(parent, 5000), (child, 200), ("T" * 17, 900)], "barcode string, count long")
    q = spark.createDataFrame([(parent, [100] * 17, [4000] * 17), (child, [150] * 17, [5] * 17), ("T" * 17, [1] * 17, [800] * 17)], "barcode string, below_q20 array<long>, q30 array<long>")
    inserts = ["".join(random.Random(k).choice("ACGT") for _ in range(32)) for k in range(4)]
    reads = spark.createDataFrame([(b, f"ACGTACGTACG{'ACGT'[k]}", inserts[k]) for b in (parent, child) for k in range(4)], "barcode string, umi string, insert string")
    assert [tuple(r) for r in R.error_screen(called, q, reads, 1000).collect()] == [(child, "remove", "quality_and_shared_molecules")]
    assert R.error_screen(called, q, reads.where("insert = '%s'" % inserts[0]), 1000).first().reason == "insufficient_shared_molecules"
    assert R.error_screen(called, q, reads, 3).first().reason == "independent_q30_support"


def slow_consensus(groups):
    n = {u: m + k for u, m, k, _, _ in groups}
    left = {g[0]: g[1:] for g in groups}
    out = [0, 0, 0, 0]
    for u in sorted(n, key=lambda x: (-n[x], x)):
        if u in left:
            v = list(left.pop(u))
            for w in [w for w in left if n[w] < n[u] and len(u) == len(w) and sum(a != b for a, b in zip(u, w)) == 1]:
                v = [a + b for a, b in zip(v, left.pop(w))]
                out[2] += 1
            key = (v[0] > v[1]) - (v[0] < v[1]) or (v[2] > v[3]) - (v[2] < v[3])
            out[{1: 0, -1: 1, 0: 3}[key]] += 1
    return tuple(out)


def consensus(*sites):
    import numpy as np

    rows = [(k, *g) for k, site in enumerate(sites) for g in site]
    found = A.consensus(np.array([r[0] for r in rows]), np.array([r[1].encode() for r in rows], "S"), np.array([r[2:] for r in rows]), len(sites))
    return [tuple(map(int, r)) for r in found]


def test_consensus():
    assert consensus([("AAA", 3, 0, 90, 0), ("AAC", 0, 1, 0, 30)], [("AAA", 1, 0, 30, 0), ("AAC", 0, 1, 0, 30)], [], [("AAA", 1, 1, 30, 40)], [("AAA", 1, 1, 30, 30)]) == [(1, 0, 1, 0), (1, 1, 0, 0), (0, 0, 0, 0), (0, 1, 0, 0), (0, 0, 0, 1)]
    rng = random.Random(7)
    sites = []
    for _ in range(300):
        umis = {"".join(rng.choice("ACGTN") for _ in range(rng.choice((3, 3, 3, 4)))) for _ in range(rng.randrange(1, 60))}
        sites.append([(u, rng.randrange(4), rng.randrange(1, 4), rng.randrange(90), rng.randrange(90)) for u in umis])
    assert consensus(*sites) == [slow_consensus(g) for g in sites]


def test_aligned_bases(spark):
    rows = [("q", "chr1", 10, [(4, 1), (0, 3), (1, 2), (0, 1), (2, 2), (0, 1)], "NACGTTAC", "I" * 8)]
    a = spark.createDataFrame(rows, "qname string, rname string, pos long, cigar array<struct<op: int, len: int>>, seq string, qual string")
    assert [(r.rpos, r.base, r.qual) for r in A.aligned_bases(a).collect()] == [(10, "A", 40), (11, "C", 40), (12, "G", 40), (13, "A", 40), (16, "C", 40)]


def test_insert_model(spark):
    log = "analyzing insert size distribution for orientation FF...\nmean and std.dev: (1.0, 1.0)\nanalyzing insert size distribution for orientation FR...\n low and high boundaries for computing mean and std.dev: (1, 900)\n[M] mean and std.dev: (245.10, 60.50)\n low and high boundaries for proper pairs: (1, 700)\n"
    logs = [log, "", log.replace("245.10", "inf"), log.replace("60.50", "0"), log.replace("(1, 700)", "(800, 700)"), log.replace("(1, 700)", "(1, 1700)") + "skip orientation RF", None]
    got = [r.m and tuple(r.m) for r in spark.createDataFrame(list(enumerate(logs)), "k int, log string").orderBy("k").select(A.insert_model(F.col("log")).alias("m")).collect()]
    assert got == [(245.1, 60.5, 1, 1000), None, None, None, None, (245.1, 60.5, 1, 1700), None]


def test_pairs_and_duplicates(spark):
    rows = [("a", 99, "chr1", 10, 30), ("a", 147, "chr1", 60, 30), ("b", 99, "chr1", 10, 40), ("b", 147, "chr1", 60, 10), ("c", 99, "chr1", 10, 60), ("c", 147, "chr1", 61, 60), ("d", 77, None, 0, 0), ("d", 141, None, 0, 0), ("e", 163, "chr1", 10, 20), ("e", 83, "chr1", 60, 20)]
    a = spark.createDataFrame([("S", *r) for r in rows], "sample_id string, qname string, flag int, rname string, pos long, mapq int")
    # a, b and e have the same ends (b's sum of qualities is the least, e is read from the other side); c ends elsewhere
    assert {r.qname for r in A.mark_duplicates(a).where("duplicate").collect()} == {"b", "e"}
    # with spans, c's reverse mate starts where theirs do
    assert {r.qname for r in A.mark_duplicates(a, F.when(F.col("qname") == "c", 49).otherwise(50)).where("duplicate").collect()} == {"a", "b", "e"}
    p = {r.qname: r for r in A.paired(a).collect()}
    assert len(p) == 5 and p["e"].first.flag == 83 and p["e"].second.flag == 163
    for broken in (a.where("flag <> 147"), a.union(a.where("qname = 'a'")), a.withColumn("flag", F.when(F.col("qname") == "c", 99).otherwise(F.col("flag")).cast("int"))):
        with pytest.raises(Exception, match="no pair of mates"):
            A.paired(broken).collect()


def test_labels_sections_and_places(spark):
    cut = lambda *x: [r.label for r in M.short_labels(spark.createDataFrame([(v,) for v in x], "v string"), "v").orderBy("v").collect()]
    assert cut("p_a_x", "p_b_x") == ["a", "b"] and cut("ab", "ab") == ["ab", "ab"] and cut("aa", "aaa") == ["aa", "aaa"] and cut("", "b") == ["", "b"]
    section = M.report_section(spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "sample_id string, n int"), "s", "sample_id", ["n"])
    kept = M.restrict_section(section, spark.createDataFrame([("a",), ("b",)], "sample_id string"))
    assert M.section_json(kept, 2).first().data == '{"a":{"n":2},"b":{"n":1}}'
    with pytest.raises(ValueError, match="at most"):
        M.section_json(section, 2)
    rows = spark.createDataFrame([(k * 7919 % 1000, k) for k in range(1000)], "v long, k long")
    got = M.numbered(rows.repartition(7), F.desc("v")).collect()
    assert sorted((r.place, r.v) for r in got) == [(k, 999 - k) for k in range(1000)]
    assert M.numbered(rows.limit(0), "v").count() == 0


def test_order_of_cells(spark):
    want = "-9223372036854775808 -10 -2 01 1 +2 2 10 9223372036854775807 1z A1 B2".split()
    for k in range(3):
        rows = want[k * 4 :] + want[: k * 4]
        got = [r.cell_order for r in M.ordered(spark.createDataFrame([("p", c, "x", "s") for c in rows], "project_sample_id string, cell_order string, plate_id string, sample_id string")).collect()]
        assert got == sorted(got, key=got.index) and [x for x in got if x not in ("01", "1", "+2", "2")] == [x for x in want if x not in ("01", "1", "+2", "2")]


def test_exact_id_join_fails_on_differing_ids(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2)], "id string, a int"), spark.createDataFrame([("x", 1)], "id string, b int")
    with pytest.raises(Exception, match="ids differ or repeat"):
        I.exact_id_join(a, b, "id").collect()
    assert I.exact_id_join(a.where("id = 'x'"), b, "id").count() == 1


def test_checks_find_mutations(spark, contigs):
    bad = spark.createDataFrame([("S", "chr1", 0, 1, 1), ("S", "chr1", 5, 0, 0), ("S", "nope", 5, 1, 1), ("S", "chr1", 9, 70000, 1), ("S", "chr1", 7, 1, 1), ("S", "chr1", 7, 1, 1), ("S", "chrY", 101, 1, 1)], schemas.CPG)
    assert sorted(r.rule for r in K.cpg_rows(bad, contigs).collect()) == ["coverage", "coverage", "position", "position", "repeated_site", "unknown_contig"]
    m = spark.createDataFrame([("ACGTACGT", "A1", "1"), ("ACGTACGA", "A1", "2"), ("ACGN", "A2", "2")], "barcode string, plate_id string, cell_order string")
    assert {r.rule for r in K.barcode_map(m).collect()} == {"letters", "length", "repeated_plate", "repeated_order", "too_near"}
    a = spark.createDataFrame([("q", 65), ("q", 129), ("r", 65), ("r", 65)], "qname string, flag int")
    assert [r.key for r in K.mates(a).collect()] == ["r"]
    c = spark.createDataFrame([("a", 2, 0.5, "x", 0.1), ("b", None, None, None, None), ("c", 1, 1.0, "taps", 1.0)], "project string, coordinate_base int, tss_fraction double, protocol string, high_cph_threshold double")
    assert sorted((r.rule, r.key, r.detail) for r in K.config_rows(c).collect()) == [("coordinate_base", "a", "2"), ("protocol", "a", "x")]


def test_robust_slopes(spark):
    rows = [("g", float(k), 3.0 * k + (k % 3) * 0.1, 5.0 * k) for k in range(1, 20)] + [("g", 60.0, 900.0, 10.0), ("h", 1.0, 2.0, 4.0), ("h", 2.0, 4.0, 8.0), ("i", 1.0, 1.0, 1.0)]
    r = {x.g: x for x in T.slope_pairs(spark.createDataFrame(rows, "g string, x double, u double, s double"), "g", "x", "u", "s").collect()}
    assert r["g"].used == 19 and r["g"].slope_signal == pytest.approx(5) and r["h"].slope_unique == 2 and r["i"].slope_unique is None


def test_histogram_and_smoothing(spark):
    rows = spark.createDataFrame([("a", float(k)) for k in range(101)], "g string, v double")
    h = {r.bin: r.n for r in T.histogram(rows, "v", "g").collect()}
    assert h[99] == 2 and sum(h.values()) == 101
    s = T.gaussian_smooth(T.histogram(rows, "v", "g"), "g").collect()
    assert sum(r.smooth for r in s) == pytest.approx(101) and len(s) == 100
    e = {r.edge: r.value for r in T.bin_edges(rows, "v").collect()}
    assert e[0] == 0 and e[100] == 100


def test_components_of_metrics(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3)) @ np.diag([5, 2, 0.1]) + rng.normal(size=(60, 1))
    df = spark.createDataFrame([(str(k), *map(float, v)) for k, v in enumerate(x)] + [("n", None, 1.0, 1.0)], "sample_id string, a double, b double, c double")
    got = np.array([[r.pc1, r.pc2] for r in T.principal_components(df, ["a", "b", "c"]).orderBy(F.col("sample_id").cast("int")).collect()])
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(want[0][:, :2] * want[1][:2]), atol=1e-6)


def test_closure(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "source string, target string")
    assert {r.name for r in M.dependency_closure(e, spark.createDataFrame([("a",)], "name string")).collect()} == {"a", "b", "c"}


def test_correlation_in_blocks(spark):
    rng = random.Random(9)
    rows = [(f"S{s}", f"c{c}", 0.5 if s == 3 else rng.random()) for s in range(23) for c in range(17) if rng.random() < 0.7]
    v = spark.createDataFrame([*rows, ("S1", "x", None), ("lone", "y", 0.1)], "sample_id string, chrom string, value double")
    of = {s: {c: x for t, c, x in [*rows, ("lone", "y", 0.1)] if t == s} for s in {r[0] for r in rows} | {"lone"}}
    plain = {}
    for a in of:
        for b in of:
            both = sorted(set(of[a]) & set(of[b]))
            if a <= b and both:
                x, y = (np.array([of[s][c] for c in both]) for s in (a, b))
                plain[a, b] = (len(both), np.corrcoef(x, y)[0, 1] if len(both) > 1 and np.ptp(x) > 0 and np.ptp(y) > 0 else None)
    for block, chunk in ((256, 1024), (4, 1024), (5, 3)):
        found = {tuple(sorted((r.a, r.b))): (r.n, r.r) for r in T.pearson(v, rows=block, columns=chunk).collect()}
        assert set(found) == set(plain)
        for k, (n, r) in plain.items():
            assert found[k][0] == n and (found[k][1] is None) == (r is None), k
            assert r is None or abs(found[k][1] - r) < 1e-9
    assert T.pearson(v.where("false")).count() == 0


def test_interval_counts(spark):
    rng = random.Random(2)
    pts = [("chr%d" % rng.randrange(2), rng.randrange(3000)) for _ in range(400)]
    ivs = [("chr%d" % rng.randrange(3), a := rng.randrange(3000), a + rng.randrange(0, 700)) for _ in range(80)] * 2
    want = {}
    for c, a, b in ivs:
        if n := sum(c == d and a <= p < b for d, p in pts):
            want[c, a, b] = want.get((c, a, b), 0) + n
    for width in (1, 100, 8192):
        out = I.interval_counts(spark.createDataFrame(pts, "chrom string, pos0 long"), spark.createDataFrame(ivs, schemas.INTERVALS), width=width)
        assert {(r.chrom, r.start, r.stop): r.n for r in out.collect()} == want


def test_pairs_of_sites_and_intervals_are_not_exchanged(spark, tmp_path, cells, contigs):
    rng = random.Random(5)
    rows = {(f"S{rng.randrange(3)}", rng.choice(["chr1", "chr2", "chrM"]), rng.randrange(1, 3000)): (rng.randrange(4), rng.randrange(1, 4)) for _ in range(600)}
    ivs = [(rng.choice(["chr1", "chr2", "chrM"]), a := rng.randrange(3000), a + rng.randrange(0, 900)) for _ in range(300)] + [("chr1", 0, 3000), ("chr1", 0, 3000)]
    spark.createDataFrame([(*k, *v) for k, v in rows.items()], schemas.CPG).write.parquet(f"{tmp_path}/cpg")
    cpg, spans = spark.read.parquet(f"{tmp_path}/cpg"), spark.createDataFrame(ivs, schemas.INTERVALS)
    for width in (7, 256, 8192):
        got = {(r.sample_id, r.chrom, r.start, r.stop): (r.sites, r.methyl, r.cov, r.mean_fraction) for r in C.interval_means(cpg, spans, width=width).collect()}
        want = {}
        for cell in ("S0", "S1", "S2"):
            for chrom, a, b in set(ivs):
                own = [v for (s, c, p), v in rows.items() if s == cell and c == chrom != "chrM" and a <= p - 1 < b]
                if own:
                    want[cell, chrom, a, b] = (len(own), sum(m for m, _ in own), sum(m + u for m, u in own), pytest.approx(sum(m / (m + u) for m, u in own) / len(own)))
        assert got == want
    plan = C.interval_means(cpg, spans)._jdf.queryExecution().optimizedPlan().toString()
    # what leaves a tile is final: no aggregate follows the list of intervals
    assert "Aggregate" not in plan[: plan.index("Generate inline")]
    made = C.single_pass(cpg, cells, contigs, spans, spans.selectExpr("*", "0 offset", "'g' gene"))
    assert f"{tmp_path}/cpg" not in made["gini"]._jdf.queryExecution().optimizedPlan().toString()
    sums = made["summary"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan ExistingRDD" in sums or "LogicalRDD" in sums
    assert {(r.sample_id, r.chrom, r.start, r.stop): (r.sites, r.methyl, r.cov) for r in made["intervals"].collect()} == {k: v[:3] for k, v in want.items()}


def test_a_filter_does_not_align_twice(spark, tmp_path):
    from methlake.operators import reads as R

    spark.createDataFrame([(k, "ACGT" * 5 + R.PLATE_ANCHOR) for k in range(4)], "ordinal long, seq string").write.parquet(f"{tmp_path}/reads")
    found = spark.read.parquet(f"{tmp_path}/reads").select("ordinal", R.anchor_alignment(F.col("seq")).alias("a")).where("a is not null").select("ordinal", "a.edits", "a.start", "a.stop")
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {tuple(r)[1:] for r in found.collect()} == {(0, 20, 20 + len(R.PLATE_ANCHOR))}
    # texts wider than 63 letters need larger numbers
    import pyarrow as pa

    far = R.align(pa.array(["C" * 80 + R.PLATE_ANCHOR, None, ""]), width=120).to_pylist()
    assert far == [{"start": 80, "stop": 80 + len(R.PLATE_ANCHOR), "edits": 0}, None, None]


def test_tiles_meet_across_batches(spark):
    """Sites and intervals leave a tile's task as sums, whatever the batches cut; the rows that are exchanged are no more than sites of tiles and intervals."""
    rng = random.Random(8)
    rows = {(f"S{rng.randrange(4)}", rng.choice(["chr1", "chr2"]), rng.randrange(1, 400)): (rng.randrange(4), rng.randrange(1, 4)) for _ in range(300)}
    ivs = {(rng.choice(["chr1", "chr2"]), a := rng.randrange(400), a + rng.randrange(1, 60)) for _ in range(200)} | {("chr1", -5, 3), ("chr2", 0, 1 << 45)}
    cpg, spans = spark.createDataFrame([(*k, *v) for k, v in rows.items()], schemas.CPG), spark.createDataFrame(list(ivs), "chrom string, start long, stop long")
    want = {}
    for (s, c, p), (m, u) in rows.items():
        for k in ((s, d, a, b) for d, a, b in ivs if c == d and a <= p - 1 < b and b < 1 << 40):
            n, x, y = want.get(k, (0, 0, 0))
            want[k] = (n + 1, x + m, y + u)
    near = spans.where(f"stop < {1 << 40}")
    assert C.interval_rows(cpg, near.where("start >= 0"), width=1000).count() == len(rows) + len(ivs) - 2
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 3, 50):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            for width in (20, 1000):
                assert {(r.sample_id, r.chrom, r.start, r.stop): (r.sites, r.methyl, r.unmethyl) for r in C.interval_sums(cpg, near, width=width).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # an interval far beyond the contig
    wide = C.interval_sums(cpg, spans.where(f"stop >= {1 << 40}"), width=1 << 44).collect()
    assert {(r.sample_id, r.sites) for r in wide} == {(s, sum(k[:2] == (s, "chr2") for k in rows)) for s in {k[0] for k in rows if k[1] == "chr2"}}


def test_one_scan_makes_all_products(spark, tmp_path, cells, contigs):
    rng = random.Random(3)
    rows = [(f"S{rng.randrange(3)}", rng.choice(["chr1", "chr2", "chrX", "chrM", "lambda"]), p, rng.randrange(4), rng.randrange(4)) for p in rng.sample(range(1, 3000), 900)]
    spark.createDataFrame(rows, schemas.CPG).where("methyl + unmethyl > 0").write.parquet(f"{tmp_path}/cpg")
    cpg = spark.read.parquet(f"{tmp_path}/cpg")
    spans = spark.createDataFrame([("chr1", 0, 500), ("chr1", 400, 401), ("chr1", 400, 2900), ("chr2", 5, 5), ("chr2", 10, 3000), ("lambda", 0, 3000)], "chrom string, start long, stop long")
    sums = C.tagged_sums(cpg, {"interval": (spans, 8192), "region": (spans, 16)})
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/cpg") == 1
    want = {(r.sample_id, r.chrom, r.start, r.stop): (r.sites, r.methyl, r.cov) for r in C.interval_means(cpg, spans).collect()}
    assert want
    for product in ("interval", "region"):
        got = {(r.sample_id, r.chrom, r.a, r.b): (r.sites, r.methyl, r.methyl + r.unmethyl) for r in sums.where(F.col("product") == product).collect()}
        assert got == want


def test_genes_are_dealt_out_before_their_bins(spark):
    genes = spark.createDataFrame([(f"G{k}", "chr1", 5000 + k, 9000 + k, "+-"[k % 2], 100_000) for k in range(40)], "gene string, chrom string, g_start long, g_end long, strand string, len long").coalesce(1)
    bins = C.tss_bins(genes)
    assert bins.count() == 40 * 200
    assert bins.select(F.spark_partition_id()).distinct().count() > 1


def test_molecules_without_a_cap(spark):
    reads = spark.range(5000).select(F.lit("AC").alias("barcode"), F.lit("A" * 12).alias("umi"), F.translate(F.lpad(F.conv(F.col("id").cast("string"), 10, 4), 32, "0"), "0123", "ACGT").alias("insert"))
    reads = reads.unionByName(reads.limit(10)).unionByName(reads.limit(3).withColumn("umi", F.lit("NAAAAAAAAAAA")))
    assert R.molecules(reads).count() == R.MOLECULE_CAP
    assert R.molecules(reads, cap=None).count() == 5000


def test_molecule_samples(spark):
    rng = random.Random(8)
    key = lambda: "".join(rng.choice("ACGT") for _ in range(44))
    few, many = [key() for _ in range(5)], [key() for _ in range(300)]
    rows = [("few", k) for k in few * 40] + [("many", k) for k in many * 3] + [("edge", k) for k in many[:20]] + [("none", "N" * 44), (None, few[0])]
    rng.shuffle(rows)
    reads = spark.createDataFrame([(b, k[:12], k[12:]) for b, k in rows], "barcode string, umi string, insert string").repartition(5)
    rank = dict(zip(many + few, R.molecule_ranks(many + few).tolist()))
    got = {}
    for r in R.molecule_samples(reads, cap=20).collect():
        got.setdefault((r.barcode, r.reads, r.saturated), []).append(r.key)
    want = {("few", 200, False): few, ("edge", 20, False): many[:20], ("many", 900, True): sorted(many, key=lambda k: (rank[k], k))[:20]}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    # flushed sketches merge to the same
    small = list(R._sketches(20, held=30)(iter([pa.record_batch({"barcode": [b for b, _ in rows[:500]], "key": [k for _, k in rows[:500]]}).filter(pa.array([b is not None and "N" not in k for b, k in rows[:500]]))] * 2)))
    assert sum(sum(b.column(3).to_pylist()) for b in small) == 2 * sum(b is not None and "N" not in k for b, k in rows[:500])
    mix = lambda x: (lambda y: y ^ y >> 31)(((lambda y: y ^ y >> 27)((x ^ x >> 30) * R.RANK_FACTORS[0] % 2**64)) * R.RANK_FACTORS[1] % 2**64)
    code = sum("ACGT".index(c) << 2 * i for i, c in enumerate(reversed(few[0])))
    assert rank[few[0]] == mix(code % 2**64 ^ mix(code >> 64))


def test_fragment_ends(spark):
    """By hand: clips on both strands, pairs against single ends, qualities, ties, strands."""
    M, D, N, S_, H = 0, 2, 3, 4, 5
    row = lambda q, flag, pos, cigar, qual="I" * 10, rname="chr1", cell="S1": (cell, q, flag, rname, pos, [(o, n) for o, n in cigar], qual)
    rows = [
        # one molecule: forward 5' at 100, reverse 5' at 219; clips hide it
        row("a", 99, 100, [(M, 20)]), row("a", 147, 200, [(M, 20)]),
        row("b", 99, 105, [(S_, 5), (M, 15)], "5" * 10), row("b", 147, 200, [(M, 17), (H, 1), (S_, 2)]),
        row("c", 163, 103, [(H, 1), (S_, 2), (M, 15)], "#" * 10), row("c", 83, 190, [(M, 10), (D, 4), (N, 6), (M, 10)], "#" * 10),
        # the same places on other strands, in another cell
        row("d", 65, 100, [(M, 20)]), row("d", 129, 219, [(M, 20)]), row("e", 99, 100, [(M, 20)], cell="S2"), row("e", 147, 200, [(M, 20)], cell="S2"),
        # single ends: at a pair's end, on its other strand, two at one place of their own
        row("f", 73, 100, [(M, 9)], "~" * 9), row("f", 133, 100, [], None), row("g", 89, 100, [(M, 1)]), row("h", 73, 500, [(M, 9)], "5" * 9), row("i", 73, 502, [(S_, 2), (M, 9)], "6" * 9),
        # equal scores: the lesser name; other records of a read count for nothing
        row("k", 99, 700, [(M, 5)]), row("k", 147, 800, [(M, 5)]), row("j", 99, 700, [(M, 5)]), row("j", 147, 800, [(M, 5)]), row("k", 99 + 2048, 5, [(M, 2)]), row("k", 99 + 256, 5, [(M, 2)])]
    df = spark.createDataFrame(rows, "sample_id string, qname string, flag int, rname string, pos long, cigar array<struct<op: int, len: int>>, qual string")
    marked = {(r.sample_id, r.qname) for r in A.mark_fragments(df).collect() if r.duplicate}
    assert marked == {("S1", "b"), ("S1", "c"), ("S1", "f"), ("S1", "h"), ("S1", "k")}
    assert [r.flag for r in A.mark_fragments(df).where("duplicate and qname in ('f', 'k')").orderBy("flag").collect()] == [73, 99, 147, 2147]
    assert A.mark_fragments(df, supplementary=False).where("duplicate and qname = 'k'").count() == 2
    with pytest.raises(Exception, match="more than two"):
        A.mark_fragments(df.unionByName(df.where("qname = 'a'"))).collect()
    assert A.mark_fragments(df.where("false")).count() == 0


def test_a_site_is_one_row_to_exchange_for_all_products(spark, tmp_path, cells, contigs):
    rng = random.Random(4)
    rows = {(f"S{rng.randrange(3)}", rng.choice(["chr1", "chr2", "chrX", "chrM", "lambda"]), rng.choice([1, 500_000, 500_001, 1_000_000, 1_000_001, rng.randrange(1, 2_400_000)])): (rng.randrange(4), rng.randrange(1, 4)) for _ in range(500)}
    spark.createDataFrame([(*k, *v) for k, v in rows.items()], schemas.CPG).write.parquet(f"{tmp_path}/cpg")
    cpg = spark.read.parquet(f"{tmp_path}/cpg")
    assert "Generate" not in C.stretch_sums(cpg)._jdf.queryExecution().executedPlan().toString()
    spans = spark.createDataFrame([("chr1", 0, 500)], "chrom string, start long, stop long")
    made = C.single_pass(cpg, cells, contigs, spans)
    kept = made["gini"]._jdf.queryExecution().optimizedPlan().toString()
    # what is written has no row of a product, but of a stretch
    assert "product" not in kept
    for name, alone in (("chromosomes", C.chromosome_stats(cpg, cells, contigs)), ("windows", C.windows_1mb(cpg, cells, contigs)), ("gini", C.gini(C.coverage_bins(cpg))), ("summary", C.cpg_summary(cpg, cells))):
        got, want = ({tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.select(sorted(d.columns)).collect()} for d in (made[name], alone))
        assert got == want and want


def test_measured_regions_are_not_exchanged_to_meet_their_offsets(spark, tmp_path):
    rng = random.Random(6)
    rows = {(f"S{rng.randrange(3)}", rng.choice(["chr1", "chr2"]), rng.randrange(1, 600)): (rng.randrange(4), rng.randrange(1, 4)) for _ in range(200)}
    regions = [(rng.choice(["chr1", "chr2"]), a := rng.randrange(600), a + rng.choice([5, 40]), rng.randrange(4), f"g{k}") for k in range(80)]
    regions += [("chr1", 10, 500, 1, "a"), ("chr1", 10, 500, 1, "b"), ("chr1", 10, 500, 2, "c"), ("chr1", 7, 7, 3, "d")]
    spark.createDataFrame([(*k, *v) for k, v in rows.items()], schemas.CPG).write.parquet(f"{tmp_path}/cpg")
    cpg = spark.read.parquet(f"{tmp_path}/cpg")
    out = C.tss_profile(cpg, spark.createDataFrame(regions, "chrom string, start long, stop long, offset int, gene string"))
    want = {}
    for cell in ("S0", "S1", "S2"):
        for chrom, a, b, offset, _ in regions:
            own = [v for (s, c, p), v in rows.items() if s == cell and c == chrom and a <= p - 1 < b]
            if own:
                want.setdefault((cell, offset), []).append((sum(m / (m + u) for m, u in own) / len(own), sum(m for m, _ in own)))
    assert {(r.sample_id, r.offset): (r.meth_frac, r.methyl, r.members) for r in out.collect()} == {k: (pytest.approx(sum(x for x, _ in v) / len(v), abs=1e-6), sum(m for _, m in v), len(v)) for k, v in want.items()}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[: plan.index("MapInArrow")]


def test_sites_beyond_a_tile_s_intervals_stay_out_of_it(spark):
    cpg = spark.createDataFrame([("S1", "chr1", p, 1, 1) for p in (1, 101, 106, 150)], schemas.CPG)
    rows = C.interval_rows(cpg, spark.createDataFrame([("chr1", 90, 105)], schemas.INTERVALS), width=100)
    assert sorted((r.tile, r.p) for r in rows.where("site").collect()) == [(0, 0), (0, 100)]


def test_pairs_of_samples_leave_their_tile_whole(spark):
    rng = random.Random(9)
    rows = [(f"S{k}", f"f{j}", rng.random()) for k in range(23) for j in range(7) if rng.random() < 0.6] + [("flat", f"f{j}", 0.5) for j in range(7)] + [("alone", "f99", 1.0), ("none", "f1", None)]
    values = spark.createDataFrame(rows, "sample_id string, chrom string, value double")
    by = {}
    for k, f, x in rows:
        if x is not None:
            by.setdefault(k, {})[f] = x
    want = {}
    for a in sorted(by):
        for b in sorted(by):
            if a <= b and (both := by[a].keys() & by[b].keys()):
                x, y, n = [by[a][f] for f in both], [by[b][f] for f in both], len(both)
                mx, my = sum(x) / n, sum(y) / n
                vx, vy = sum((i - mx) ** 2 for i in x), sum((i - my) ** 2 for i in y)
                want[a, b] = (n, pytest.approx(sum((i - mx) * (j - my) for i, j in zip(x, y)) / math.sqrt(vx * vy), abs=1e-6) if n >= 2 and vx > 1e-12 and vy > 1e-12 else None)
    for size in ({}, {"rows": 4}, {"rows": 4, "columns": 3}, {"rows": 1, "columns": 1}):
        out = T.pearson(values, **size)
        assert {(r.a, r.b): (r.n, r.r) for r in out.collect()} == want
        # the pairs are neither joined with their names nor added up in an exchange
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.startswith("MapInArrow")


def test_neighbours_are_not_exchanged(spark):
    """droplet_replay against the index of all neighbours; its plan exchanges barcodes, not what is one substitution from them."""
    import random

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ACGTN"[:4]) for _ in range(n))
    own = sorted({word(4) for _ in range(40)} | {word(3) for _ in range(5)} | {"A", "ACNGT"})
    design = sorted({word(4) for _ in range(30)})
    seen = [word(4) for _ in range(300)] + [word(3) for _ in range(40)] + ["C", "ACAGT", "ACNGA", "NNNN", "", None] + own
    frame = lambda rows: spark.createDataFrame([(x,) for x in rows], "barcode string")
    reads = spark.createDataFrame([(1, i, b) for i, b in enumerate(seen)], "lane int, ordinal long, barcode string")
    index = {r.key: r.id for r in R.barcode_index(frame(own), protected=frame(design), shifted=False).collect()}
    got = R.droplet_replay(reads, frame(own), frame(design))
    fates = {True: "ambiguous", False: "unmatched"}
    assert sorted((r.ordinal, r.cell_barcode, r.fate) for r in got.collect()) == [(i, index.get(b), "dna_assigned" if index.get(b) else fates[b in index]) for i, b in enumerate(seen)]
    plan = R.nearest(frame(seen), frame(own).toDF("id"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 2


def test_bins_that_genes_share_are_not_broadcast(spark):
    from methlake.plans.registry import QUERIES

    out = QUERIES["D13_gene_bin_membership"](spark, "/root/testdata/sf0.01")
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "start#" in x]
    at = {}
    for r in rows:
        at.setdefault((r.chrom, r.start), []).append(r.n)
    # every place is whole: as many bins of it as its n
    assert rows and all(n == [len(n)] * len(n) and len(n) > 1 for n in at.values())


def test_a_cell_s_intervals_are_counted_without_their_sums(spark, cells, contigs):
    rng = random.Random(11)
    rows = {(rng.choice(["S1", "S2", None]), rng.choice(["chr1", "chr2", "lambda"]), rng.randrange(1, 2500)): (1, rng.randrange(3)) for _ in range(500)} | {("S9", "chr3", 77): (1, 0)}
    cpg = spark.createDataFrame([(*k, *v) for k, v in rows.items()], schemas.CPG)
    ivs = [(rng.choice(["chr1", "chr2", "lambda"]), a := rng.randrange(2500), a + rng.choice([0, 1, 7, 60, 900, 2600])) for _ in range(250)] * 2 + [("chr3", 0, 76), ("chr3", 77, 90)]
    spans = spark.createDataFrame(ivs, schemas.INTERVALS)
    want = {}
    for s in ("S1", "S2", "S9", None):
        n = sum(any(d == c and z == s and a <= p - 1 < b for z, d, p in rows) for c, a, b in set(ivs) if c != "lambda")
        if n:
            want[s] = n
    assert len(want) == 3
    for width in (7, 256, 32768):
        got = C.features_met(C.interval_rows(cpg, spans, width=width))
        assert {r.sample_id: r.features for r in got.collect()} == want
    made = C.single_pass(cpg, cells, contigs, spans)
    assert {r.sample_id: r.features for r in made["features"].collect()} == want
    # what is unfolded are the tiles of intervals, and no sums
    assert "inline" not in made["features"]._jdf.queryExecution().optimizedPlan().toString()
