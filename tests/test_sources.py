"""Scans and sinks over small files, and streams."""

import gzip
import hashlib
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from methlake import schemas
from methlake.operators import sequences as Q
from methlake.sources import csr as Y
from methlake.sources import delivery as D
from methlake.sources import readers as R
from methlake.sources import sinks as W
from methlake.sources import zstd as Z
from methlake.streaming import incremental as T


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_cpg_tables(spark, tmp_path):
    import zstandard

    put(tmp_path / "a" / "S1.cpg.tsv.gz", "chrom\tpos\tmethyl\tunmethyl\nchr1\t5\t1\t2\n")
    (tmp_path / "a" / "S2.cpg.tsv.zst").write_bytes(zstandard.compress(b"chrom\tpos\tmethyl\tunmethyl\nchr1\t5\t1\t2\nchr2\t6\t0\t1\n"))
    got = sorted(map(tuple, R.cpg_tables(spark, str(tmp_path / "a")).collect()))
    assert got == [("S1", "chr1", 5, 1, 2), ("S2", "chr1", 5, 1, 2), ("S2", "chr2", 6, 0, 1)]


def test_fastq(spark, tmp_path):
    a = put(tmp_path / "a_R1.fastq.gz", "@r1/1 x\nACgT\n+\nIIII\n@r2/1\nAC\n+\n##\n")
    assert [tuple(r) for r in R.fastq(spark, [a], 1).orderBy("ordinal").collect()] == [(1, 0, 1, "r1/1 x", "ACGT", "IIII"), (1, 1, 1, "r2/1", "AC", "##")]
    with pytest.raises(Exception, match="ends inside|malformed"):
        R.fastq(spark, [put(tmp_path / "b.fastq.gz", "@r\nAC\n+\n")], 1).collect()
    with pytest.raises(Exception, match="malformed"):
        R.fastq(spark, [put(tmp_path / "c.fastq.gz", "@r\nAC\n+\nI\n")], 1).collect()


def test_text_tables(spark, tmp_path):
    m = R.barcode_map(spark, put(tmp_path / "m.csv", " platEID ,DNA_Barcode,cell_order,extra\nNA,ACGTACGT,01,x\n"))
    assert m.select("plate_id", "barcode", "cell_order", "extra").first() == ("NA", "ACGTACGT", "01", "x")
    with pytest.raises(ValueError):
        R.barcode_map(spark, put(tmp_path / "n.csv", "DNA_Barcode, dna_barcode,PlateID\nA,B,C\n"))
    head = "sample_id\tdna_raw_sample\trna_sample\tspecies\tprotocol\tnotes\n"
    assert R.sample_manifest(spark, put(tmp_path / "s.tsv", head + 'a\tb\tNA\thg38\ttaps\t"two\nlines"\n')).first().notes == "two\nlines"
    body = "project_sample_id\tsample_id\tplate_id\tcell_order\treads\tstatus\n"
    cells, total = R.demux_manifest(spark, put(tmp_path / "d.tsv", body + "p\tp_A1\tA1\t1\t5\tPass\n__SUMMARY__\t\t\t\t5\t\n"))
    assert cells.count() == 1 and total.first().reads == 5
    report = {"schema_version": 4, "mode": "plate", "input_read_pairs": 9, "read_fates": {"dna_assigned": 5, "short": 4}, "samples": [{"sample_name": "p", "cell_sample_id": "p_A1", "dna_read_count": 5}]}
    r = R.demux_report(spark, put(tmp_path / "r.json", json.dumps(report)))
    assert r.first().read_fates.dna_assigned == 5 and R.demux_report_samples(r).first().cell_sample_id == "p_A1"


def test_genomic_texts(spark, tmp_path):
    b = R.bed(spark, put(tmp_path / "a.bed", "chr1\t1\t2.0\n#chr2\t1\t2\n")).collect()
    assert [tuple(x) for x in b] == [("chr1", 1, 2)]
    with pytest.raises(Exception, match="no whole number"):
        R.bed(spark, put(tmp_path / "b.bed", "chr1\t1\t2.5\n")).collect()
    assert R.fai(spark, put(tmp_path / "a.fai", "chr1\t100\t5\t60\t61\n")).first() == ("chr1", 100)
    assert sorted(map(tuple, R.fasta(spark, put(tmp_path / "a.fa", ">chr1 x\nacg\ncgt\n>chr2\nTT\n")).collect())) == [("chr1", 0, 0, "ACGCGT"), ("chr2", 0, 0, "TT")]
    g = R.gtf_genes(spark, put(tmp_path / "a.gtf", '#c\nchr1\ts\tgene\t11\t50\t.\t-\t.\tgene_id "G1"; gene_type "protein_coding";\nchr1\ts\texon\t1\t2\t.\t+\t.\tgene_id "G1";\n')).first()
    assert tuple(g) == ("G1", "chr1", 10, 50, "-", "protein_coding")
    v = R.vcf(spark, put(tmp_path / "a.vcf", "##x\n#CHROM\nchr1\t5\t.\tC\tT\t9\tPASS\tCX=CG;DP=3\tGT:SP\t0/1:C3Y2\n")).first()
    assert v.info["CX"] == "CG" and v.pos == 5
    assert R.bsconv(spark, put(tmp_path / "a.bs", '1\t2\t3\t4\t5\t6\t7\t8\tq"1\n')).first().qname == 'q"1'
    p = R.mpileup(spark, put(tmp_path / "a.pile", "chr1\t5\tC\t2\tCT\tI5\t1,2\tAC,GT\t1F,2R\n")).first()
    assert p.bases == ["C", "T"] and p.quals == [40, 20] and p.umis == ["AC", "GT"]
    c = R.droplet_counts(spark, put(tmp_path / "c.tsv", "barcode\tcount\tbelow_q20\tq30\nAGT\t3\t1,2,0\t0,0,1\n")).first()
    assert c.below_q20 == [1, 2, 0]


def test_reports(spark, tmp_path):
    t = R.trimming_report(spark, put(tmp_path / "t.json", json.dumps({"read_counts": {"input": 200, "output": 150, "read1_with_adapter": 50}}))).first()
    assert tuple(t)[:3] == (200, 150, 25.0)
    assert R.report_value(spark, put(tmp_path / "a.txt", "Sequence pairs analysed in total:\t1,234\nx\n"), "Sequence pairs analysed in total").first().value == 1234
    r = R.context_report("Total methylated C's in CHG context: 1,0\nTotal C to T conversions in CHG context: 30\nTotal methylated C's in CHH context: 0\n")
    assert r["methyl_CHG"] == 10 and r["non_cpg_pct"] == 25.0
    path = put(tmp_path / "s.tsv", "a\tb\nx\t1\n")
    good = hashlib.sha256((tmp_path / "s.tsv").read_bytes()).hexdigest()
    assert tuple(R.sealed(spark, path, good, "a string, b long").first()) == ("x", 1)
    with pytest.raises(Exception, match="not the sealed file"):
        R.sealed(spark, path, "0" * 64, "a string, b long").collect()


def test_spool_and_delivery_are_checked(spark, tmp_path):
    rows = spark.createDataFrame([(f"b{k % 40}", k) for k in range(200)], "barcode string, n long")
    W.write_spool(rows, f"{tmp_path}/s", shards=4)
    assert sorted((r.barcode, r.n) for r in R.spool(spark, f"{tmp_path}/s").collect()) == sorted((f"b{k % 40}", k) for k in range(200))
    rows.limit(1).withColumn("shard", F.lit(2)).write.mode("append").partitionBy("shard").parquet(f"{tmp_path}/s/shards")
    with pytest.raises(Exception, match="not as it was written"):
        R.spool(spark, f"{tmp_path}/s").collect()
    rows.write.parquet(f"{tmp_path}/staged")
    W.publish(spark, f"{tmp_path}/staged", f"{tmp_path}/public")
    assert R.published(spark, f"{tmp_path}/public").count() == 200
    file = next((tmp_path / "public").glob("generation-*/*.parquet"))
    file.write_bytes(file.read_bytes() + b"x")
    (file.parent / f".{file.name}.crc").unlink()
    with pytest.raises(ValueError, match="inventory"):
        R.published(spark, f"{tmp_path}/public")


def test_blocks_of_text_files(spark, tmp_path):
    """Plain files are read in blocks: places and ordinals don't depend on where they end."""
    import random

    rng = random.Random(3)
    contigs = {f"c{k}": "".join(rng.choice("acgtn") for _ in range(n)) for k, n in enumerate((30_000, 1, 8192, 8193, 20_000, 16384))}
    text = "lost\n"
    for name, seq in contigs.items():
        text += f">{name} about it\n"
        at = 0
        while at < len(seq):
            n = rng.choice((1, 60, 61, 700))
            text += seq[at : at + n] + "\n"
            at += n
    reads = [("r%d" % k, "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 90)))) for k in range(500)]
    fq = put(tmp_path / "a.fq", "".join(f"@{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in reads))
    path = put(tmp_path / "a.fa", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "7000", "513"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0" if size != old else "4194304")
            chunks = R.fasta(spark, path)
            got = {(r.chrom, r.chunk): (r.start, r.seq) for r in chunks.collect()}
            want = {(c, k): (k * Q.WIDTH, s.upper()[k * Q.WIDTH : (k + 1) * Q.WIDTH + 1]) for c, s in contigs.items() for k in range(-(-len(s) // Q.WIDTH))}
            assert got == want
            found = R.fastq(spark, [fq], 1).orderBy("ordinal").collect()
            assert [(r.ordinal, r.id, r.seq) for r in found] == [(k, i, s) for k, (i, s) in enumerate(reads)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", "4194304")
    chunks = R.fasta(spark, path)
    assert {r.chrom: r.len for r in Q.lengths(chunks).collect()} == {c: len(s) for c, s in contigs.items()}
    with pytest.raises(Exception, match="contig in both"):
        Q.appended(chunks, chunks.where("chrom = 'c1'")).collect()
    for broken in ("@a\nAC\n+\nI\n", "@a\nAC\n+\n", "a\nAC\n+\nII\n"):
        with pytest.raises(Exception, match="malformed FASTQ"):
            R.fastq(spark, [put(tmp_path / "b.fq", broken)], 1).collect()


def test_sinks(spark, tmp_path):
    cpg = spark.createDataFrame([("S1", "chr1", 5, 1, 2), ("S1", "chr1", 4, 0, 0), ("S2", "chr1", 3, 1, 0)], schemas.CPG)
    W.cpg_parquet(cpg, f"{tmp_path}/p", shift=1)
    assert sorted((r.sample_id, r.pos) for r in spark.read.parquet(f"{tmp_path}/p").collect()) == [("S1", 6), ("S2", 4)]
    W.cpg_text(cpg, f"{tmp_path}/t")
    assert spark.read.options(header=True, sep="\t").csv(f"{tmp_path}/t").count() == 2
    reads = spark.createDataFrame([("S1", 1, 0, "r", "AC", "II")], "sample_id string, lane int, ordinal long, id string, seq string, qual string")
    W.reads_by_cell(reads, f"{tmp_path}/f")
    assert [r.value for r in spark.read.text(f"{tmp_path}/f/sample_id=S1").collect()] == ["@r", "AC", "+", "II"]
    means = spark.createDataFrame([("S1", "chr1", 9, 11, 0.5), ("S2", "chr1", 9, 11, 0.0)], "sample_id string, chrom string, start long, stop long, mean_fraction double")
    W.matrix(means, spark.createDataFrame([("S1",), ("S2",)], "sample_id string"), f"{tmp_path}/m")
    W.subset_matrix(spark, f"{tmp_path}/m", f"{tmp_path}/m2", spark.createDataFrame([("S2",)], "sample_id string"))
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/m2/x").collect()] == [("S2", "chr1:10-11", 0.0)]
    W.update_obs(spark.createDataFrame([("S1", "new")], "sample_id string, note string"), f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m/obs").columns == ["sample_id", "note"]
    W.packed_counts(cpg.where("pos = 5"), f"{tmp_path}/k")
    assert spark.read.parquet(f"{tmp_path}/k").first().packed == (1 << 16) | 3
    W.one_file(cpg, f"{tmp_path}/o", ["sample_id", "pos"])
    with pytest.raises(Exception):
        W.one_file(cpg, f"{tmp_path}/o", ["nope"])
    assert W.append_batch(cpg, f"{tmp_path}/b", "1") and not W.append_batch(cpg, f"{tmp_path}/b", "1") and W.append_batch(cpg, f"{tmp_path}/b", "2")
    assert spark.read.parquet(f"{tmp_path}/b").count() == 6
    cpg.write.parquet(f"{tmp_path}/staged")
    W.publish(spark, f"{tmp_path}/staged", f"{tmp_path}/public")
    inv = D.inventory(spark, f"{tmp_path}/public").collect()
    assert inv and all(len(r.sha256) == 64 for r in inv) and not (tmp_path / "staged").exists()
    assert R.file_listing(spark, f"{tmp_path}/public", "*.parquet").count() == len(inv)


def test_incremental_counts(spark, tmp_path):
    one = spark.createDataFrame([("S1", "chr1", 5, 1, 2)], schemas.CPG)
    one.write.parquet(f"{tmp_path}/in/b1")
    src = lambda: T.stream(spark, f"{tmp_path}/in/*", schemas.CPG)
    T.run_into(T.stream(spark, f"{tmp_path}/in/*", schemas.CPG), f"{tmp_path}/out", f"{tmp_path}/ck")
    one.write.parquet(f"{tmp_path}/in/b2")
    T.run_into(src(), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert T.cell_totals(spark.read.parquet(f"{tmp_path}/out")).first().rows == 2
    log = spark.createDataFrame([("[1] rule a: started",), ("noise",), ("[2] rule a: done",)], "value string")
    assert tuple(T.latest_states(T.log_events(log)).first()) == ("a", "done", 0)


def test_zstd_counts(spark, tmp_path):
    import os

    import zstandard

    rows = [(f"S{k % 5}", f"chr{k % 3}", k, k % 7 + 1, 3) for k in range(4000)]
    files = W.cpg_zst(spark.createDataFrame(rows, "sample_id string, chrom string, pos long, methyl long, unmethyl long"), f"file://{tmp_path}/z").collect()
    assert sum(f.rows for f in files) == 4000 and {f.file for f in files} == {f for f in os.listdir(f"{tmp_path}/z") if f.endswith(".zst")}
    assert sorted(map(tuple, R.cpg_tables(spark, f"{tmp_path}/z/*.zst").collect())) == sorted(rows)
    assert sorted(map(tuple, Z.cpg_zst(spark, f"file://{tmp_path}/z").collect())) == sorted(rows)
    # several frames in one file are one text; cut and damaged ones fail, at any frame
    whole = open(f"{tmp_path}/z/{files[0].file}", "rb").read()
    packed = lambda text: zstandard.ZstdCompressor(write_checksum=True).compress(text)
    more = packed(b"chr9\t5\t1\t1\nchr9\t6\t1\t1")
    os.makedirs(f"{tmp_path}/y")

    def read(data):
        with open(f"{tmp_path}/y/x.cpg.tsv.zst", "wb") as f:
            f.write(data)
        return Z.cpg_zst(spark, f"{tmp_path}/y").select("sample_id", "pos").collect()

    assert len(read(whole + more)) == files[0].rows + 2 and read(whole + more)[0].sample_id == "x"
    half = len(whole) // 2
    for data in (whole[:-1], whole[:half], whole[:half] + bytes([whole[half] ^ 4]) + whole[half + 1 :], whole + more[:-3], whole + more[:3], whole + b"xx", more, packed(b"chrom\tpos\tmethyl\tunmethyl\nchr1\t1\t-1\t2\n")):
        with pytest.raises(Exception, match="cut off|zst|invalid line|frame"):
            read(data)


def _scanned(df):
    """Files and rows that the scan of a plan read, once it has run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scan = next(leaves.apply(k) for k in range(leaves.size()) if "FileScan" in leaves.apply(k).toString())
    return tuple(int(scan.metrics().apply(k).value()) for k in ("numFiles", "numOutputRows"))


def test_csr_blocks(spark, tmp_path):
    import random

    rng = random.Random(6)
    cells = spark.createDataFrame([(f"S{k:02d}",) for k in range(40)], "sample_id string")
    rows = [(f"S{s:02d}", f"chr{i % 3}", 10 * i, 10 * i + 5, rng.choice([0.0, 0.5, 1.0])) for s in range(38) for i in range(90) if rng.random() < 0.3]
    means = spark.createDataFrame(rows, "sample_id string, chrom string, start long, stop long, mean_fraction float")
    path = f"{tmp_path}/m"
    Y.write_csr(means, cells, path, rows=4, cols=16)
    values = lambda df: sorted((r.sample_id, r.chrom, r.start, r.stop, r.mean_fraction) for r in df.collect())
    assert values(Y.read_csr(spark, path)) == sorted(rows)
    for b in spark.read.schema(Y.X).parquet(f"{path}/x").collect():
        assert len(b.indptr) == 5 and b.indptr[0] == 0 and b.indptr[-1] == len(b.indices) == len(b["values"])
        assert all(list(b.indices[x:y]) == sorted(set(b.indices[x:y])) for x, y in zip(b.indptr, b.indptr[1:]))
    # a part reads its blocks only
    some, feature = cells.where("sample_id in ('S05', 'S06')"), spark.read.parquet(f"{path}/var").where("chrom = 'chr1' and start < 100")
    want = [r for r in sorted(rows) if r[0] in ("S05", "S06")]
    assert values(Y.read_csr(spark, path, some)) == want
    assert values(Y.read_csr(spark, path, some, feature)) == [r for r in want if r[1] == "chr1" and r[2] < 100]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole = _scanned(Y.blocks_of(spark, path))
        assert whole[1] == spark.read.parquet(f"{path}/x").count() > 50
        part = _scanned(Y.blocks_of(spark, path, some))
        assert part[1] <= 6 and part[0] < whole[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    Y.subset_csr(spark, path, f"{tmp_path}/n", some.unionByName(cells.where("sample_id = 'S39'")), feature)
    assert values(Y.read_csr(spark, f"{tmp_path}/n")) == [r for r in want if r[1] == "chr1" and r[2] < 100]
    assert spark.read.parquet(f"{tmp_path}/n/obs").count() == 3
    with pytest.raises(Exception, match="two values"):
        Y.write_csr(means.unionByName(means), cells, f"{tmp_path}/twice")


def test_lines_of_one_large_block_are_numbered_by_many_tasks(spark):
    lines = spark.range(20000).select(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("id").alias("n"), F.expr("case when id % 9000 = 5 then concat('>c', id) else repeat('A', cast(id % 7 as int)) end").alias("value"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = Q.placed_lines(lines).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    want, chrom, at = [], None, 0
    for k in range(20000):
        if k % 9000 == 5:
            chrom, at = f"c{k}", 0
        elif chrom and k % 7:
            want.append((chrom, at, "A" * (k % 7)))
            at += k % 7
    assert sorted((r.chrom, r.at, r.seq) for r in got) == sorted(want)
    assert len({r.task for r in got}) > 1


def test_csr_of_counts_exchanges_no_value(spark, tmp_path):
    """Records are made where sites meet intervals, hold all that unfolding them takes, and are cut where they lie."""
    import random

    from methlake.operators import cpg as C

    rng = random.Random(9)
    cells = spark.createDataFrame([(f"S{k:02d}",) for k in range(30)], "sample_id string")
    counts = [(f"S{s:02d}", c, p, rng.randrange(4), rng.randrange(1, 4)) for s in range(32) for c in ("chr1", "chr2", "lambda") for p in sorted(rng.sample(range(1, 70000), 25))]
    cpg = spark.createDataFrame(counts, "sample_id string, chrom string, pos long, methyl long, unmethyl long")
    spans = [(c, a, a + rng.choice([0, 1, 900, 40000])) for c in ("chr1", "chr2", "chr3", "lambda") for a in (rng.randrange(69000) for _ in range(60))]
    intervals = spark.createDataFrame(spans + spans[:20], "chrom string, start long, stop long")
    path, values = f"{tmp_path}/m", lambda df: sorted((r.sample_id, r.chrom, r.start, r.stop, r.mean_fraction) for r in df.collect())
    Y.write_counts(cpg, intervals, cells, path, rows=4, cols=8)
    want = values(C.interval_means(cpg, intervals).join(cells, "sample_id"))
    got = Y.read_csr(spark, path)
    assert values(got) == want and len(want) > 500
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    records = spark.read.schema(Y.X).parquet(f"{path}/x").collect()
    assert max(len(r.starts) for r in records) == 8 and all(list(zip(r.starts, r.stops)) == sorted(zip(r.starts, r.stops)) for r in records)
    assert all(list(r.indices[x:y]) == sorted(set(r.indices[x:y])) for r in records for x, y in zip(r.indptr, r.indptr[1:]))
    var = spark.read.parquet(f"{path}/var")
    assert var.count() == len({s for s in spans if s[0] != "lambda" and s[1] < s[2]})
    some = cells.where("sample_id in ('S01', 'S02', 'S09', 'S28')")
    Y.subset_csr(spark, path, f"{tmp_path}/n", some)
    assert values(Y.read_csr(spark, f"{tmp_path}/n")) == [r for r in want if r[0] in ("S01", "S02", "S09", "S28")]
    assert values(Y.read_csr(spark, f"{tmp_path}/n", some.where("sample_id = 'S09'"), var.where("chrom = 'chr2'"))) == [r for r in want if r[:2] == ("S09", "chr2")]
    assert {r.row_block for r in spark.read.schema(Y.X).parquet(f"{tmp_path}/n/x").collect()} == {0}


@pytest.mark.parametrize("step", ["_move", "_list", "_point"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_publisher_that_breaks_off(spark, tmp_path, monkeypatch, step, when):
    """Readers have the old delivery or the new one, and the next publisher is not in the way of either."""
    public = f"{tmp_path}/public"

    def put(n):
        spark.range(n).coalesce(1).write.parquet(f"{tmp_path}/staged-{n}")
        return D.publish(spark, f"{tmp_path}/staged-{n}", public)

    put(3)
    held = D.published(spark, public)
    real, calls = getattr(D, step), []

    def broken(*args):
        calls.append(args)
        if when == "after":
            real(*args)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(D, step, broken)
        with pytest.raises(KeyboardInterrupt):
            put(4)
    assert calls and D.published(spark, public).count() == (4 if (step, when) == ("_point", "after") else 3)
    put(5)
    assert D.published(spark, public).count() == 5 and held.count() == 3
    assert D.retire(spark, public) >= 1
    assert D.published(spark, public).count() == 5 and len(list((tmp_path / "public").glob("generation-*"))) == 1


def test_digest_of_a_large_file(spark, tmp_path):
    (tmp_path / "f").mkdir()
    size = (3 << 30) + 5
    with open(tmp_path / "f" / "large.bin", "wb") as f:
        f.truncate(size)
    h, block = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        h.update(block)
    h.update(bytes(size & (1 << 24) - 1))
    assert [tuple(r)[1:] for r in R.file_digests(spark, f"{tmp_path}/f").collect()] == [(size, h.hexdigest())]


def test_contig_over_several_fasta_files(spark, tmp_path):
    (tmp_path / "fa").mkdir()
    for name, text in (("part-0", ">c0 x\nacg\ncg"), ("part-1", "tt\nA\n"), ("part-2", "C\n>c1\nGG\n"), ("part-3", "T\n")):
        (tmp_path / "fa" / name).write_text(text)
    got = sorted((r.chrom, r.start, r.seq) for r in R.fasta(spark, f"{tmp_path}/fa", one=True).collect())
    assert got == [("c0", 0, "ACGCGTTAC"), ("c1", 0, "GGT")]


@pytest.mark.parametrize("name", ["A4_scan_fastq", "A3_compressed_text", "A21_scan_fasta"])
def test_written_inputs_grow_in_files(spark, tmp_path, monkeypatch, name):
    """More bytes are more files, so that no one task writes or reads them all."""
    from methlake.plans import registry
    from methlake.plans import io_queries, sequence_queries

    paths = []
    for module in (io_queries, sequence_queries):
        monkeypatch.setattr(module, "place", lambda _: paths.append(f"{tmp_path}/{len(paths)}") or paths[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len([p for p in os.listdir(paths[0]) if p.startswith("part-")]) > 3


@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_records_of_many_blocks_are_made_together(monkeypatch, most):
    """Values of rows in any order of tiles, in blocks that go on over entries, with and without numbers of the intervals."""
    import random

    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(Y, "MOST", most)
    rng = random.Random(most)
    for numbers in (True, False):
        for far in (1, 1 << 35):
            spans = [("chr1", far * (5 * i // 2), far * (5 * i // 2) + 3 + i % 2) for i in range(60)] + [("chr2", 7 * i, 7 * i + 9) for i in range(20)]
            want, entries = {}, []
            # tiles of the contigs, in each the rows in order
            for chrom, low, high in (("chr1", 0, 25), ("chr1", 25, 60), ("chr2", 0, 20)):
                runs = [(row, sorted(rng.sample(range(low, high), rng.randrange(1, 12)))) for row in range(14) if rng.random() < 0.7]
                at = 0 if chrom == "chr1" else 60
                while runs:
                    now, runs = runs[: (k := rng.randrange(1, 5))], runs[k:]
                    value = np.array([rng.random() for _, js in now for _ in js], "float32")
                    own = [s for s in spans if s[0] == chrom]
                    table = (*(np.array([s[k] for s in own], "int64") for k in (1, 2)), np.arange(at, at + len(own)) if numbers else None)
                    entries.append((pa.array([f"S{row}" if row else None for row, _ in now], pa.string()), pa.array([chrom] * len(now)), np.array([row for row, _ in now]), np.array([len(js) for _, js in now]), value, np.array([j for _, js in now for j in js]), table))
                    for (row, chrom_, j), v in zip([(row, chrom, j) for row, js in now for j in js], value.tolist()):
                        want[row, *own[j]] = v
            got = {}
            for batch in Y._records(iter(entries), 4, 8, 2):
                for r in batch.to_pylist():
                    assert len(r["cells"]) == 4 and len(r["indptr"]) == 5 and 0 < len(r["starts"]) <= 8 and r["part"] == r["row_block"] // 2
                    assert (r["first"], r["last"]) == (r["starts"][0], r["starts"][-1]) and list(zip(r["starts"], r["stops"])) == sorted(set(zip(r["starts"], r["stops"])))
                    for k in range(4):
                        a, b = r["indptr"][k : k + 2]
                        row = 4 * r["row_block"] + k
                        assert r["indices"][a:b] == sorted(set(r["indices"][a:b])) and (a == b or r["cells"][k] == (f"S{row}" if row else None))
                        for i, v in zip(r["indices"][a:b], r["values"][a:b]):
                            assert (key := (row, r["chrom"], r["starts"][i], r["stops"][i])) not in got
                            got[key] = v
            assert got == want


def test_matrix_of_counts_keeps_a_cell_without_a_name(spark, tmp_path):
    cpg = spark.createDataFrame([(None, "chr1", 11, 1, 1), ("", "chr1", 12, 0, 1), ("S1", "chr1", 13, 1, 0)], "sample_id string, chrom string, pos long, methyl long, unmethyl long")
    intervals = spark.createDataFrame([("chr1", 10, 12), ("chr1", 10, 90)], "chrom string, start long, stop long")
    Y.write_counts(cpg, intervals, cpg, f"{tmp_path}/m")
    got = sorted((r.sample_id, r.feature, r.mean_fraction) if r.sample_id is not None else ("~", r.feature, r.mean_fraction) for r in Y.read_csr(spark, f"{tmp_path}/m").collect())
    assert got == [("", "chr1:11-12", 0.0), ("", "chr1:11-90", 0.0), ("S1", "chr1:11-90", 1.0), ("~", "chr1:11-12", 0.5), ("~", "chr1:11-90", 0.5)]
    # lists of numbers take one repeated field and so one call for a value
    file = next((tmp_path / "m" / "x").glob("part=*/*.parquet"))
    assert not pq.read_schema(file).field("indices").type.value_field.nullable


@pytest.mark.parametrize("name", ["B7_write_single_cpg", "B14_csr_subset"])
def test_means_of_single_cpgs_are_read_from_blocks(spark, name):
    from methlake.plans.registry import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "indptr" in plan and "Exchange" not in plan
