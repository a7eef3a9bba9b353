"""Scans. Text formats are read with explicit schemas: identity columns stay text, NA and leading zeros survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from methlake import schemas
from methlake.functions import numbers as N
from methlake.functions import text as X
from methlake.sources.delivery import file_digests, published  # noqa: F401


def _csv(spark: SparkSession, path, schema: str, sep: str = "\t", header: bool = True, **options) -> DataFrame:
    return spark.read.options(sep=sep, header=header, mode="FAILFAST", enforceSchema=False, **options).schema(schema).csv(path) if header else spark.read.options(sep=sep, mode="FAILFAST", **options).schema(schema).csv(path)


def cpg_tables(spark: SparkSession, path) -> DataFrame:
    """Per-cell count tables (chrom, pos, methyl, unmethyl; plain, gzip or zstd), with the cell's id from a folder ``sample_id=..`` or else from the file name."""
    rows = spark.read.options(sep="\t", header=True, mode="FAILFAST", enforceSchema=False, recursiveFileLookup=True).schema("chrom string, pos long, methyl long, unmethyl long").csv(path)
    name = F.url_decode(F.input_file_name())
    file = F.regexp_extract(F.element_at(F.split(name, "/"), -1), r"^(.*?)(?:\.\d{5})?\.(?:cpg\.)?(?:tsv|csv|txt)", 1)
    return rows.withColumn("sample_id", F.coalesce(F.nullif(F.regexp_extract(name, "/sample_id=([^/]+)/", 1), F.lit("")), file)).select("sample_id", "chrom", "pos", "methyl", "unmethyl")


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines of text files: file, block (the place of the scan's part in the file), n (counts up inside a block), value."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")


def fastq(spark: SparkSession, paths: list[str], mate: int) -> DataFrame:
    """lane, ordinal, mate, id, seq, qual of FASTQ files, one lane each in the order given; ordinals count from 0 in file order. A lane may be a folder or pattern: its files follow each other by name.

    A plain file is read in blocks by many tasks, a compressed one by one. The number of a line is its place in its block plus the lines of the blocks before, one row
    each. A record that breaks off, lacks its marks, or whose qualities are of another length fails.
    """
    from functools import reduce

    from pyspark.sql import Window

    lines = reduce(DataFrame.unionByName, [_lines(spark, path).withColumn("lane", F.lit(lane)) for lane, path in enumerate(paths, 1)])
    blocks = lines.groupBy("lane", "file", "block").agg(F.min("n").alias("first"), F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("lane").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = lines.join(blocks.withColumn("before", before), ["lane", "file", "block"]).withColumn("line", F.col("n") - F.col("first") + F.col("before"))
    part = [F.max(F.when(F.col("line") % 4 == k, F.col("value"))).alias(f"p{k}") for k in range(4)]
    r = at.groupBy("lane", F.floor(F.col("line") / 4).alias("ordinal")).agg(F.count("*").alias("n"), *part)
    whole = (F.col("n") == 4) & F.col("p0").startswith("@") & F.col("p2").startswith("+") & (F.length("p1") == F.length("p3"))
    ident = F.when(whole, F.substr("p0", F.lit(2))).otherwise(F.raise_error(F.concat(F.lit("malformed FASTQ record "), F.col("ordinal").cast("string"), F.lit(" of lane "), F.col("lane").cast("string"))).cast("string"))
    return r.select("lane", "ordinal", F.lit(mate).alias("mate"), ident.alias("id"), F.upper("p1").alias("seq"), F.col("p3").alias("qual"))


def fastq_pairs(spark: SparkSession, r1: list[str], r2: list[str]) -> DataFrame:
    """Both mates of paired files by lane and ordinal: lane, ordinal, id, seq1, seq2, problem. The scans are grouped by the keys of the join, which needs no further shuffle."""
    from methlake.operators.reads import mate_join

    if len(r1) != len(r2):
        raise ValueError("every lane needs both files")
    return mate_join(fastq(spark, r1, 1), fastq(spark, r2, 2))


def file_listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, size of the files under a folder (contents are not read)."""
    return spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder).select("path", F.col("length").alias("size_bytes"))


def barcode_map(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with DNA_Barcode, PlateID, Cell_Order in any case and order; other columns are kept. All text."""
    rows = spark.read.options(header=True, mode="FAILFAST", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).csv(path)
    clean = [c.strip().lstrip("﻿").lower() for c in rows.columns]
    if len(set(clean)) != len(clean) or "" in clean or {"dna_barcode", "plateid", "cell_order"} - set(clean):
        raise ValueError(f"barcode map columns: {rows.columns}")
    names = {"dna_barcode": "barcode", "plateid": "plate_id", "cell_order": "cell_order"}
    return rows.toDF(*[names.get(c, c) for c in clean])


def sample_manifest(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.MANIFEST, multiLine=True)


def cell_manifest(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.CELL_MANIFEST)


def demux_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(cells, the summary row)."""
    rows = _csv(spark, path, "project_sample_id string, sample_id string, plate_id string, cell_order string, reads long, status string")
    summary = F.col("project_sample_id") == "__SUMMARY__"
    return rows.where(~summary), rows.where(summary)


def demux_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DEMUX_REPORT).options(multiLine=True, mode="FAILFAST").json(path)


def demux_report_samples(report: DataFrame) -> DataFrame:
    return report.select("mode", F.explode("samples").alias("s")).select("mode", "s.*")


def mpileup(spark: SparkSession, path: str) -> DataFrame:
    """Pileup text (chrom, pos, ref, depth, bases, quals, readpos list, umi list, mate list) with parallel arrays."""
    from methlake.functions import sequence as S

    rows = _csv(spark, path, "chrom string, pos long, ref string, depth int, bases string, quals string, readpos string, umis string, mates string", header=False, quote="")
    split = lambda c: F.split(c, ",")
    return rows.select("chrom", "pos", S.letters("bases").alias("bases"), S.qualities("quals").alias("quals"), F.transform(split("readpos"), lambda x: x.cast("long")).alias("readpos"), split("umis").alias("umis"), split("mates").alias("mates"))


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """Single-sample VCF lines with their columns; INFO as a map."""
    cols = "chrom string, pos long, id string, ref string, alt string, qual string, filters string, info string, format string, sample string"
    return spark.read.options(sep="\t", comment="#", quote="").schema(cols).csv(path).withColumn("info", F.expr("str_to_map(info, ';', '=')"))


def cytosine_bed(spark: SparkSession, path: str) -> DataFrame:
    """Per-cytosine calls with a named header."""
    return spark.read.options(sep="\t", header=True, quote="", mode="FAILFAST").csv(path)


def bsconv(spark: SparkSession, path: str) -> DataFrame:
    """Eight counts and a read name per line; quotes are data."""
    return _csv(spark, path, "r0 long, c0 long, r1 long, c1 long, cg_r long, cg_c long, r2 long, c2 long, qname string", header=False, quote="")


def bed(spark: SparkSession, path: str, names: tuple[str, ...] = ("chrom", "start", "stop")) -> DataFrame:
    """Tab-separated intervals; starts and stops must be whole numbers (12.0 counts as 12), lines of contigs that start with # are left out."""
    rows = spark.read.options(sep="\t", quote="").schema(", ".join(f"{n} string" for n in names)).csv(path).where(~F.col("chrom").startswith("#"))
    whole = {n: F.coalesce(N.exact_integer(n), F.raise_error(F.concat(F.lit("no whole number: "), F.coalesce(n, F.lit("null")))).cast("long")) for n in ("start", "stop")}
    return rows.select(*[whole[n].alias(n) if n in whole else n for n in names])


def fai(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(sep="\t").schema("chrom string, len long, a long, b long, c long").csv(path).select("chrom", "len")


def gtf_genes(spark: SparkSession, path: str) -> DataFrame:
    """gene, chrom, g_start (0-based), g_end, strand, biotype of the gene lines."""
    cols = "chrom string, source string, feature string, first long, last long, score string, strand string, frame string, attributes string"
    rows = spark.read.options(sep="\t", comment="#", quote="").schema(cols).csv(path).where("feature = 'gene'")
    kind = F.coalesce(X.gtf_attribute("attributes", "gene_type"), X.gtf_attribute("attributes", "gene_biotype"))
    return rows.select(X.gtf_attribute("attributes", "gene_id").alias("gene"), "chrom", (F.col("first") - 1).alias("g_start"), F.col("last").alias("g_end"), "strand", kind.alias("biotype"))


def fasta(spark: SparkSession, path: str, one: bool = False) -> DataFrame:
    """Sequences in chunks (see operators.sequences), upper case, whatever the line breaks. A plain file is read in blocks by many tasks, a compressed one by one task.

    Each file of a folder stands for itself; with ``one`` they follow each other by name, and a contig goes on in the next.
    """
    from methlake.operators.sequences import chunked, placed_lines

    lines = _lines(spark, path)
    if one:
        lines = lines.withColumn("block", F.struct("file", "block")).withColumn("file", F.lit(path))
    return chunked(placed_lines(lines))


def droplet_counts(spark: SparkSession, path: str) -> DataFrame:
    """Barcode counts with comma lists of 17 numbers."""
    rows = _csv(spark, path, "barcode string, count long, below_q20 string, q30 string")
    numbers = lambda c: F.transform(F.split(c, ","), lambda x: x.cast("long")).alias(c)
    return rows.select("barcode", "count", numbers("below_q20"), numbers("q30"))


def report_value(spark: SparkSession, path: str, label: str) -> DataFrame:
    """path, value of a ``label: count`` line in whole-text reports (thousands may be grouped)."""
    text = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), "value")
    return text.select("path", N.grouped_count(F.regexp_extract("value", rf"(?m)^\s*{label}:?\s+([0-9,]+(?:\s*\([^)]*\))?)\s*$", 1)).alias("value"))


def trimming_report(spark: SparkSession, path: str) -> DataFrame:
    """Read pairs in and out and with adapters of trimming reports (JSON)."""
    schema = "read_counts struct<input: long, output: long, read1_with_adapter: long, read2_with_adapter: long>"
    r = spark.read.schema(schema).option("multiLine", True).json(path)
    c = F.col("read_counts")
    return r.select(c["input"].alias("input_pairs"), c["output"].alias("trimmed_pairs"), F.try_divide(100.0 * c["read1_with_adapter"], c["input"]).alias("adapter1_pct"), F.try_divide(100.0 * c["read2_with_adapter"], c["input"]).alias("adapter2_pct"))


def context_report(text: str) -> dict[str, float | None]:
    """Methylated and unmethylated calls by context, and the non-CpG percentage, of a splitting report's text (driver side)."""
    import re

    out: dict[str, float | None] = {}
    for c in ("CpG", "CHG", "CHH"):
        for key, words in (("methyl", "Total methylated C's in"), ("unmethyl", "Total C to T conversions in")):
            m = re.search(rf"{words} {c} context:\s*([0-9,]+)", text)
            out[f"{key}_{c}"] = int(m[1].replace(",", "")) if m else None
    m = sum(out[f"methyl_{c}"] or 0 for c in ("CHG", "CHH"))
    u = sum(out[f"unmethyl_{c}"] or 0 for c in ("CHG", "CHH"))
    out["non_cpg_pct"] = 100.0 * m / (m + u) if m + u else None
    return out


def sealed(spark: SparkSession, path: str, sha256: str, schema: str) -> DataFrame:
    """A tab-separated file with a header whose SHA-256 must be the given one; the rows are parsed from the very bytes that are hashed.

    A hash is a chain, so one task reads the file, in blocks; it fails at the file's end if the bytes are others, and so does what is made of the rows.
    """
    import hashlib

    import pyarrow as pa

    from methlake.sources.delivery import STEP
    from methlake.sources.files import filesystem

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, inside = filesystem(name)
                h, held, skipped = hashlib.sha256(), b"", False
                with fs.open_input_file(inside) as f:
                    while True:
                        block = f.read(STEP)
                        h.update(block)
                        *lines, held = (held + block).split(b"\n")
                        if not block and held:
                            lines, held = [*lines, held], b""
                        if lines and not skipped:
                            lines, skipped = lines[1:], True
                        lines = [x.removesuffix(b"\r") for x in lines]
                        yield pa.RecordBatch.from_arrays([pa.array([x for x in lines if x], pa.binary()).cast(pa.string())], ["value"])
                        if not block:
                            break
                if h.hexdigest() != sha256:
                    raise ValueError(f"{name} is not the sealed file")

    lines = spark.createDataFrame([(path,)], "path string").coalesce(1).mapInArrow(run, "value string")
    return lines.select(F.from_csv("value", schema, {"sep": "\t", "mode": "FAILFAST"}).alias("r")).select("r.*")


def spool(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a spool (see sinks.write_spool) with their shard. A shard whose rows or checksum are not those of its manifest, or that only one of both has, fails."""
    from methlake.sources.sinks import shard_seals

    rows = spark.read.parquet(f"{path}/shards")
    want = spark.read.schema("shard long, rows long, checksum long").json(f"{path}/manifest")
    have = shard_seals(rows)
    same = (F.col("h.rows") == F.col("w.rows")) & (F.col("h.checksum") == F.col("w.checksum"))
    bad = have.alias("h").join(want.alias("w"), F.col("h.shard") == F.col("w.shard"), "full_outer").where(~F.coalesce(same, F.lit(False)))
    checked = rows.join(F.broadcast(bad.agg(F.count("*").alias("__broken"))))
    return checked.where(F.when(F.col("__broken") == 0, True).otherwise(F.raise_error(F.lit("a shard of the spool is not as it was written")).cast("boolean"))).drop("__broken")
