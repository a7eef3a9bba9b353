"""Project, cell and final manifests, demultiplexing reports and deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from methlake.functions.text import natural_order


def expand_cells(manifest: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Every project sample with every barcode of its plate map, which is the result's size; a map of bounded size is broadcast. sample_id is project and plate."""
    from methlake.operators.reads import bounded

    return manifest.crossJoin(bounded(barcodes)).withColumn("sample_id", F.concat_ws("_", "project_sample_id", "plate_id"))


def expand_droplet_cells(manifest: DataFrame, called: DataFrame) -> DataFrame:
    """Every project sample with its own called barcodes; no plate, cells numbered in barcode order by count."""
    order = F.row_number().over(Window.partitionBy("project_sample_id").orderBy(F.desc("count"), "barcode"))
    return manifest.join(called, "project_sample_id").withColumn("cell_order", order.cast("string")).withColumn("plate_id", F.lit("")).withColumn("sample_id", F.concat_ws("_", "project_sample_id", "barcode"))


def cell_status(reads, threshold: int):
    """Zero_Output, Low_Reads_Removed or Pass."""
    c = F.col(reads)
    return F.when(c == 0, "Zero_Output").when(c < threshold, "Low_Reads_Removed").otherwise("Pass")


def demux_manifest(cells: DataFrame, threshold: int) -> DataFrame:
    """Cells with reads and status, and a last row __SUMMARY__ with the totals."""
    body = cells.select("project_sample_id", "sample_id", "plate_id", "cell_order", F.coalesce("reads", F.lit(0)).cast("long").alias("reads"))
    body = body.withColumn("status", cell_status("reads", threshold))
    total = body.agg(F.lit("__SUMMARY__").alias("project_sample_id"), F.lit("").alias("sample_id"), F.lit("").alias("plate_id"), F.lit("").alias("cell_order"), F.coalesce(F.sum("reads"), F.lit(0)).cast("long").alias("reads"), F.lit("").alias("status"))
    return body.unionByName(total)


def ordered(cells: DataFrame) -> DataFrame:
    """By project, cell order (numbers first), plate and id."""
    return cells.orderBy("project_sample_id", *natural_order("cell_order"), "plate_id", "sample_id")


def refresh(existing: DataFrame, discovered: DataFrame) -> DataFrame:
    """Manifest rows of the samples now found: known ones keep their values, new ones get nulls, lost ones go; status says which."""
    j = existing.join(discovered.select("sample_id", F.lit(True).alias("found")), "sample_id", "full_outer")
    known = F.col("project_sample_id").isNotNull()
    return j.select("sample_id", "project_sample_id", F.when(known & F.col("found"), "kept").when(known, "lost").otherwise("new").alias("status"))


def map_fastq(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Registered raw samples with their files; files of unregistered samples are skipped."""
    return manifest.join(found, "dna_raw_sample")


def missing_fastq(manifest: DataFrame, found: DataFrame) -> DataFrame:
    return manifest.join(found.select("dna_raw_sample").distinct(), "dna_raw_sample", "left_anti")


def merge_generations(cells: DataFrame, demux: DataFrame) -> DataFrame:
    """Cells with their demultiplexing rows, and whether the project agrees."""
    d = demux.select("sample_id", F.col("project_sample_id").alias("demux_project"), "reads", "status")
    return cells.join(d, "sample_id", "left").withColumn("agrees", F.coalesce(F.col("demux_project") == F.col("project_sample_id"), F.lit(True)))


def final_manifest(cells: DataFrame, demux: DataFrame, metrics: list[DataFrame]) -> DataFrame:
    """Cells with demultiplexing results and the metrics of all protocols; columns that a protocol lacks are null."""
    merged = None
    for m in metrics:
        merged = m if merged is None else merged.unionByName(m, allowMissingColumns=True)
    out = merge_generations(cells, demux).where("agrees").drop("agrees", "demux_project")
    return ordered(out if merged is None else out.join(merged, "sample_id", "left"))


def fastq_groups(files: DataFrame) -> DataFrame:
    """sample, segment, r1, r2 of file paths: ``<sample>_L<lane>_R<1|2>[_<chunk>].f(ast)q.gz`` or ``<sample>_R<1|2>.f(ast)q.gz`` or with ``_1``/``_2``."""
    name = F.element_at(F.split("path", "/"), -1)
    pattern = r"^(.+?)(?:_(L[0-9]+))?_R?([12])(?:_([0-9]+))?\.(?:fastq|fq)\.gz$"
    part = lambda k: F.nullif(F.regexp_extract(name, pattern, k), F.lit(""))
    rows = files.select("path", F.regexp_replace(part(1), "^样本_", "").alias("sample"), F.concat_ws("_", part(2), part(4)).alias("segment"), part(3).alias("mate")).where("sample is not null")
    return rows.groupBy("sample", "segment").pivot("mate", ["1", "2"]).agg(F.min("path")).withColumnsRenamed({"1": "r1", "2": "r2"})


def append_plan(batches: DataFrame) -> DataFrame:
    """Files (sample, mate, segment, path, sha256) in the order they are appended, with those whose content was seen before in the sample marked."""
    w = Window.partitionBy("sample", "mate")
    repeated = F.count("*").over(Window.partitionBy("sample", "mate", "sha256")) > 1
    return batches.withColumn("step", F.row_number().over(w.orderBy("segment", "path"))).withColumn("repeated", repeated)


def retained_files(cells: DataFrame, kinds: list[str]) -> DataFrame:
    """path of each file kind of each passing cell."""
    return cells.where("status = 'Pass'").select("sample_id", F.explode(F.array(*map(F.lit, kinds))).alias("kind")).select(F.concat(F.col("sample_id"), F.lit("."), F.col("kind")).alias("path"))


def stale_files(present: DataFrame, allowed: DataFrame) -> DataFrame:
    return present.join(allowed.select("path").distinct(), "path", "left_anti")


def report_sample(cells: DataFrame, n: int = 1000) -> DataFrame:
    """The n cells first by the SHA-256 of their id."""
    return cells.orderBy(F.sha2("sample_id", 256), "sample_id").limit(n)


def report_section(rows: DataFrame, ident: str, key: str, columns: list[str]) -> DataFrame:
    """A report's section as a table: id, key, value (the JSON object of the columns), a row for each key."""
    return rows.select(F.lit(ident).alias("id"), F.col(key).alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def restrict_section(section: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of a section (id, key, value) whose key is among the sampled cells."""
    return section.join(cells.select(F.col("sample_id").alias("key")).distinct(), "key", "left_semi").select("id", "key", "value")


def section_json(section: DataFrame, most: int = 1000) -> DataFrame:
    """id, data: each section as one JSON object, keys in order. For restricted sections: more than ``most`` rows fail before anything is gathered."""
    if section.limit(most + 1).count() > most:
        raise ValueError(f"a report shows {most} cells at most")
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    lines = F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return section.groupBy("id").agg(F.concat(F.lit("{"), F.array_join(lines, ","), F.lit("}")).alias("data"))


def attach_metrics(cells: DataFrame, metrics: DataFrame, key: str = "sample_id") -> DataFrame:
    """cells with the metrics of their row, if they have one: a metric that is there replaces the cell's own value, others stay."""
    new = [c for c in metrics.columns if c != key]
    j = cells.join(metrics.withColumnsRenamed({c: f"__{c}" for c in new}), key, "left")
    kept = [F.coalesce(f"__{c}", c).alias(c) if c in new else F.col(c) for c in cells.columns]
    return j.select(*kept, *[F.col(f"__{c}").alias(c) for c in new if c not in cells.columns])


def set_differences(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key, side of what only one of two tables has: ``missing`` (expected, not found) or ``extra``."""
    a, b = expected.select(key).distinct(), found.select(key).distinct()
    j = a.withColumn("a", F.lit(True)).join(b.withColumn("b", F.lit(True)), key, "full_outer")
    return j.where("a is null or b is null").select(key, F.when(F.col("b").isNull(), "missing").otherwise("extra").alias("side"))


def numbered(rows: DataFrame, *order, name: str = "place") -> DataFrame:
    """rows with their place (from 0) in the given order. The order is by ranges, each sorted in its own task; a place is a prefix sum over one row for each range."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the identifier holds the range in its upper bits and the place in it in the lower 33
    s = _cut(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()))
    part = F.shiftright("__m", 33)
    sizes = s.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    base = sizes.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    j = s.withColumn("__p", part).join(F.broadcast(base), "__p")
    return j.withColumn(name, F.col("__base") + F.col("__m").bitwiseAND((1 << 33) - 1)).drop("__p", "__m", "__base")


def id_set_digests(rows: DataFrame, group: str, key: str) -> DataFrame:
    """group, digest: SHA-256 of a group's ids in order, a line each. The ids stream through the hash (a chain, so one task reads a group, but holds one id at a time)."""
    import hashlib

    import pyarrow as pa

    def run(batches):
        now, h, some = None, None, False
        for batch in batches:
            out = []
            for g, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not some or g != now:
                    if some:
                        out.append((now, h.hexdigest()))
                    now, h, some = g, hashlib.sha256(), True
                h.update(i.encode() + b"\n")
            if out:
                yield pa.RecordBatch.from_pylist([{group: a, "digest": d} for a, d in out], schema)
        if some:
            yield pa.RecordBatch.from_pylist([{group: now, "digest": h.hexdigest()}], schema)

    schema = pa.schema([(group, pa.string()), ("digest", pa.string())])
    slim = rows.where(F.col(key).isNotNull()).select(F.col(group).cast("string").alias(group), F.col(key).cast("string").alias(key))
    return slim.repartition(group).sortWithinPartitions(group, key).mapInArrow(run, f"`{group}` string, digest string")


def short_labels(rows: DataFrame, column: str) -> DataFrame:
    """rows with ``label``: the column without the prefix and suffix that all its values have in common, or as it is unless something of each is left.

    The least and the greatest text share what all texts share, so four texts are enough: those of the column and of its reversal.
    """
    x = F.col(column)

    def common(a: str, b: str):
        n = F.least(F.length(a), F.length(b))
        differ = F.expr(f"array_position(transform(sequence(1, greatest(least(length({a}), length({b})), 1)), i -> substring({a}, i, 1) <> substring({b}, i, 1)), true)")
        return F.when(n == 0, 0).when(differ > 0, differ - 1).otherwise(n).cast("int")

    ends = rows.agg(F.min(x).alias("a"), F.max(x).alias("b"), F.min(F.reverse(x)).alias("c"), F.max(F.reverse(x)).alias("d"), F.min(F.length(x)).alias("n"))
    cut = ends.select("a", "b", "n", common("a", "b").alias("head"), common("c", "d").alias("tail"))
    cut = cut.select(F.when((F.col("a") != F.col("b")) & (F.col("head") + F.col("tail") < F.col("n")), F.struct("head", "tail")).alias("__cut"))
    j = rows.join(F.broadcast(cut))
    return j.withColumn("label", F.when(F.col("__cut").isNull(), x).otherwise(F.expr(f"substring({column}, __cut.head + 1, length({column}) - __cut.head - __cut.tail)"))).drop("__cut")


def last_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, of rows that are equal in the order the greatest by its other columns: one aggregate, summed up before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    last = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"__last.{c}") for c in rows.columns])


def dependency_closure(edges: DataFrame, roots: DataFrame, max_rounds: int = 50) -> DataFrame:
    """name of everything the roots reach over edges (source, target), the roots included; one join a round until nothing new is found.

    Each round's rows are checkpointed (in the session's checkpoint folder), so that plans stay short.
    """
    edges = _cut(edges.select("source", "target"))
    seen = front = _cut(roots.select("name").distinct())
    for _ in range(max_rounds):
        front = _cut(front.join(edges, F.col("name") == F.col("source")).select(F.col("target").alias("name")).distinct().join(seen, "name", "left_anti"))
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)
    raise RuntimeError("the closure did not settle")


def _cut(df: DataFrame) -> DataFrame:
    """df, checkpointed. The folder is the session's spark.checkpoint.dir; a local session without one gets a temporary folder."""
    import tempfile

    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="methlake-"))
    return df.checkpoint()
