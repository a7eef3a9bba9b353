"""Deliveries in generations: a reader sees the old one or the new one, whatever moment the publisher stops at.

``<public>/generation-<id>`` holds the files of one delivery, ``<public>/_inventory/<id>`` its inventory (path, size, SHA-256), and ``<public>/_current/<number>`` names the generation that counts: the
greatest number does. A delivery is moved in, then listed, then pointed to by a file that is written aside and renamed; only the rename shows it. Nothing that a reader may be at is touched: what was
delivered before stays until retire(). There is one publisher at a time; a second that takes the same number fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INVENTORY = "path string, size_bytes long, sha256 string"
STEP = 8 << 20


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def file_digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, size_bytes, sha256 of the files under a folder. A file streams through its task in blocks of STEP bytes, so it may be of any size."""
    import hashlib

    import pyarrow as pa

    from methlake.sources.files import filesystem

    def run(batches):
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                fs, name = filesystem(path)
                h = hashlib.sha256()
                with fs.open_input_file(name) as f:
                    while block := f.read(STEP):
                        h.update(block)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["path", "size_bytes", "sha256"])

    # without the contents a scan of binary files lists them only
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder).select("path", F.col("length").alias("size_bytes"))
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInArrow(run, INVENTORY)


def _numbers(spark: SparkSession, public: str) -> list[int]:
    fs, p = _fs(spark, f"{public}/_current")
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()) if fs.exists(p) else []


def current(spark: SparkSession, public: str) -> str:
    """The id of the generation that counts now. A reader that keeps it reads one generation, whatever is published meanwhile."""
    numbers = _numbers(spark, public)
    if not numbers:
        raise FileNotFoundError(f"nothing is published in {public}")
    return spark.read.text(f"{public}/_current/{numbers[-1]:012d}").first()["value"]


def folder(public: str, generation: str) -> str:
    return f"{public}/generation-{generation}"


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, target)
    fs.mkdirs(p.getParent())
    if fs.exists(p) or not fs.rename(_fs(spark, source)[1], p):
        raise OSError(f"could not move {source} to {target}")


def _list(spark: SparkSession, public: str, generation: str) -> None:
    # names below the generation, which is all that a path is looked up by
    name = F.regexp_extract("path", rf"/generation-{generation}/(.*)$", 1)
    file_digests(spark, folder(public, generation)).withColumn("path", name).where(~F.col("path").rlike(r"(^|/)[_.]")).coalesce(1).write.json(f"{public}/_inventory/{generation}")


def _point(spark: SparkSession, public: str, generation: str) -> None:
    fs, aside = _fs(spark, f"{public}/_current/.{generation}")
    out = fs.create(aside, True)
    out.write(bytearray(generation.encode()))
    out.close()
    _move(spark, f"{public}/_current/.{generation}", f"{public}/_current/{max(_numbers(spark, public), default=0) + 1:012d}")


def publish(spark: SparkSession, staged: str, public: str) -> str:
    """Makes a staged folder the current generation of a delivery; gives back its id."""
    generation = uuid.uuid4().hex
    _move(spark, staged, folder(public, generation))
    _list(spark, public, generation)
    _point(spark, public, generation)
    return generation


def inventory(spark: SparkSession, public: str, generation: str | None = None) -> DataFrame:
    return spark.read.schema(INVENTORY).json(f"{public}/_inventory/{generation or current(spark, public)}")


def published(spark: SparkSession, public: str, generation: str | None = None, part: str = "") -> DataFrame:
    """The rows of a generation's Parquet files (None: the current one), or of one folder of it. Each file read must be what its inventory says, and there must be no other."""
    generation = generation or current(spark, public)
    below = f"{part}/" if part else ""
    name = F.regexp_extract("path", rf"/generation-{generation}/(.*)$", 1)
    found = file_digests(spark, f"{folder(public, generation)}/{part}").withColumn("path", name).where(~F.col("path").rlike(r"(^|/)[_.]"))
    j = inventory(spark, public, generation).where(F.col("path").startswith(below)).alias("l").join(found.alias("f"), "path", "full_outer")
    same = (F.col("l.size_bytes") == F.col("f.size_bytes")) & (F.col("l.sha256") == F.col("f.sha256"))
    if not j.where(~F.coalesce(same, F.lit(False))).isEmpty():
        raise ValueError("the delivery is not what its inventory says")
    return spark.read.parquet(f"{folder(public, generation)}/{part}")


def retire(spark: SparkSession, public: str, keep: int = 1) -> int:
    """Deletes generations but the last ``keep`` ones that were current, and what publishers that broke off left; gives back how many. Pointers go first, so none leads nowhere."""
    numbers = _numbers(spark, public)
    kept = {spark.read.text(f"{public}/_current/{n:012d}").first()["value"] for n in numbers[-keep:]}
    fs, root = _fs(spark, public)
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, f"{public}/_current/{n:012d}")[1], False)
    gone = 0
    for f in fs.listStatus(root):
        name = f.getPath().getName()
        if name.startswith("generation-") and name[11:] not in kept:
            fs.delete(_fs(spark, f"{public}/_inventory/{name[11:]}")[1], True)
            fs.delete(f.getPath(), True)
            gone += 1
    return gone
