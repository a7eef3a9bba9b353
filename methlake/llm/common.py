"""Shared folder, written tables, and small helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only where that is unset and the master is local (tests) a temporary folder is set up.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if folder is None:
        folder = sc.getCheckpointDir()
        if folder is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="methlake-")
            sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """df, written as Parquet in the shared folder and reread: lineage ends here and survives lost executors.

    few: for counts and edges, which are small beside what they are made of: a quarter as many files as the shuffles have partitions.
    """
    spark = df.sparkSession
    if few:
        df = df.coalesce(max(48, partitions(spark) // 4))
    path = new_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes what written() made, once nothing reads it any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """df dealt out evenly (round robin without cols), for work that needs more tasks than the scan has."""
    return df.repartition(partitions(df.sparkSession), *cols)


def id_bucket(col, n: int):
    """crc32 of the id as decimal text, modulo n."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def tidy(run):
    """run (for mapInArrow), after which the worker gives the memory it no longer uses back to the system: workers live on over many tasks."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            released()

    return wrapped


def released() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
