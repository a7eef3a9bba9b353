"""Batch job: the QC report of all cells, by protocol and project.

Reads count, cell and read-pair tables, makes the QC table, decides which cells pass and why the others do not, sets each cell beside its clone, and writes
one Parquet table in folders ``protocol=../project_sample_id=..``. The configuration's ``inputs`` are the SELECTs that turn the tables in the input folder
({name} stands for one) into the library's columns; ``projects`` restricts the report (empty: all). A run replaces the folders of the projects that it reports and leaves the others
alone, so a rerun gives the same table, and a run that breaks off is repaired by the next.

    python -m jobs.cell_report --input /data/tables --output /data/report [--config my.json]
"""

from __future__ import annotations

import argparse
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import counted, load, log, session
from methlake.functions.numbers import quantised
from methlake.operators import qc as Q

NAME = "cell_report"
SCHEMA = """sample_id string, clone_id string, plate_id string, unique_cpg_sites long, cpg_rate_pct double, lambda_rate_pct double, puc19_rate_pct double, gini double, native_mapping_pct double,
    final_yield_pct double, failed_criteria int, reasons string, hq boolean, clone_cells long, clone_passing long, protocol string, project_sample_id string"""
VALUES = ["cpg_rate_pct", "lambda_rate_pct", "puc19_rate_pct", "gini", "native_mapping_pct", "final_yield_pct"]


def inputs(spark: SparkSession, source: str, config: dict) -> tuple[dict[str, DataFrame], dict]:
    """The configured inputs, each a SELECT over the folder's tables and the inputs before it, and the counts of the rows read by table."""
    tables, seen, found = {}, {}, {}
    for name, text in config["inputs"].items():
        for table in re.findall(r"\{(\w+)\}", text):
            if table not in tables:
                tables[table] = spark.read.format(config["format"]).load(f"{source.rstrip('/')}/{table}.{config['format']}")
        used = {t: tables[t] for t in re.findall(r"\{(\w+)\}", text)}
        # earlier inputs are named as they are
        for other in found:
            text = re.sub(rf"\b(from|join) {other}\b", rf"\1 {{{other}}}", text)
        found[name] = spark.sql(text, **used, **{o: found[o] for o in found if "{" + o + "}" in text})
    for name in ("cells", "cpg", "pairs"):
        found[name], seen[name] = counted(found[name], f"read {name}")
    return found, seen


def report(cells: DataFrame, cpg: DataFrame, pairs: DataFrame, limits: dict, decimals: int) -> DataFrame:
    """A row for each cell with read pairs: its rates, the criteria it fails, and how many cells of its clone there are and pass."""
    qc = Q.qc_table(cpg, pairs)
    qc = qc.withColumns({c: quantised(c, decimals) for c in VALUES})
    decided = Q.filter_reasons(qc, **limits).select("sample_id", "failed_criteria", "reasons", "hq")
    rows = qc.join(decided, "sample_id").join(cells.select("sample_id", "protocol", "project_sample_id"), "sample_id")
    clones = rows.groupBy("clone_id").agg(F.count("*").alias("clone_cells"), F.count_if("hq").alias("clone_passing"))
    # a cell without a clone keeps its row
    return rows.join(clones, rows["clone_id"].eqNullSafe(clones["clone_id"]), "left").drop(clones["clone_id"])


def run(spark: SparkSession, source: str, target: str, config: dict) -> DataFrame:
    """The job on a session; gives back the whole table in the target folder."""
    found, seen = inputs(spark, source, config)
    cells, cpg, pairs = found["cells"], found["cpg"], found["pairs"]
    if config["projects"]:
        cells = cells.where(F.col("project_sample_id").isin(config["projects"]))
        own = cells.select("sample_id").distinct()
        cpg, pairs = cpg.join(own, "sample_id", "left_semi"), pairs.join(own, "sample_id", "left_semi")
    rows = report(cells, cpg, pairs, config["limits"], config["decimals"])
    columns = [f.split()[0] for f in SCHEMA.split(",")]
    rows, made = counted(rows.select(*columns), "written")
    # ranges of cells, so that a large project is several files and a small one is one
    rows = rows.repartitionByRange("protocol", "project_sample_id", "sample_id").sortWithinPartitions("protocol", "project_sample_id", "sample_id")
    rows.write.partitionBy("protocol", "project_sample_id").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)
    log.info("%s: read %s from %s, wrote %d cells to %s", NAME, ", ".join(f"{o.get['rows']} {k}" for k, o in seen.items()), source, made.get["rows"], target)
    return read(spark, target)


def read(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(target)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{NAME}", description="QC report of all cells")
    for name in ("input", "output"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config", help="JSON file; keys that it lacks are taken from the job's own one")
    args = parser.parse_args(argv)
    config, spark = load(args.config, NAME), session(NAME)
    try:
        run(spark, args.input, args.output, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
