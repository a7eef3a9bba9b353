"""The jobs as registered queries: each runs twice into one new folder, and returns what lies there then."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobs import cell_report, log_follow
from jobs.common import load
from methlake.plans.registry import cpg_queries, io_queries, oracle


def job1_cell_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of all cells."""
    target, config = io_queries.place(spark), load(None, cell_report.NAME)
    for _ in range(2):
        found = cell_report.run(spark, sf_dir, target, config)
    return found


def job2_log_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as logs of their sources."""
    base, config = io_queries.place(spark), load(None, log_follow.NAME)
    for _ in range(2):
        found = log_follow.run(spark, f"{sf_dir}/documents.parquet", f"{base}/views", f"{base}/checkpoint", config)
    # the shard is how the table is laid out
    return found.drop("shard")


_LOG = load(None, log_follow.NAME)
_KIND = "case " + " ".join(f"when regexp_matches(text, '{p}') then '{k}'" for k, p in _LOG["patterns"].items()) + " end"
_LAST = f"qualify row_number() over (partition by run order by chunk desc nulls last, line desc, text desc) <= {_LOG['keep']}"

QUERIES = {"job1_cell_report": job1_cell_report, "job2_log_follow": job2_log_follow}
ORACLE_SQL = {
    "job1_cell_report": oracle("cpg pairs cells", cpg_queries.CELL_REPORT),
    "job2_log_follow": f"""
        with parts as (select source run, doc_id chunk, string_split_regex(text, '[\\r\\n]') p from documents),
        cut as (select run, chunk, cast(unnest(generate_series(1, len(p))) - 1 as bigint) line, unnest(p) text from parts),
        plain as (select run, chunk, line, trim(regexp_replace(text, '\\x1b\\[[0-9;?]*[ -/]*[@-~]', '', 'g'), ' ' || chr(9)) text from cut),
        lines as (select *, {_KIND} kind, cast(length(text) as bigint) chars from plain where text <> '')
        select 'total' product, run, cast(null as bigint) chunk, cast(null as bigint) line, cast(null as varchar) kind, cast(null as varchar) text, count(*) n, cast(sum(chars) as bigint) chars from lines group by run
        union all (select 'recent', run, chunk, line, kind, text, 1, chars from lines {_LAST})
        union all (select 'event', run, chunk, line, kind, text, 1, chars from lines where kind is not null {_LAST})
        union all (select 'message', run, min((chunk, line))[1], min((chunk, line))[2], kind, text, count(*), cast(sum(chars) as bigint) from lines where kind is not null group by run, kind, text)""",
}
