"""All queries of the methylation operators with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from methlake.plans.shims import oracle, shim

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, shims: str, sql: str | None):
    """Registers f(*shims) under a name, with the oracle's body over the same shims (None: SQL can't express it)."""

    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(*[shim(spark, sf_dir, s) for s in shims.split()])
        if sql is not None:
            ORACLE_SQL[name] = oracle(shims, sql)
        return f

    return register


from methlake.plans import container_queries, cpg_queries, io_queries, manifest_queries, read_queries, scalar_queries, sequence_queries  # noqa: E402, F401
