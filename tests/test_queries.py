"""Every registered query of the methylation operators against its oracle in DuckDB."""

import math

import duckdb
import pytest

from methlake.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 9)
        return tuple(x) if isinstance(x, list) else x

    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLE_SQL:
        q = duck.sql(ORACLE_SQL[name])
        assert got == canon(q.columns, q.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(ORACLE_SQL) <= set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
