"""The jobs: against their SQL, over growing input, after a broken batch, and from the command line."""

import json
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from jobs import cell_report, log_follow, queries
from jobs.common import load
from test_queries import SF, TABLES, canon


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_job_query(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    df = queries.QUERIES[name](spark, SF)
    q = duck.sql(queries.ORACLE_SQL[name])
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    assert len(got[1]) > 0 and got == canon(q.columns, q.fetchall())
    assert before == {k: spark.conf.get(k, None) for k in before}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_report_of_some_projects(spark, tmp_path):
    config = load(None, "cell_report")
    whole = rows(cell_report.run(spark, SF, f"{tmp_path}/out", config))
    assert len({r[-1] for r in whole}) > 2
    # a rerun of one project with other limits replaces its folders only
    some = rows(cell_report.run(spark, SF, f"{tmp_path}/out", config | {"projects": ["P1"], "limits": config["limits"] | {"sites_min": 10.0**9}}))
    assert [r for r in some if r[-1] != "P1"] == [r for r in whole if r[-1] != "P1"]
    assert len(some) == len(whole) and all("nCG_threshold" in r[11] for r in some if r[-1] == "P1")
    assert rows(cell_report.run(spark, SF, f"{tmp_path}/out", config)) == whole


DOCS = "doc_id long, text string, source string"


def follow(spark, tmp_path, **changed):
    return rows(log_follow.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/mark", load(None, "log_follow") | {"keep": 3, "shards": 4} | changed))


def put(spark, tmp_path, name, docs):
    spark.createDataFrame(docs, DOCS).coalesce(1).write.parquet(f"{tmp_path}/new-{name}")
    os.makedirs(f"{tmp_path}/in", exist_ok=True)
    file = next(f for f in os.listdir(f"{tmp_path}/new-{name}") if f.endswith(".parquet"))
    shutil.move(f"{tmp_path}/new-{name}/{file}", f"{tmp_path}/in/{name}.parquet")


FIRST = [(1, "start\n\n  token = 1 \nline", "a"), (2, "\x1b[31mred\x1b[0m\rdone", "a"), (3, None, "a"), (4, "", "b"), (5, "x@y.z\nx@y.z", None)]
SECOND = [(6, "token = 1\ntoken = 2", "a"), (7, "first of c", "c"), (None, "no place", "a")]


def test_follow_growing_input(spark, tmp_path):
    put(spark, tmp_path, "1", FIRST)
    one = follow(spark, tmp_path)
    assert follow(spark, tmp_path) == one
    pick = lambda found, product, run: [r for r in found if r[0] == product and r[2] == run]
    assert [r[7:] for r in pick(one, "total", "a")] == [(5, 25)]
    assert [(r[3], r[4], r[6]) for r in pick(one, "recent", "a")] == [(1, 3, "line"), (2, 0, "red"), (2, 1, "done")]
    assert [(r[3], r[4], r[5], r[6], r[7]) for r in pick(one, "message", None)] == [(5, 0, "mail", "x@y.z", 2)]
    assert not [r for r in one if r[2] == "b"]
    put(spark, tmp_path, "2", SECOND)
    two = follow(spark, tmp_path)
    assert [r[7] for r in pick(two, "total", "a")] == [8]
    assert [(r[3], r[4], r[6], r[7]) for r in pick(two, "message", "a")] == [(1, 2, "token = 1", 2), (6, 1, "token = 2", 1)]
    assert [r[6] for r in pick(two, "recent", "a")] == ["done", "token = 1", "token = 2"]
    assert pick(two, "message", None) == pick(one, "message", None)
    # the same as everything at once
    other = tmp_path / "other"
    other.mkdir()
    put(spark, other, "all", FIRST + SECOND)
    assert follow(spark, other) == two
    # and as one file a batch
    third = tmp_path / "third"
    third.mkdir()
    put(spark, third, "2", SECOND)
    put(spark, third, "1", FIRST)
    assert follow(spark, third, files_per_batch=1) == two


def undone(tmp_path, batch):
    """The stream does not know that a batch ended."""
    for name in (str(batch), f".{batch}.crc"):
        if os.path.exists(f"{tmp_path}/mark/commits/{name}"):
            os.remove(f"{tmp_path}/mark/commits/{name}")


def test_follow_repeats_a_broken_batch(spark, tmp_path):
    put(spark, tmp_path, "1", FIRST)
    one = follow(spark, tmp_path)
    put(spark, tmp_path, "2", SECOND)
    two = follow(spark, tmp_path)
    # it ended, but the stream did not hear of it
    undone(tmp_path, 1)
    assert follow(spark, tmp_path) == two
    # it broke off while its folder was put in place: readers have the views before it, then it is made again
    undone(tmp_path, 1)
    shutil.rmtree(f"{tmp_path}/out/marks/batch=1")
    shutil.rmtree(f"{tmp_path}/out/views/batch=1/product=total")
    assert rows(log_follow.read(spark, f"{tmp_path}/out")) == one
    assert follow(spark, tmp_path) == two
    # output without its checkpoint
    shutil.rmtree(f"{tmp_path}/mark")
    with pytest.raises(Exception, match="another checkpoint"):
        follow(spark, tmp_path)


def test_follow_empties_what_is_superseded(spark, tmp_path):
    docs = [(k, f"line {k}\ntoken = {k % 3}", f"run{k % 5}") for k in range(24)]
    for k in range(8):
        put(spark, tmp_path, str(k), docs[3 * k : 3 * k + 3])
        last = follow(spark, tmp_path, history=2)
    left = sorted(int(d.split("=")[1]) for d in os.listdir(f"{tmp_path}/out/views") if any(f.endswith(".parquet") for _, _, fs in os.walk(f"{tmp_path}/out/views/{d}/product=total") for f in fs))
    assert left == [4, 5, 6, 7]
    other = tmp_path / "other"
    other.mkdir()
    put(spark, other, "all", docs)
    assert follow(spark, other) == last


def test_configuration(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"keep": 5}))
    assert load(f"{tmp_path}/c.json", "log_follow")["keep"] == 5
    (tmp_path / "c.json").write_text(json.dumps({"kept": 5}))
    with pytest.raises(ValueError, match="kept"):
        load(f"{tmp_path}/c.json", "log_follow")


def test_command_lines(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=2 --conf spark.ui.enabled=false pyspark-shell"}
    for args in (["jobs.cell_report", "--input", SF, "--output", f"{tmp_path}/report"], ["jobs.log_follow", "--input", f"{SF}/documents.parquet", "--output", f"{tmp_path}/views", "--checkpoint", f"{tmp_path}/mark"]):
        done = subprocess.run([sys.executable, "-m", *args], env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        assert "wrote" in done.stderr and "read" in done.stderr
    assert duckdb.sql(f"select count(*) from '{tmp_path}/report/*/*/*.parquet'").fetchall()[0][0] > 0
    assert duckdb.sql(f"select count(*) from '{tmp_path}/views/views/*/*/*/*.parquet'").fetchall()[0][0] > 0
