"""Logs that grow as a source, and the views of runs as the state of a stream."""

import os
import random
import re
import time

import pyarrow.fs as pafs
import pytest

from methlake.sources import logs
from methlake.streaming import views

FS = pafs.LocalFileSystem()


def write(path, data, mode="wb"):
    with open(path, mode) as f:
        f.write(data)


@pytest.mark.parametrize("step", [1, 3, 64, 1 << 20])
def test_lines_of_any_ranges(tmp_path, step):
    rng = random.Random(step)
    data = b"".join(bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) + rng.choice([b"\n", b"\r\n", b"\r", b"\n\n"]) for _ in range(200)) + b"open"
    path = f"{tmp_path}/a.log"
    write(path, data)
    want = [(m.start(), m.group()) for m in re.finditer(rb"[^\r\n]+(?=[\r\n])", data)]
    for width in (1, 2, 7, 50, len(data)):
        assert [x for b in range(0, len(data), width) for x in logs.lines(FS, path, b, min(len(data), b + width), step)] == want


def drain(reader, start):
    """What a batch after an offset reads, and its offset."""
    end = reader.latestOffset()
    found = [(r["line"]) for p in reader.partitions(start, end) for b in reader.read(p) for r in b.to_pylist()]
    return found, end


def test_growth_truncation_and_replacement(tmp_path):
    path = f"{tmp_path}/logs/a.log"
    os.makedirs(f"{tmp_path}/logs")
    fresh = lambda: logs.LogReader({"path": f"{tmp_path}/logs", "pattern": "*.log", "splitBytes": "5"})
    at = {}
    write(path, b"one\ntw")
    got, at = drain(fresh(), at)
    assert got == ["one"]
    write(path, b"o\r\nthr", "ab")
    got, at = drain(fresh(), at)
    assert got == ["two"]
    assert drain(fresh(), at)[0] == []
    write(path, b"ee \xc3\xa9\xff\n", "ab")
    got, at = drain(fresh(), at)
    assert got == ["three é�"]
    # cut
    write(path, b"new\n")
    got, at = drain(fresh(), at)
    assert got == ["new"]
    # written over with as many bytes, in place
    with open(path, "r+b") as f:
        f.write(b"old\n")
    got, at = drain(fresh(), at)
    assert got == ["old"]
    # replaced by another file with the same start, then by a longer one
    for text in (b"old\n", b"old\nand more\n"):
        write(f"{tmp_path}/other", text)
        os.replace(f"{tmp_path}/other", path)
        got, at = drain(fresh(), at)
        assert got == text.decode().split("\n")[:-1]
    # taken away, another comes
    os.remove(path)
    write(f"{tmp_path}/logs/b.log", b"b\n")
    write(f"{tmp_path}/logs/_c.log", b"hidden\n")
    got, at = drain(fresh(), at)
    assert got == ["b"]
    # only appended bytes are planned
    write(f"{tmp_path}/logs/b.log", b"x" * 100 + b"\n", "ab")
    ranges = fresh().partitions(at, fresh().latestOffset())
    assert (ranges[0].begin, ranges[-1].end) == (2, 103) and len(ranges) == 21


def test_stream_of_logs(spark, tmp_path):
    os.makedirs(f"{tmp_path}/logs")
    run = lambda: logs.follow(spark, f"{tmp_path}/logs", "*.log").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start().awaitTermination()
    seen = lambda: sorted(r.line for r in spark.read.parquet(f"{tmp_path}/out").collect())
    write(f"{tmp_path}/logs/a.log", b"a1\na2\na")
    write(f"{tmp_path}/logs/b.log", b"b1\n")
    run()
    assert seen() == ["a1", "a2", "b1"]
    run()
    write(f"{tmp_path}/logs/a.log", b"3\na4\n", "ab")
    run()
    assert seen() == ["a1", "a2", "a3", "a4", "b1"]


def random_log(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        out.append(rng.choice([
            f"Step {rng.randrange(1, 5)}/4 START: phase {k}", f"[2024-01-01] INFO Step {rng.randrange(1, 5)}/4 OK: fine ({rng.randrange(90)}s)", f"[a route] r{rng.randrange(3)} {rng.choice(['running', 'passed', 'failed'])} note",
            f"{k} of 1000 steps ({k // 10}%)", f"Job {rng.randrange(20)} has been submitted with SLURM jobid {k}", f"Finished jobid: {rng.randrange(20)}", f"[x] WARNING disk {rng.randrange(130)}", f"plain {k}", "ValueError: bad", "  "]))
    return out


def brute_view(log):
    """The view by reading a run's lines one after another."""
    v = {"lines": 0, "stage": 0, "total": 0, "phase": "", "progress": "", "failure": ""}
    stages, routes, jobs, warnings, texts = {}, {}, {}, {}, []
    for line in log:
        if not line.strip():
            continue
        t = re.sub(views.PREFIX, "", line.strip()).strip()
        v["lines"] += 1
        texts.append(t)
        if m := re.search(views.STAGE, t):
            v["stage"], v["total"], v["phase"] = int(m[1]), int(m[2]), m[3]
            stages[m[1]] = ""
        elif m := re.search(views.DONE, t):
            stages[m[1]] = m[3]
        elif m := re.search(views.ROUTE, t):
            routes[m[1]] = m[2]
        elif m := re.search(views.PROGRESS, t):
            v["progress"] = f"{m[1]}/{m[2]}"
        elif m := re.search(views.SUBMITTED, t):
            jobs[m[1]] = m[2]
        elif m := re.search(views.FINISHED, t):
            jobs[m[1]] = ""
        if re.search(views.FAILURE, line):
            v["failure"] = t
        if "WARNING" in line:
            warnings[t] = warnings.get(t, 0) + 1
    kept = dict(list(warnings.items())[:100])
    done = [int(x) for x in stages.values() if x]
    return v | {"stages_done": len(done), "seconds": sum(done), "routes": ",".join(f"{k}={routes[k]}" for k in sorted(routes)), "open_jobs": sum(x != "" for x in jobs.values()), "warning_kinds": len(kept), "warnings": sum(kept.values()), "recent": "\n".join(texts[-100:])}


def test_views_over_restarts(spark, tmp_path):
    logs_of = {f"r{k}": random_log(n, k) for k, n in enumerate((3, 150, 700))}
    for k in range(3):
        # the runs' lines in three parts; each call starts a new stream on the same checkpoint
        part = [(run, at, line) for run, log in logs_of.items() for at, line in enumerate(log) if at * 3 // len(log) == k]
        random.Random(k).shuffle(part)
        spark.createDataFrame(part, "run string, place long, line string").coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
        lines = spark.readStream.schema("run string, place long, line string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        before = spark.conf.get(views.with_rocksdb.KEY, None)
        found = views.views_so_far(views.view_events(lines), f"{tmp_path}/views", f"{tmp_path}/mark")
        assert spark.conf.get(views.with_rocksdb.KEY, None) == before
        got = {r.run: r.asDict() for r in found.collect()}
        for run, log in logs_of.items():
            want = brute_view([line for at, line in enumerate(log) if at * 3 // len(log) <= k])
            if want["lines"]:
                assert {c: got[run][c] for c in want} == want, (k, run)


def test_stalled_runs(spark, tmp_path):
    """A run without new lines is told of by its timer."""
    spark.createDataFrame([("a", 1, "Step 1/2 START: x")], "run string, place long, line string").write.parquet(f"{tmp_path}/in")
    lines = spark.readStream.schema("run string, place long, line string").parquet(f"{tmp_path}/in")
    seen = []
    with views.with_rocksdb(spark):
        stream = views.run_views(views.view_events(lines), 1000).writeStream.outputMode("update").foreachBatch(lambda b, n: seen.extend((r.run, r.stage, r.stalled) for r in b.collect()))
        stream = stream.option("checkpointLocation", f"{tmp_path}/mark").trigger(processingTime="1 second").start()
        try:
            until = time.time() + 60
            while len(seen) < 2 and time.time() < until:
                time.sleep(0.5)
        finally:
            stream.stop()
    assert seen[:2] == [("a", 1, False), ("a", 1, True)]
