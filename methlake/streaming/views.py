"""The view of each run from its log: stages, routes, open jobs, warnings, failure and last lines, held as the state of a stream.

Lines are events of fixed forms. An event carries its place in the log, and of what it says about one thing (the current stage, a stage, a route, a job) the latest place
counts, so lines may come in any order and in any batches. A run's state is bounded: RECENT last lines, WARNINGS different warnings (those that came up first), and as many stages, routes
and jobs as its log names; a row is folded into it as it comes and no list of rows is made. A run without a new line for ``idle`` is given as stalled by a timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

RECENT, WARNINGS = 100, 100
#: fixed forms of a run's log
PREFIX = r"^\[[^\]]+\]\s+(?:INFO|DEBUG|WARNING|ERROR)\s+"
STAGE = r"^Step (\d+)/(\d+) START: (.*)"
DONE = r"^Step (\d+)/(\d+) OK: .*?\((\d+)s"
ROUTE = r"^\[\w+ route\] (\S+) (running|passed|failed|verified)(?: (.*))?$"
PROGRESS = r"^(\d+) of (\d+) steps \((\d+)%\)"
SUBMITTED = r"Job (\S+) has been submitted with SLURM jobid (\d+(?:_\d+)?)"
FINISHED = r"^Finished jobid: (\S+)"
FAILURE = r"\b(?:ERROR|Error|Exception|FAIL)\b|(?:Error|Exception):"
VIEW = "run string, lines long, last long, stage int, total int, phase string, progress string, failure string, stages_done int, seconds long, routes string, open_jobs int, warning_kinds int, warnings long, recent string, stalled boolean"


def view_events(lines: DataFrame) -> DataFrame:
    """run, place, text, kind, a, b, c of lines (run, place, line): the event that a line is, and what it names. A line that warns or fails is that as well."""
    text = F.trim(F.regexp_replace(F.trim("line"), PREFIX, ""))
    forms = [("stage", STAGE, 3), ("done", DONE, 3), ("route", ROUTE, 3), ("progress", PROGRESS, 3), ("submitted", SUBMITTED, 2), ("finished", FINISHED, 1)]
    kind = F.lit("line")
    parts = [F.lit(None).cast("string")] * 3
    for name, form, n in reversed(forms):
        hit = F.col("text").rlike(form)
        kind = F.when(hit, name).otherwise(kind)
        parts = [F.when(hit, F.regexp_extract("text", form, k + 1) if k < n else F.lit(None)).otherwise(p) for k, p in enumerate(parts)]
    warns = F.col("line").contains("WARNING")
    rows = lines.where(F.trim("line") != "").withColumn("text", text)
    return rows.select("run", "place", "text", kind.alias("kind"), *[p.alias(c) for p, c in zip(parts, "abc")], warns.alias("warns"), F.col("line").rlike(FAILURE).alias("fails"))


class RunState(StatefulProcessor):
    """Folds events into the state of their run and gives its view after each batch."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "lines long, last long, stage_at long, stage int, total int, phase string, progress_at long, progress string, failure_at long, failure string")
        # things by kind and name: the place that told of them last
        self.things = handle.getMapState("things", "kind string, name string", "at long, value string, n long")
        self.ring = handle.getListState("ring", "at long, text string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        h = self.head.get() or (0, -1, -1, 0, 0, "", -1, "", -1, "")
        count, last, stage_at, stage, total, phase, progress_at, progress, failure_at, failure = h
        things: dict[tuple[str, str], list] = {tuple(k): list(v) for k, v in self.things.iterator()}
        told = set(things)
        changed: set[tuple[str, str]] = set()
        ring = [tuple(r) for r in self.ring.get()]

        def tell(kind: str, name: str, at: int, value: str) -> None:
            old = things.get((kind, name))
            if old is None or at >= old[0]:
                things[kind, name] = [at, value, 1 + (old[2] if old else 0)]
                changed.add((kind, name))

        for batch in rows:
            for r in batch.itertuples(index=False):
                at, count = int(r.place), count + 1
                last = max(last, at)
                ring.append((at, r.text))
                if len(ring) > 2 * RECENT:
                    ring = sorted(ring)[-RECENT:]
                if r.kind == "stage" and at > stage_at:
                    stage_at, stage, total, phase = at, int(r.a), int(r.b), r.c
                elif r.kind == "progress" and at > progress_at:
                    progress_at, progress = at, f"{r.a}/{r.b}"
                if r.kind in ("stage", "done"):
                    tell("stage", r.a, at, r.c if r.kind == "done" else "")
                elif r.kind == "route":
                    tell("route", r.a, at, r.b)
                elif r.kind == "submitted":
                    tell("job", r.a, at, r.b)
                elif r.kind == "finished":
                    tell("job", r.a, at, "")
                if r.fails and at > failure_at:
                    failure_at, failure = at, r.text
                if r.warns:
                    # the first place and the number of a warning
                    old = things.get(("warning", r.text), [at, "", 0])
                    things["warning", r.text] = [min(at, old[0]), "", old[2] + 1]
                    changed.add(("warning", r.text))
            warned = sorted((v[0], k) for k, v in things.items() if k[0] == "warning")
            for _, k in warned[WARNINGS:]:
                del things[k]
        ring = sorted(ring)[-RECENT:]
        for k in told - set(things):
            self.things.removeKey(k)
        for k in changed & set(things):
            self.things.updateValue(k, tuple(things[k]))
        self.ring.put(ring)
        self.head.update((count, last, stage_at, stage, total, phase, progress_at, progress, failure_at, failure))
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._view(key[0], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._view(key[0], True)

    def _view(self, run: str, stalled: bool) -> pd.DataFrame:
        count, last, _, stage, total, phase, _, progress, _, failure = self.head.get()
        things = [(tuple(k), tuple(v)) for k, v in self.things.iterator()]
        of = lambda kind: sorted((k[1], v) for k, v in things if k[0] == kind)
        done = [v[1] for _, v in of("stage") if v[1]]
        row = [
            run, count, last, stage, total, phase, progress, failure, len(done), sum(map(int, done)), ",".join(f"{n}={v[1]}" for n, v in of("route")), sum(v[1] != "" for _, v in of("job")),
            len(of("warning")), sum(v[2] for _, v in of("warning")), "\n".join(t for _, t in sorted(tuple(r) for r in self.ring.get())), stalled]
        return pd.DataFrame([row], columns=[c.split()[0] for c in VIEW.split(", ")])

    def close(self) -> None:
        pass


def run_views(events: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """Stream of the views (VIEW) of runs whose events (view_events) a batch brought. Needs the RocksDB state store (with_rocksdb)."""
    return events.groupBy("run").transformWithStateInPandas(RunState(idle_ms), VIEW, "Update", "ProcessingTime" if idle_ms is not None else "None")


class with_rocksdb:
    """The state store that keeps several states a key, for the streams that start inside."""

    KEY, VALUE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self) -> None:
        self.old = self.conf.get(self.KEY, None)
        self.conf.set(self.KEY, self.VALUE)

    def __exit__(self, *_) -> None:
        if self.old is None:
            self.conf.unset(self.KEY)
        else:
            self.conf.set(self.KEY, self.old)


def views_so_far(events: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Takes what is there now, writes each batch's views under its number, and gives back the latest view of each run. (Without timers: a stream that waits for them has no end.)"""
    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with with_rocksdb(spark):
        run_views(events).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(f"{VIEW}, batch long").parquet(path)
    columns = [c.split()[0] for c in VIEW.split(", ")]
    return rows.groupBy("run").agg(F.max_by(F.struct(*columns[1:]), "batch").alias("v")).select("run", "v.*")
