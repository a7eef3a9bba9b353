"""What the jobs share: configuration, logging, sessions of the command line, counts of rows while they pass."""

from __future__ import annotations

import json
import logging
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("jobs")


def load(path: str | None, name: str) -> dict:
    """The configuration in a JSON file, or the job's own one beside its code. Keys that the job's own one lacks are mistakes."""
    own = os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.json")
    with open(own, encoding="utf-8") as f:
        config = json.load(f)
    if path:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        if unknown := set(given) - set(config):
            raise ValueError(f"{path}: unknown keys {sorted(unknown)}")
        config |= given
    return config


def session(name: str) -> SparkSession:
    """The session of a command line; master and the like come from spark-submit or the defaults file."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and the count of its rows once an action has read it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
