"""Counters of a query, taken while it runs, and an event log of them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from captrail.paths import store


class Counters:
    """Points at which rows are counted as they pass: no second pass, no cache.

    at() returns a DataFrame like its argument; once an action over it has run, log() appends one JSON line to the log folder, a file of
    its own, so that queries that end at once do not meet: name, seconds, and for each point its counts."""

    def __init__(self, name: str):
        self.name, self.points, self.began = name, {}, time.time()

    def at(self, df: DataFrame, point: str, **counts: Column) -> DataFrame:
        """df, counted at this point: n (rows) and the given aggregates."""
        self.points[point] = Observation(f"{self.name}-{point}-{uuid.uuid4().hex}")
        return df.observe(self.points[point], F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in counts.items()])

    def counts(self) -> dict[str, dict]:
        return {point: dict(o.get) for point, o in self.points.items()}

    def log(self, folder: str) -> dict:
        event = {"name": self.name, "at": self.began, "seconds": time.time() - self.began, "counts": self.counts()}
        fs, base = store(folder)
        fs.create_dir(base)
        with fs.open_output_stream(f"{base}/{self.began:.6f}-{uuid.uuid4().hex}.json") as f:
            f.write((json.dumps(event, ensure_ascii=False, sort_keys=True) + "\n").encode())
        return event


def run_counted(name: str, folder: str, plan: Callable[[Counters], DataFrame], action: Callable[[DataFrame], None]) -> dict:
    """Runs a plan that marks its points, and logs what passed them; the event."""
    counters = Counters(name)
    action(plan(counters))
    return counters.log(folder)


def events(spark: SparkSession, folder: str) -> DataFrame:
    """(name, at, seconds, point, counter, value) of the logged queries."""
    e = spark.read.schema("name string, at double, seconds double, counts map<string,map<string,long>>").json(folder)
    e = e.select("name", "at", "seconds", F.explode("counts").alias("point", "each"))
    return e.select("name", "at", "seconds", "point", F.explode("each").alias("counter", "value"))
