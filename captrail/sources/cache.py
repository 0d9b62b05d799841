"""A cache of byte ranges in the shared store, so that a batch fetches only what no earlier batch has fetched.

Two tables: ranges (archive, first and last byte, key) and blobs (key, bytes). The key is the SHA-256 of the bytes, so ranges
of equal content share a blob. Both only grow by whole appends, blobs first: a range never names a blob that is not there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.operators import slices
from captrail.paths import exists, remove, scratch

from .fetch import Fetch, fetch_slices

RANGES, BLOBS = "w string, s long, e long, key string", "key string, blob binary, part string"
#: Ranges and wanted bytes meet under cells of so many bytes: a cached range is listed under each cell that it reaches.
CELL = 4_000_000


def _table(spark: SparkSession, cache: str, name: str, schema: str) -> DataFrame:
    path = f"{cache}/{name}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def covering(wanted: DataFrame, ranges: DataFrame, cell: int = CELL) -> DataFrame:
    """(w, o, l, s, key) of wanted (w, o, l) that lie in one range (w, s, e, key): of several the shortest, then the first.

    An equi-join by archive and cell of the wanted first byte, not a range join."""
    r = ranges.withColumn("cell", F.explode(F.sequence(F.expr(f"s div {cell}"), F.expr(f"e div {cell}"))))
    met = wanted.withColumn("cell", F.expr(f"o div {cell}")).join(r, ["w", "cell"]).filter((F.col("s") <= F.col("o")) & (F.col("o") + F.col("l") - 1 <= F.col("e")))
    best = met.groupBy("w", "o", "l").agg(F.min(F.struct((F.col("e") - F.col("s")).alias("n"), "s", "key")).alias("best"))
    return best.select("w", "o", "l", "best.s", "best.key")


def _append(spark: SparkSession, cache: str, got: DataFrame) -> None:
    fresh = got.filter("blob is not null").select("w", F.col("slice_start").alias("s"), (F.col("slice_start") + F.length("blob") - 1).alias("e"), F.sha2("blob", 256).alias("key"), "blob").filter("e >= s")
    new = fresh.join(_table(spark, cache, "blobs", BLOBS).select("key"), "key", "left_anti").groupBy("key").agg(F.first("blob").alias("blob"))
    new.withColumn("part", F.substring("key", 1, 2)).write.mode("append").partitionBy("part").parquet(f"{cache}/blobs")
    fresh.select("w", "s", "e", "key").write.mode("append").parquet(f"{cache}/ranges")


def fetch_through(spans: DataFrame, fetch: Fetch, cache: str, tasks: int, max_gap: int = 256_000, max_slice: int = 25_000_000, key: str = "w", offset: str = "o", length: str = "l") -> DataFrame:
    """(key, o, l, bytes, how) of distinct valid ranges: how is 'cached', 'fetched' or 'failed'.

    Ranges that lie in a cached one are cut out of it; the others are sliced, fetched and put into the cache, and then cut out
    likewise. A run that breaks off leaves the cache as it was or with whole tables more, and its successor uses them.
    An empty batch touches nothing. Blobs are read by the partitions that their keys name."""
    spark = spans.sparkSession
    wanted = spans.select(F.col(key).alias("w"), F.col(offset).cast("long").alias("o"), F.col(length).cast("long").alias("l")).filter((F.col("o") >= 0) & (F.col("l") > 0)).distinct()
    base = scratch(spark)
    covering(wanted, _table(spark, cache, "ranges", RANGES)).write.parquet(f"{base}/had")
    had = spark.read.parquet(f"{base}/had")
    missing = wanted.join(had, ["w", "o", "l"], "left_anti")
    plan = slices.slice_plan(missing, max_gap, max_slice)
    fetch_slices(plan, fetch, tasks, "w").write.parquet(f"{base}/got")
    got = spark.read.parquet(f"{base}/got")
    _append(spark, cache, got)
    remove(spark, f"{base}/got")
    # What the cache covers now, by the ranges of this batch and of all before.
    now = covering(missing, _table(spark, cache, "ranges", RANGES)).withColumn("how", F.lit("fetched")).union(had.withColumn("how", F.lit("cached")))
    blobs = _table(spark, cache, "blobs", BLOBS)
    part = F.substring("key", 1, 2).alias("part")
    cut = now.select("*", part).join(blobs, ["key", "part"]).select("w", "o", "l", F.substring("blob", (F.col("o") - F.col("s") + 1).cast("int"), F.col("l").cast("int")).alias("bytes"), "how")
    failed = wanted.join(now.select("w", "o", "l"), ["w", "o", "l"], "left_anti").select("w", "o", "l", F.lit(None).cast("binary").alias("bytes"), F.lit("failed").alias("how"))
    return cut.union(failed).withColumnRenamed("w", key)
