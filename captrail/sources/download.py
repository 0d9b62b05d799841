"""Downloads of archive members that can be broken off and taken up again, and a check of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.operators import slices, warc
from captrail.paths import exists

from .fetch import Fetch, fetch_members

ROWS = "w string, o long, l long, bytes binary, sha256 string, how string, error string, batch int"


def downloaded(spark: SparkSession, target: str) -> DataFrame:
    """What is there: (w, o, l, bytes, sha256, how, error, batch), failures included."""
    return spark.read.schema(ROWS).parquet(target) if exists(spark, target) else spark.createDataFrame([], ROWS)


def pending(spans: DataFrame, target: str, batches: int, key: str = "w", offset: str = "o", length: str = "l") -> DataFrame:
    """(w, o, l, batch) of distinct valid members that are not there yet. The batch follows from the place alone: members of a
    stretch of an archive keep together and any run deals them alike."""
    s = spans.select(F.col(key).alias("w"), F.col(offset).cast("long").alias("o"), F.col(length).cast("long").alias("l")).filter((F.col("o") >= 0) & (F.col("l") > 0)).distinct()
    done = downloaded(spans.sparkSession, target).filter("how <> 'failed'").select("w", "o", "l")
    return s.join(done, ["w", "o", "l"], "left_anti").withColumn("batch", F.pmod(F.xxhash64("w", F.expr("o div 100000000")), F.lit(batches)).cast("int"))


def download(spans: DataFrame, fetch: Fetch, target: str, batches: int, tasks: int, max_gap: int = 256_000, max_slice: int = 25_000_000, check: bool = True, stop_after: int | None = None) -> int:
    """Fetches what is pending, batch by batch, into target; the number of batches that had something to do.

    A batch is one Spark write: its members, checked (length, record), with their SHA-256, or their errors. It is committed
    whole under a new file name in its folder or not at all, and a later run asks only for what no committed batch holds, so each
    member is fetched once, however often the run breaks off; failed members are tried again by the next run. `stop_after`
    ends the run early. The driver reads the numbers of batches with something pending, nothing else."""
    spark = spans.sparkSession
    todo = [r.batch for r in pending(spans, target, batches).select("batch").distinct().orderBy("batch").collect()]
    for n, k in enumerate(todo):
        if stop_after is not None and n >= stop_after:
            return n
        some = pending(spans, target, batches).filter(F.col("batch") == k)
        got = fetch_members(some, fetch, tasks, max_gap, max_slice, check=check)
        got.select("w", "o", "l", "bytes", F.sha2("bytes", 256).alias("sha256"), "how", "error").write.mode("append").parquet(f"{target}/batch={k}")
    return len(todo)


def verified(spans: DataFrame, target: str, check: bool = True) -> DataFrame:
    """(w, o, l, state) of the wanted members: 'ok', 'missing', 'failed', 'length' (not as many bytes as asked for), 'digest' (not
    the bytes that were fetched) or 'record' (no archive record). Of several rows of a member one that is not failed counts."""
    spark = spans.sparkSession
    want = spans.select("w", "o", "l").distinct()
    got = downloaded(spark, target).select("w", "o", "l", "bytes", "sha256", "how")
    best = got.withColumn("bad", (F.col("how") == "failed").cast("int"))
    least = best.groupBy("w", "o", "l").agg(F.min("bad").alias("bad"))
    one = best.join(least, ["w", "o", "l", "bad"]).dropDuplicates(["w", "o", "l"])
    one = warc.validate_blobs(one) if check else one.withColumn("fault", F.lit(None).cast("string"))
    state = F.when(F.col("how") == "failed", "failed").when(F.length("bytes") != F.col("l"), "length").when(F.sha2("bytes", 256) != F.col("sha256"), "digest").when(F.col("fault").isNotNull(), "record").otherwise("ok")
    return want.join(one.select("w", "o", "l", state.alias("state")), ["w", "o", "l"], "left").select("w", "o", "l", F.coalesce("state", F.lit("missing")).alias("state"))


def planned_bytes(spans: DataFrame, max_gap: int = 256_000, max_slice: int = 25_000_000) -> DataFrame:
    """(members, wanted_bytes, slices, read_bytes): what a download would read, before it does."""
    plan = slices.slice_plan(spans, max_gap, max_slice)
    return plan.agg(F.coalesce(F.sum("member_count"), F.lit(0)).alias("members"), F.coalesce(F.sum(F.aggregate("members", F.lit(0).cast("long"), lambda a, m: a + m["l"])), F.lit(0)).alias("wanted_bytes"), F.count("*").alias("slices"), F.coalesce(F.sum("slice_len"), F.lit(0)).alias("read_bytes"))
