"""Aggregates and set operations over captures, attempts and audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_row_wins(rows: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Per key the values of its first row in input order."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias("_v")).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def url_sets(rows: DataFrame, key: str, url: str) -> DataFrame:
    """Per key its distinct URLs, as rows (key, url, nth) with their place in order: a key may have any number of them.

    Rows are dealt by range of (key, URL) and written with their part, so a hot key is numbered by many tasks: places within
    a part, after the rows of the key's parts before it."""
    from captrail.paths import written

    d = rows.select(F.col(key).alias("k"), F.col(url).alias("u")).distinct().repartitionByRange("k", "u").withColumn("part", F.spark_partition_id())
    d = written(d, "url-sets")
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy("k", "part").agg(F.count("*").alias("n")).select(F.col("k").alias("tk"), F.col("part").alias("tp"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("k", "part").orderBy("u")) + F.col("before")
    return d.join(totals, F.col("k").eqNullSafe(F.col("tk")) & (F.col("part") == F.col("tp"))).select(F.col("k").alias(key), F.col("u").alias(url), nth.cast("int").alias("nth"))


def error_top(attempts: DataFrame, n: int, col: str = "error") -> DataFrame:
    return attempts.filter(F.col(col).isNotNull() & (F.col(col) != "")).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), col).limit(n)


def durations(attempts: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Least, greatest and mean whole seconds from start to end."""
    s = (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("long")
    return attempts.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).groupBy(key).agg(F.min(s).alias("min_s"), F.max(s).alias("max_s"), F.avg(s).alias("avg_s"), F.count("*").alias("n"))


def having_sum(rows: DataFrame, key: str, value: str, least: int) -> DataFrame:
    return rows.groupBy(key).agg(F.sum(value).alias("total")).filter(F.col("total") >= least)


def mean_of_sums(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.groupBy(key).agg(F.sum(value).alias("s")).agg(F.avg("s").alias("mean_total"))


def sum_or_zero(rows: DataFrame, value: str) -> DataFrame:
    return rows.agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("total"), F.count("*").alias("n"), F.max(value).alias("most"))


def upper_median(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the value at n div 2 + 1 of n in order, by ranks rather than arrays of the group."""
    w = Window.partitionBy(key).orderBy(value)
    r = rows.withColumns({"_r": F.row_number().over(w), "_n": F.count("*").over(Window.partitionBy(key))})
    return r.filter(F.expr("_r = _n div 2 + 1")).select(key, F.col(value).alias("upper_median"))


def percentiles(rows: DataFrame, value: str, at: list[float]) -> DataFrame:
    """Nearest-rank percentiles, interpolated median, least and greatest."""
    from .index import percentile_rank

    return rows.agg(*[percentile_rank(value, p).alias(f"p{round(p * 100)}") for p in at], F.median(value).alias("median"), F.min(value).alias("least"), F.max(value).alias("most"))


def key_sets(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side): keys of one side only ('missing' on the right, 'extra' on the right) or of both ('common')."""
    a, b = left.select(*keys).distinct().withColumn("_l", F.lit(1)), right.select(*keys).distinct().withColumn("_r", F.lit(1))
    side = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").otherwise("common")
    return a.join(b, keys, "full_outer").select(*keys, side.alias("side"))


def bag_union(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, columns by name, absent ones null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def bag_union_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """(collection, n): rows of each part, the parts named by their collection; parts without rows count 0."""
    named = bag_union([p.select(F.lit(name).alias("collection"), F.lit(1).alias("n")) for name, p in parts.items()])
    spark = named.sparkSession
    every = spark.createDataFrame([(name,) for name in parts], "collection string")
    return every.join(named.groupBy("collection").agg(F.sum("n").alias("n")), "collection", "left").fillna(0)


def sampled(rows: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """n rows in the order of a seeded hash: a uniform sample that is the same on each run and in each engine with MD5."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)


def newest(rows: DataFrame, order: str, n: int, ties: str) -> DataFrame:
    """The n rows of the latest order, the smaller of ties first."""
    return rows.orderBy(F.col(order).desc(), ties).limit(n)


def evict(entries: DataFrame, max_bytes: int, size: str = "size_bytes", time: str = "mtime_ns", part_ns: int = 3_600_000_000_000) -> DataFrame:
    """The oldest cache entries to drop until the rest is within max_bytes; of one time the later by path goes first.

    Sums run in two levels, over whole parts of time and then within a part, so that no task holds all entries."""
    e = entries.withColumn("_part", F.floor(F.col(time) / part_ns))
    newer = Window.orderBy(F.col("_p").desc()).rowsBetween(Window.unboundedPreceding, -1)
    parts = e.groupBy(F.col("_part").alias("_p")).agg(F.sum(size).alias("_bytes")).select("_p", F.coalesce(F.sum("_bytes").over(newer), F.lit(0)).alias("_newer"))
    w = Window.partitionBy("_part").orderBy(F.col(time).desc(), "path").rowsBetween(Window.unboundedPreceding, 0)
    kept = e.join(parts, F.col("_part") == F.col("_p")).withColumn("_kept", F.col("_newer") + F.sum(size).over(w))
    return kept.filter(F.col("_kept") > max_bytes).drop("_part", "_p", "_newer", "_kept")


def directory_usage(files: DataFrame) -> DataFrame:
    """(directory, items, bytes) of (path, size_bytes)."""
    return files.groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("directory")).agg(F.count("*").alias("items"), F.sum("size_bytes").alias("bytes"))


def log_state(lines: DataFrame) -> DataFrame:
    """Per job the last [stage] and the last collection that its log lines name."""
    stage, coll = F.regexp_extract("line", r"^\s*\[([^\]]+)\]", 1), F.regexp_extract("line", "(CC-MAIN-[0-9]{4}-[0-9]{2})", 1)
    marked = lines.select("job", "line_no", F.nullif(stage, F.lit("")).alias("stage"), F.nullif(coll, F.lit("")).alias("collection"))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line_no"))).alias(c)
    return marked.groupBy("job").agg(last("stage"), last("collection"))
