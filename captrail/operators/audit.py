"""Audits of layouts: reasons to rewrite a shard, repair plans, completeness of collections, search completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit_reasons(shards: DataFrame, codec: str = "zstd", target_rows: int | None = None, tolerance: float = 0.25, target_mb: float | None = None) -> DataFrame:
    """shards with reasons array<string>; needs missing_columns array, codecs array, median_rows and median_mb of row groups
    where targets are given, is_sorted (null: unknown)."""
    off = lambda col, target: F.lit(False) if target is None else (F.abs(F.col(col) - target) > tolerance * target)
    far = off("median_rows", target_rows) | off("median_mb", target_mb)
    reasons = F.array(
        F.when(F.size("missing_columns") > 0, "missing_columns"), F.when(F.exists("codecs", lambda c: F.lower(c) != codec), "codec"),
        F.when(far, "row_group_size"), F.when(F.col("is_sorted").isNull(), "sort_unknown").when(~F.col("is_sorted"), "unsorted"),
    )
    return shards.withColumn("reasons", F.array_compact(reasons))


def repair_plan(audited: DataFrame) -> DataFrame:
    """Per collection: shards, shards to repair and counts by reason, the neediest first."""
    n = lambda r: F.sum(F.when(F.array_contains("reasons", r), 1).otherwise(0)).cast("long").alias(f"n_{r}")
    return audited.groupBy("collection").agg(
        F.count("*").alias("shards"), F.sum(F.when(F.size("reasons") > 0, 1).otherwise(0)).cast("long").alias("to_repair"),
        *[n(r) for r in ("missing_columns", "codec", "row_group_size", "unsorted", "sort_unknown")],
    ).orderBy(F.col("to_repair").desc(), "collection")


def reason_counts(audited: DataFrame) -> DataFrame:
    return audited.select("collection", F.explode("reasons").alias("reason")).groupBy("collection", "reason").agg(F.count("*").alias("n"))


def completeness(files: DataFrame, expected: int = 300) -> DataFrame:
    """Per collection of a file inventory (collection, name): shards downloaded, converted, sorted, empty; complete if all are sorted or empty."""
    name = F.col("name")
    one = lambda cond, label: F.countDistinct(F.when(cond, F.regexp_extract("name", "(cdx-[0-9]{5})", 1))).alias(label)
    got = files.groupBy("collection").agg(
        one(name.rlike(r"^cdx-[0-9]{5}\.gz$"), "downloaded"), one(name.rlike(r"^cdx-[0-9]{5}\.gz(\.sorted)?\.parquet$"), "converted"),
        one(name.rlike(r"^cdx-[0-9]{5}\.gz\.sorted\.parquet$"), "sorted"), one(name.endswith(".empty"), "empty"),
    )
    return got.withColumns({"expected": F.lit(expected), "complete": F.col("sorted") + F.col("empty") >= expected})


def pipeline_status(catalog: DataFrame, files: DataFrame, expected: int = 300, indexed: DataFrame | None = None) -> DataFrame:
    """Every collection of the catalog with its counts, zeros where nothing is there, and whether it is in indexed (collection)."""
    out = catalog.select(F.col("id").alias("collection")).join(completeness(files, expected), "collection", "left").fillna(0).fillna(False)
    if indexed is None:
        return out
    return out.join(indexed.select("collection", F.lit(True).alias("indexed")).distinct(), "collection", "left").fillna(False)


def shard_progress(files: DataFrame, ingested: DataFrame, by: str = "year") -> DataFrame:
    """(by, expected, ingested, missing) by 'year' or 'collection': shards of the inventory (collection, name) against those
    of ingested (collection, shard_file). Names other than CC-MAIN-YYYY-WW have no year and are left out there."""
    name = lambda d, c: d.select("collection", F.regexp_extract(c, r"^(cdx-[0-9]{5}\.gz)$", 1).alias("shard")).filter("shard <> ''").distinct()
    both = name(files, "name").withColumn("here", F.lit(1)).join(name(ingested, "shard_file").withColumn("there", F.lit(1)), ["collection", "shard"], "left")
    both = both.withColumn("year", F.nullif(F.regexp_extract("collection", "^CC-MAIN-([0-9]{4})-[0-9]+", 1), F.lit(""))).filter(F.col(by).isNotNull())
    n = both.groupBy(by).agg(F.count("here").alias("expected"), F.count("there").alias("ingested"))
    return n.withColumn("missing", F.col("expected") - F.col("ingested"))


def gaps(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that were not found."""
    return expected.join(found.select(*keys).distinct(), keys, "left_anti")


def search_completeness(indexed: DataFrame, scanned: DataFrame, keys: list[str]) -> DataFrame:
    """(missing, extra, common): the index's answer against a full scan."""
    from .aggregates import key_sets

    n = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, 1).otherwise(0)), F.lit(0)).cast("long")
    return key_sets(scanned, indexed, keys).agg(n("missing").alias("missing"), n("extra").alias("extra"), n("common").alias("common"))


def prefer_sorted(files: DataFrame) -> DataFrame:
    """Of a shard's plain and sorted files the sorted one; nothing from hidden folders."""
    shown = files.filter(~F.col("path").rlike(r"/\."))
    stem = F.regexp_replace("path", r"(\.sorted)?\.parquet$", "")
    return shown.groupBy(stem.alias("stem")).agg(F.max_by("path", F.col("path").endswith(".sorted.parquet").cast("int")).alias("path")).select("path")


def expected_missing(n: Column | int) -> Column:
    """The shard numbers 0 .. n - 1."""
    return F.explode(F.sequence(F.lit(0), F.lit(n) - 1))
