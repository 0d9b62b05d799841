"""Search from the top of the index hierarchy: years, their collections, the shards of a host, the rows of these shards."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from captrail.functions import urls
from captrail.paths import written

from . import index, layout, search


def build(pointers: DataFrame, path: str, partitions: int) -> None:
    """Writes the levels below path: master (a row a year, with the schema of the rows), years (a row a collection, by year), shards
    (hosts of each shard, by year and collection) and rows (the captures, by year, collection and shard, sorted)."""
    spark = pointers.sparkSession
    rows = pointers.withColumn("year", urls.collection_year("collection"))
    folders = ("year", "collection", "shard_file")
    layout.sorted_layout(rows, partitions, folders).write.mode("overwrite").option("compression", "zstd").partitionBy(*folders).parquet(f"{path}/rows")
    built = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    shards = index.domain_shards(built)
    shards.repartitionByRange(partitions, "year", "collection", "host_rev").sortWithinPartitions("year", "collection", "host_rev").write.mode("overwrite").partitionBy("year", "collection").parquet(f"{path}/shards")
    by_collection = index.registry_year(built)
    by_collection.write.mode("overwrite").partitionBy("year").parquet(f"{path}/years")
    master = index.registry_master(spark.read.schema(by_collection.schema).parquet(f"{path}/years"))
    master.withColumn("rows_schema", F.lit(rows.schema.json())).write.mode("overwrite").parquet(f"{path}/master")


SHARDS, YEARS = "shard_file string, host_rev string, host string, year string, collection string", "year string, collection string"


def _held(spark: SparkSession, path: str, domain: str, year: str | None, collections: list[str] | None) -> DataFrame:
    """(shard_file, host_rev, year, collection): the hosts of the subtree and where they are, by years and collections that the registries name."""
    years = spark.read.parquet(f"{path}/master").select("year")
    years = years.filter(F.col("year") == year) if year else years
    named = spark.read.schema(YEARS).parquet(f"{path}/years").join(years, "year", "left_semi").select("year", "collection")
    named = named.filter(F.col("collection").isin(collections)) if collections else named
    key = search.key_of(domain)
    held = spark.read.schema(SHARDS).parquet(f"{path}/shards").filter(search.in_subtree(key) if key else F.lit(False))
    return held.join(named, ["year", "collection"], "left_semi").select("shard_file", "host_rev", "year", "collection")


def shards_of(spark: SparkSession, path: str, domain: str, year: str | None = None, collections: list[str] | None = None) -> DataFrame:
    """(year, collection, shard_file) that hold the domain or a subdomain."""
    return _held(spark, path, domain, year, collections).select("year", "collection", "shard_file").distinct()


def find(spark: SparkSession, path: str, domain: str, year: str | None = None, collections: list[str] | None = None) -> DataFrame:
    """The captures of a domain. What the shard level finds is written, so its size is known, and prunes the folders of the rows while
    the query runs (dynamic partition pruning, if Spark finds it small enough to broadcast; else a join by shuffle). The key filter
    is pushed to the files that are left."""
    known = spark.read.parquet(f"{path}/master").select("rows_schema").first()
    if known is None:
        raise ValueError(f"nothing was built below {path}")
    rows = spark.read.schema(StructType.fromJson(json.loads(known[0]))).parquet(f"{path}/rows")  # no file is opened to learn it
    key = search.key_of(domain)
    rows = rows.filter(search.in_subtree(key) if key else F.lit(False))
    if not key:
        return rows
    # The list is a table of its own: a pruning filter within it would keep Spark from sharing its broadcast with the pruning.
    held = written(_held(spark, path, domain, year, collections), "held").filter(search.in_subtree(key))
    return rows.join(held, ["year", "collection", "shard_file"], "left_semi")


def find_by_zones(spark: SparkSession, path: str, zones: DataFrame, host: str, folders: tuple[str, ...] = ("collection", "shard_file")) -> DataFrame:
    """The captures of one host in a layout with the given folders, by a zone map (folders, min_key, max_key).

    The map is written once; while the query runs, the zones that may hold the key prune the folders of the layout, and
    within the files that are left Spark skips row groups by the pushed key. Zones without bounds hold no key."""
    key = search.key_of(host)
    rows = spark.read.parquet(path)
    if not key:
        return rows.filter(F.lit(False))
    held = index.zone_point(written(zones.select(*folders, "min_key", "max_key"), "zones"), key)
    return rows.filter(F.col("host_rev") == key).join(held.select(*folders), list(folders), "left_semi")
