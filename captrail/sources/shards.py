"""Shards in any store that Spark can list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.functions import urls
from captrail.streaming.ingest import file_inventory


def discover(spark: SparkSession, path: str, year: str | None = None, glob: str = "*.parquet") -> DataFrame:
    """(path, size_bytes, mtime_ns, collection, year) of the shards below path, of one year if given; no file is opened.

    Collections and years come from the folders, as 'CC-MAIN-...' or 'collection=CC-MAIN-...', and hidden files are not listed."""
    named = F.regexp_replace("path", "/(collection|year)=", "/")
    found = file_inventory(spark, path, glob).withColumns({"collection": urls.collection_of_path(named), "year": urls.year_of_path(named)})
    return found.filter(F.col("year") == year) if year else found
