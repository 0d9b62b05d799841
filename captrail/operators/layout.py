"""Writing capture tables: sorted by host key, partitioned by year and collection, row groups of a wanted size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captrail.functions import urls

ORDER = ("host_rev", "url", "ts")


def sorted_layout(pointers: DataFrame, partitions: int, folders: tuple[str, ...] = ()) -> DataFrame:
    """Rows dealt in ranges of (host_rev, url), so that a hot host spreads over several files, and sorted, nulls last.

    Folders of a partitioned write come first in the order, else the writer would sort anew by them alone."""
    order = [F.col(c).asc_nulls_last() for c in ORDER]
    return pointers.repartitionByRange(partitions, *order[:2]).sortWithinPartitions(*folders, *order)


def write_sorted(pointers: DataFrame, path: str, partitions: int, rows_per_group: int | None = None, bloom: bool = False, codec: str = "zstd") -> None:
    """Parquet below path, by year and collection; Spark's commit makes each write whole or absent.

    Row groups have rows_per_group rows, if given, or fewer where Parquet's size in bytes is reached before. A bloom filter on
    url helps URL batches."""
    out = sorted_layout(pointers.withColumn("year", urls.collection_year("collection")), partitions, ("year", "collection"))
    w = out.write.mode("overwrite").option("compression", codec).partitionBy("year", "collection")
    if rows_per_group:
        w = w.option("parquet.block.row.count.limit", rows_per_group)
    if bloom:
        w = w.option("parquet.bloom.filter.enabled#url", "true")
    w.parquet(path)


def write_shards(pointers: DataFrame, path: str, rows_per_group: int, codec: str = "zstd") -> None:
    """One sorted file for each (collection, shard_file), in a folder of its own, with row groups of rows_per_group rows each
    (the last has the rest). A shard is written by one task, as a sorted file must be; its size is that of its listing."""
    order = [F.col(c).asc_nulls_last() for c in (*ORDER, "warc_offset")]
    out = pointers.repartition("collection", "shard_file").sortWithinPartitions("collection", "shard_file", *order)
    w = out.write.mode("overwrite").option("compression", codec).option("parquet.block.row.count.limit", rows_per_group)
    w.partitionBy("collection", "shard_file").parquet(path)


def recompress(spark, source: str, target: str, codec: str = "zstd") -> bool:
    """Writes the files below source anew with the codec, if any has another one; whether it did."""
    from captrail.sources.footers import footers

    other = footers(spark, source).filter(F.exists("codecs", lambda c: c != codec))
    if other.isEmpty():
        return False
    spark.read.parquet(source).write.mode("overwrite").option("compression", codec).parquet(target)
    return True


def write_or_mark(df: DataFrame, path: str) -> DataFrame:
    """Writes a shard; one without rows becomes a table with the schema and no rows. (path, rows, is_empty) says which, in
    place of a marker file beside it."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    n = df.sparkSession.read.schema(df.schema).parquet(path).agg(F.count("*").alias("rows"))
    return n.select(F.lit(path).alias("path"), "rows", (F.col("rows") == 0).alias("is_empty"))


def with_provenance(df: DataFrame, collection: str, shard_file: str) -> DataFrame:
    """The table with collection and shard_file, first and filled in where absent; other columns keep their order."""
    out = df
    for name, value in (("collection", collection), ("shard_file", shard_file)):
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))
    return out.select("collection", "shard_file", *[c for c in df.columns if c not in ("collection", "shard_file")])


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object a line, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_candidates(df: DataFrame, path: str, form: str = "jsonl") -> None:
    """'jsonl', 'csv', 'list' (one archive name a line) or 'json' (one array; a report, so its rows meet in one task)."""
    if form == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif form == "json":
        rows = df.agg(F.array_sort(F.collect_list(F.struct("warc_filename", *[c for c in df.columns if c != "warc_filename"]))).alias("rows"))
        rows.select(F.to_json("rows", {"ignoreNullFields": "false"})).write.mode("overwrite").text(path)
    elif form == "list":
        df.select("warc_filename").write.mode("overwrite").text(path)
    else:
        write_jsonl(df, path)
