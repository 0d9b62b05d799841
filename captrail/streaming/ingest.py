"""Incremental ingestion of capture listings: new files by a file stream, changed files by a stream of fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail import paths
from captrail.functions import urls
from captrail.operators.index import fingerprint_diff
from captrail.sources.cdxj import parse_cdxj, read_cdxj


def ingest_new(spark: SparkSession, source: str, target: str, checkpoint: str, glob: str = "cdx-*") -> None:
    """Appends the pointers of listing files not seen before to target; returns when all present files are done.

    The checkpoint remembers paths: files that change under an old name need changed_files()."""
    lines = spark.readStream.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(source)
    path = F.col("_metadata.file_path")
    named = lines.withColumns({"shard_file": F.regexp_extract(path, "([^/]+)$", 1), "collection": F.nullif(F.regexp_extract(path, "(CC-MAIN-[^/]*)", 1), F.lit(""))})
    stream = parse_cdxj(named).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size_bytes, mtime_ns) of the files below path; contents are not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return f.select("path", F.col("length").alias("size_bytes"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"))


def changed_files(known: DataFrame, present: DataFrame) -> DataFrame:
    """Files to ingest again or for the first time."""
    return fingerprint_diff(known, present).filter("state in ('extra', 'changed')").select("path")


SOURCE = ("collection", "shard_file")
FINGERPRINT = "path string, size_bytes long, mtime_ns long"


def known_files(spark: SparkSession, state: str) -> DataFrame:
    """(path, size_bytes, mtime_ns) as last ingested, by the batches that recorded them; the latest batch counts."""
    if not paths.exists(spark, state):
        return spark.createDataFrame([], FINGERPRINT)
    rows = spark.read.schema(FINGERPRINT + ", batch long").parquet(state)
    return rows.groupBy("path").agg(F.max(F.struct("batch", "size_bytes", "mtime_ns")).alias("at")).select("path", "at.size_bytes", "at.mtime_ns")


def announce_changes(spark: SparkSession, source: str, state: str, queue: str, glob: str = "cdx-*") -> int:
    """Appends the fingerprints of new and changed files below source to the queue, for replace_changed(); how many there are."""
    present = file_inventory(spark, source, glob)
    changed = changed_files(known_files(spark, state), present)
    path = paths.scratch(spark)
    present.join(changed, "path", "left_semi").write.parquet(path)
    found = spark.read.schema(FINGERPRINT).parquet(path)
    n = found.count()
    if n:
        found.coalesce(1).write.mode("append").parquet(queue)
    paths.remove(spark, path)
    return n


def replace_changed(spark: SparkSession, queue: str, target: str, state: str, checkpoint: str, files_per_batch: int = 8) -> None:
    """Ingests the files that the queue announces into target, a table by collection and shard; ends when the queue is done.

    Each micro-batch deletes and inserts by source: a dynamic partition overwrite replaces the folders of its shards, whatever they
    held, so a file that changed under its name is there once, and a batch that runs again gives the same table. Its fingerprints are
    recorded under the number of the batch, by overwriting, after the rows are there. A file that has gone since is
    left as it was. The driver holds the names of one batch's files, as Spark does for any scan."""

    def run(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        there = sorted(r.path for r in batch.select("path").distinct().collect() if paths.exists(s, r.path))
        if there:
            rows = parse_cdxj(read_cdxj(s, there)).repartition(*SOURCE).sortWithinPartitions(*SOURCE, "host_rev", "url", "ts")
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SOURCE).parquet(target)
            # Files without a row left: nothing was written over what they held.
            path = F.col("path")
            files = batch.filter(path.isin(there)).select(urls.collection_of_path("path").alias("collection"), F.regexp_extract(path, "([^/]+)$", 1).alias("shard_file")).distinct()
            held = rows.select(*[F.col(c).alias(f"_{c}") for c in SOURCE]).distinct()
            paths.clear_partitions(target, files.join(held, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SOURCE], "left_anti"))
        batch.filter(F.col("path").isin(there)).select("path", "size_bytes", "mtime_ns").distinct().write.mode("overwrite").parquet(f"{state}/batch={number}")

    stream = spark.readStream.schema(FINGERPRINT).option("maxFilesPerTrigger", files_per_batch).parquet(queue)
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
