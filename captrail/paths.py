"""Scratch folders that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where the session names none, as in tests, below a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base or tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/captrail-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to a shared folder and read again."""
    path = f"{scratch(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The files and folders that a pattern names, in any store that Spark reads."""
    at, fs = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(at) or [])


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _hadoop(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _hadoop(spark, path)
    fs.delete(at, True)


def store(path: str):
    """(file system, path in it) for tasks, which have no JVM: local paths, and the URIs that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def clear_partitions(table: str, keys: DataFrame) -> None:
    """Deletes the folders of a partitioned table that the rows of keys name, in the order of its columns; null is Hive's default name.

    The names pass the driver one by one."""
    spark = keys.sparkSession
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in keys.toLocalIterator():
        parts = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if r[c] is None or r[c] == '' else escaped(str(r[c]))}" for c in keys.columns]
        remove(spark, "/".join([table, *parts]))
