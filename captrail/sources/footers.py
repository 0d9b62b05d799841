"""Parquet footers as a DataFrame: Spark has no footer table, so tasks read file ends through the Hadoop file list."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.schemas import FOOTER_DDL
from captrail.session import ship


def footers(spark: SparkSession, path: str, key: str = "host_rev") -> DataFrame:
    """One row per row group of the files below path: rows, bytes, codecs, columns, least and greatest key.

    Spark lists the files; tasks read the file ends only, through the Arrow file system of the path's scheme."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.strip().split(" ")[0] for x in FOOTER_DDL.split(",")]
        for b in batches:
            for p in b.column("path"):
                fs, inner = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", p.as_py()))
                with fs.open_input_file(inner) as f:
                    meta = pq.ParquetFile(f).metadata
                rows, start = [], 0
                for g in range(meta.num_row_groups):
                    rg = meta.row_group(g)
                    cols = [rg.column(c) for c in range(rg.num_columns)]
                    stats = next((c.statistics for c in cols if c.path_in_schema == key), None)
                    low, high = (str(stats.min), str(stats.max)) if stats is not None and stats.has_min_max else (None, None)
                    rows.append((p.as_py(), g, start, start + rg.num_rows, rg.num_rows, rg.total_byte_size, sorted({c.compression.lower() for c in cols}), low, high, [c.path_in_schema for c in cols]))
                    start += rg.num_rows
                types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string(), pa.list_(pa.string())]
                cells = list(zip(*rows, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=names)

    return files.mapInArrow(run, FOOTER_DDL)


def shard_summary(groups: DataFrame, required: list[str]) -> DataFrame:
    """Per file of footers(): rows, codecs, median rows of a row group, missing columns, order of zones (null: unknown)."""
    from pyspark.sql import Window

    w = Window.partitionBy("path").orderBy("row_group")
    nxt = F.lead("min_value").over(w)
    bad = F.when(F.lead("row_group").over(w).isNull(), False).when(nxt.isNull() | F.col("max_value").isNull(), None).otherwise(F.col("max_value") > nxt)
    g = groups.withColumn("_bad", bad)
    need = F.array(*[F.lit(c) for c in required]).cast("array<string>")
    return g.groupBy("path").agg(
        F.sum("num_rows").alias("rows"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("codecs")))).alias("codecs"), F.median("num_rows").alias("median_rows"), (F.median("total_bytes") / (1024 * 1024)).alias("median_mb"),
        F.array_except(need, F.first("columns")).alias("missing_columns"),
        F.when(F.max(F.col("_bad").cast("int")) == 1, False).when(F.count(F.when(F.col("_bad").isNull(), 1)) > 0, None).otherwise(True).alias("is_sorted"),
    )
