"""Capture listings as DataFrames: CDXJ text, legacy CDX text, JSONL, CSV, catalogs, tolerant Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.functions import urls
from captrail.functions.values import col_or_null, lenient_int
from captrail.schemas import CATALOG_DDL, PLANNER_CSV_DDL, POINTERS_DDL

#: The JSON part of a CDXJ line; numbers come as text there.
META = "url string, status string, mime string, `mime-detected` string, digest string, filename string, offset string, length string, languages string, encoding string"


def read_cdxj(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of cdx-*.gz below <root>/<collection>/ with the file they are from; gzip files are one task each."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_path"))
    return lines.withColumns({"shard_file": F.regexp_extract("source_path", "([^/]+)$", 1), "collection": urls.collection_of_path("source_path"), "year": urls.year_of_path("source_path")})


def parse_cdxj(lines: DataFrame, require_url: bool = True, least_parts: int = 1, value: str = "value", keep_meta: bool = False) -> DataFrame:
    """Pointers from CDXJ lines: '<surt> <ts> {json}' or '<surt> <ts> <url> {json}'.

    Blank lines and lines from '#' go; bad JSON counts as empty. With require_url rows without a URL go. Columns
    collection and shard_file are taken over where the lines have them. With keep_meta the whole JSON object stays as a VARIANT
    column `meta`, keys outside the fixed schema included; it is an empty object where the JSON is absent, bad or no object."""
    line = urls.strip(value)
    at = F.instr(line, "{")
    pre = urls.strip(F.when(at > 0, F.substring(line, F.lit(1), at - 1)).otherwise(line))
    text = F.when(at > 0, F.substring(line, at, F.length(line)))
    meta = F.from_json(text, META)
    parsed = F.try_parse_json(text)
    kept = [F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed).otherwise(F.parse_json(F.lit("{}"))).alias("meta")] if keep_meta else []
    d = lines.filter((line != "") & ~line.startswith("#")).select(
        col_or_null(lines, "collection"), col_or_null(lines, "shard_file"), F.filter(F.split(pre, r"\s+"), lambda p: p != "").alias("p"), meta.alias("m"), *kept)
    d = d.filter(F.size("p") >= least_parts) if least_parts > 1 else d
    url = F.when(F.size("p") >= 3, F.get("p", 2)).otherwise(F.col("m.url"))
    d = d.withColumn("url", F.coalesce(url, F.col("m.url")) if not require_url else url)
    if require_url:
        d = d.filter(F.col("url").isNotNull() & (F.col("url") != ""))
    host = urls.extract_host("url")
    return d.select(
        "collection", "shard_file", F.coalesce(F.get("p", 0), F.lit("")).alias("surt"), F.get("p", 1).alias("ts"), "url", host.alias("host"), urls.host_to_rev_or_null(host).alias("host_rev"),
        lenient_int(F.col("m.status"), "int").alias("status"), F.col("m.mime").alias("mime"), F.col("m.digest").alias("digest"), F.col("m.filename").alias("warc_filename"),
        lenient_int(F.col("m.offset")).alias("warc_offset"), lenient_int(F.col("m.length")).alias("warc_length"), *(["meta"] if keep_meta else []),
    )


def meta_value(key: str, kind: str = "string", meta: str = "meta") -> Column:
    """A key of the kept JSON object, null where it is absent or of another kind."""
    return F.try_variant_get(meta, f"$['{key}']", kind)


def parse_sample(lines: DataFrame, value: str = "value") -> DataFrame:
    """parse_cdxj() of sampled lines: rows without a URL stay, the time is named timestamp, and hosts are left out."""
    d = parse_cdxj(lines, require_url=False, value=value)
    return d.select("collection", "shard_file", "surt", F.col("ts").alias("timestamp"), "url", "status", "mime", "digest", "warc_filename", "warc_offset", "warc_length")


def parse_legacy(lines: DataFrame, value: str = "value") -> DataFrame:
    """Blank-separated listings: surt, url, ts, and from the ninth column archive, offset and length."""
    p = F.filter(F.split(urls.strip(value), r"\s+"), lambda x: x != "")
    d = lines.select(p.alias("p")).filter(F.size("p") >= 3)
    rev = F.substring_index(F.get("p", 0), ")", 1)
    return d.select(F.get("p", 0).alias("surt"), F.get("p", 1).alias("url"), F.get("p", 2).alias("ts"), F.array_join(F.reverse(F.split(F.translate(rev, ",", "."), "[.]")), ".").alias("host"), rev.alias("host_rev"),
                    F.get("p", 8).alias("warc_filename"), lenient_int(F.get("p", 9)).alias("warc_offset"), lenient_int(F.get("p", 10)).alias("warc_length"))


def read_pointers(spark: SparkSession, *paths: str) -> DataFrame:
    """Pointer files of any age: absent columns are null, 'timestamp' stands in for 'ts', names unite the files."""
    schema = POINTERS_DDL + ", timestamp string"
    df = spark.read.schema(schema).parquet(*paths)
    return df.withColumn("ts", F.coalesce("ts", "timestamp")).drop("timestamp").withColumn("collection", urls.infer_collection("collection", "warc_filename"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of the schema; blank lines, bad JSON and other values go."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_planner_csv(spark: SparkSession, path: str) -> DataFrame:
    """The planner's seed file: five trimmed text columns, '' where missing."""
    d = spark.read.schema(PLANNER_CSV_DDL).option("header", True).option("enforceSchema", False).csv(path)
    return d.select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in d.columns])


def labelled(rows: DataFrame, files: DataFrame, path: str = "source_path") -> DataFrame:
    """rows with the collection of the file they are from, by an equi-join on the file name with (path, collection)."""
    named = lambda c: F.regexp_extract(c, "([^/]+)$", 1)
    f = files.select(named(F.col("path")).alias("_file"), F.col("collection").alias("label")).distinct()
    return rows.withColumn("_file", named(F.col(path))).join(f, "_file").drop("_file")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG_DDL).option("multiLine", True).json(path)


def to_cdxj(pointers: DataFrame, value: str = "value") -> DataFrame:
    """Pointers as CDXJ lines, for tests and exports."""
    meta = F.to_json(F.struct("url", F.col("status").cast("string").alias("status"), "mime", "digest", F.col("warc_filename").alias("filename"), F.col("warc_offset").cast("string").alias("offset"), F.col("warc_length").cast("string").alias("length")))
    surt: Column = F.concat(F.coalesce("host_rev", F.lit("")), F.lit(")/"))
    return pointers.select("collection", "shard_file", F.concat_ws(" ", surt, "ts", meta).alias(value))
