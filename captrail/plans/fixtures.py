"""Capture pointers and byte spans derived from the driver's tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.functions import urls

_PTR = """
select page_id, collection, concat('cdx-0000', cast(page_id % 4 as string), '.gz') shard_file,
  concat('202401', lpad(cast(1 + page_id % 28 as string), 2, '0'), '000000') ts, url, host, {H} host_rev,
  cast(case page_id % 10 when 0 then 404 when 1 then 301 else 200 end as int) status,
  case when page_id % 5 = 0 then 'application/pdf' else 'text/html' end mime, md5(html) digest,
  concat('crawl-data/', collection, '/segments/', cast(page_id % 2 as string), case when page_id % 10 = 0 then '/crawldiagnostics/w' else '/warc/w' end,
         cast(page_id % 7 as string), '.warc.gz') warc_filename,
  cast(page_id * 5000 as bigint) warc_offset, cast(length(html) as bigint) warc_length
from (select *,
  case page_id % 3 when 0 then 'CC-MAIN-2024-10' when 1 then 'CC-MAIN-2024-18' else 'CC-MAIN-2025-05' end collection,
  regexp_replace(lower(regexp_extract(url, '^[^:]*://([^/]*)', 1)), '^www[.]', '') host
  from {T}) q"""
#: DuckDB's key of a host column.
REV = "array_to_string(list_reverse(list_filter(string_split({0}, '.'), lambda x: x <> '')), ',')"
PTR_SQL = "ptr as (" + _PTR.format(H=REV.format("host"), T="pages") + ")"
SPANS_SQL = "spans as (select distinct concat('w', cast(l_suppkey % 50 as varchar)) w, cast(l_orderkey as bigint) * 40 + l_linenumber o, cast(l_quantity as bigint) + 10 l from lineitem)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ptr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture pointers over the pages table."""
    p = read(spark, sf_dir, "pages")
    i = F.col("page_id")
    text = lambda c: c.cast("string")
    host = F.regexp_replace(F.lower(F.regexp_extract("url", "^[^:]*://([^/]*)", 1)), "^www[.]", "")
    coll = F.when(i % 3 == 0, "CC-MAIN-2024-10").when(i % 3 == 1, "CC-MAIN-2024-18").otherwise("CC-MAIN-2025-05")
    folder = F.when(i % 10 == 0, "/crawldiagnostics/w").otherwise("/warc/w")
    return p.select(
        "page_id", coll.alias("collection"), F.concat(F.lit("cdx-0000"), text(i % 4), F.lit(".gz")).alias("shard_file"),
        F.concat(F.lit("202401"), F.lpad(text(1 + i % 28), 2, "0"), F.lit("000000")).alias("ts"), "url", host.alias("host"), urls.host_to_rev(host).alias("host_rev"),
        F.when(i % 10 == 0, 404).when(i % 10 == 1, 301).otherwise(200).cast("int").alias("status"),
        F.when(i % 5 == 0, "application/pdf").otherwise("text/html").alias("mime"), F.md5("html").alias("digest"),
        F.concat(F.lit("crawl-data/"), coll, F.lit("/segments/"), text(i % 2), folder, text(i % 7), F.lit(".warc.gz")).alias("warc_filename"),
        (i * 5000).cast("long").alias("warc_offset"), F.length("html").cast("long").alias("warc_length"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte ranges (w, o, l) over the lineitem table."""
    d = read(spark, sf_dir, "lineitem")
    return d.select(F.concat(F.lit("w"), (F.col("l_suppkey") % 50).cast("string")).alias("w"), (F.col("l_orderkey").cast("long") * 40 + F.col("l_linenumber")).alias("o"), (F.col("l_quantity").cast("long") + 10).alias("l")).distinct()


def requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of wanted URLs: every page, its scheme flipped or a slash or 'www.' put on, and one that no page has."""
    p = read(spark, sf_dir, "pages")
    k = F.col("page_id") % 4
    u = F.when(k == 0, F.regexp_replace("url", "^https:", "http:")).when(k == 1, F.concat("url", F.lit("/"))).when(k == 2, F.regexp_replace("url", "^(https?://)", "$1www.")).otherwise(F.col("url"))
    return p.select(u.alias("requested_url")).union(spark.createDataFrame([("https://nowhere.invalid/",)], "requested_url string")).distinct()


REQUESTED_SQL = """requested as (select distinct case page_id % 4 when 0 then regexp_replace(url, '^https:', 'http:') when 1 then concat(url, '/')
  when 2 then regexp_replace(url, '^(https?://)', '\\1www.') else url end requested_url from pages
  union select 'https://nowhere.invalid/')"""
