"""Searches over capture pointers: host subtrees, patterns, ranking, caps, pages, facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captrail.functions import urls
from captrail.functions.values import free

#: The total order of captures: newest collection and time first, then place in the archive.
def newest_first() -> list[Column]:
    return [F.col("collection").desc_nulls_last(), F.col("ts").desc_nulls_last(), F.col("warc_filename").asc_nulls_last(), F.col("warc_offset").asc_nulls_last(), F.col("url").asc_nulls_last()]


def in_subtree(host_rev: str, col: str = "host_rev", include_subdomains: bool = True) -> Column:
    """Exact key or a key under it; literals, so that both parts reach the Parquet scan."""
    exact = F.col(col) == host_rev
    return exact | F.col(col).startswith(host_rev + ",") if include_subdomains else exact


def key_of(domain: str) -> str:
    """The reversed key of a domain or URL given by a caller (a Python value, so that filters on it are pushed down)."""
    d = (domain or "").strip().lower()
    for scheme in ("http://", "https://"):
        d = d.removeprefix(scheme)
    return ",".join(reversed([p for p in d.split("/", 1)[0].removeprefix("www.").split(".") if p]))


def domain_search(pointers: DataFrame, domain: str, include_subdomains: bool = True, year: str | None = None, collections: list[str] | None = None) -> DataFrame:
    """Captures of a domain and, unless told otherwise, of its subdomains. An empty domain finds nothing."""
    key = key_of(domain)
    found = pointers.filter(in_subtree(key, include_subdomains=include_subdomains) if key else F.lit(False))
    if year:  # a year column is a folder of the layout, so that other years are not listed
        found = found.filter(F.col("year") == int(year) if "year" in found.columns else urls.collection_year("collection") == year)
    return found.filter(F.col("collection").isin(collections)) if collections else found


def host_fallback(pointers: DataFrame, domain: str) -> DataFrame:
    """For tables without a key: the host itself or a host that ends in a dot and it."""
    d = domain.lower()
    return pointers.filter((F.col("host") == d) | F.col("host").endswith("." + d))


def many_domains(pointers: DataFrame, domains: DataFrame, domain_col: str = "domain") -> DataFrame:
    """Captures in the subtree of any of the domains, each with the domain that found it, in one join on ancestor keys."""
    keys = domains.select(F.col(domain_col).alias("found_by"), urls.host_to_rev(urls.normalize_domain(domain_col)).alias("key")).filter("key <> ''").distinct()
    return pointers.withColumn("key", F.explode(urls.ancestors("host_rev"))).join(keys, "key").drop("key")


def tld_search(pointers: DataFrame, tld: str) -> DataFrame:
    return pointers.filter(in_subtree(key_of(tld)))


def url_contains(pointers: DataFrame, text: str) -> DataFrame:
    return pointers.filter(F.col("url").contains(text))


def url_prefix(pointers: DataFrame, prefix: str) -> DataFrame:
    return pointers.filter(F.col("url").startswith(prefix))


def collection_like(pointers: DataFrame, pattern: str) -> DataFrame:
    return pointers.filter(F.col("collection").like(pattern))


def valid_ranges(pointers: DataFrame) -> DataFrame:
    """Rows whose bytes can be fetched."""
    return pointers.filter((F.col("warc_offset") >= 0) & (F.col("warc_length") > 0) & (F.col("warc_filename") != ""))


def ranked(found: DataFrame) -> DataFrame:
    """With score, best first: score, then time, then the total order."""
    at = F.when(F.col("ts").rlike("^[0-9]+$"), F.col("ts").try_cast("long")).otherwise(0)
    scored = found.withColumn("score", urls.wayback_score("warc_filename", "status", "mime"))
    return scored.orderBy(F.col("score").desc(), at.desc(), *newest_first())


def capped(found: DataFrame, max_files: int = 0, max_per_file: int = 0, max_matches: int = 0) -> DataFrame:
    """At most so many shards of a collection, rows of a shard and rows in all, by the total order; none or less is no cap.

    Rows are capped before shards are, so that what a collection's shards are ranked by is few rows; Spark applies both ranks
    within tasks first. The input is computed once, but for a cap on shards alone."""
    out = found
    row, file = free(out, "_row", "_file")
    if max_per_file > 0:
        rows = Window.partitionBy("collection", "shard_file").orderBy(*newest_first())
        out = out.withColumn(row, F.row_number().over(rows)).filter(F.col(row) <= max_per_file).drop(row)
    files = Window.partitionBy("collection").orderBy("shard_file")
    if max_files > 0 and max_per_file > 0:
        out = out.withColumn(file, F.dense_rank().over(files)).filter(F.col(file) <= max_files).drop(file)
    elif max_files > 0:
        some = out.select("collection", "shard_file").distinct().withColumn(file, F.row_number().over(files)).filter(F.col(file) <= max_files)
        out = out.join(some.drop(file), ["collection", "shard_file"], "left_semi")
    return out.orderBy(*newest_first()).limit(max_matches) if max_matches > 0 else out


def result_filter(found: DataFrame, status: str = "", mime: str = "") -> DataFrame:
    """Rows of a status and of a mime type, compared as trimmed text; '' is any."""
    if status.strip():
        found = found.filter(F.trim(F.col("status").cast("string")) == status.strip())
    return found.filter(F.trim("mime") == mime.strip()) if mime.strip() else found


def facets(found: DataFrame) -> DataFrame:
    """(facet, value, n): the statuses and mime types of a result."""
    both = found.select(F.explode(F.array(F.struct(F.lit("status").alias("facet"), F.col("status").cast("string").alias("value")), F.struct(F.lit("mime").alias("facet"), F.col("mime").alias("value")))).alias("f"))
    return both.select("f.*").filter("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def page(found: DataFrame, offset: int = 0, size: int = 50) -> DataFrame:
    return ranked(found).offset(max(0, offset)).limit(size)


def catalog_search(catalog: DataFrame, text: str) -> DataFrame:
    t = text.lower()
    return catalog.filter(F.lower("id").contains(t) | F.lower("name").contains(t))


def catalog_years(catalog: DataFrame) -> DataFrame:
    """Distinct years of collection names, newest first."""
    y = F.regexp_extract("id", "CC-MAIN-([0-9]{4})", 1)
    return catalog.select(y.alias("year")).filter("year <> ''").distinct().orderBy(F.col("year").desc())
