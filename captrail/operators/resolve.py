"""Resolution of batches of URLs against capture pointers.

The batch is the small side of an equi-join; Spark broadcasts it only if its measured size is under the broadcast limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captrail import paths
from captrail.functions import urls

from .search import newest_first

PLACE = ["warc_filename", "warc_offset", "warc_length"]


def with_variants(requested: DataFrame, url_col: str = "requested_url") -> DataFrame:
    """(url, requested_url): each spelling under which a requested URL may have been captured."""
    r = requested.select(F.col(url_col).alias("requested_url")).distinct()
    return r.select(F.explode(urls.url_variants("requested_url")).alias("url"), "requested_url").distinct()


def url_join(pointers: DataFrame, requested: DataFrame, url_col: str = "requested_url") -> DataFrame:
    """All captures of any spelling of the requested URLs, one row for each place in an archive."""
    hit = pointers.join(with_variants(requested, url_col), "url")
    return hit.dropDuplicates(["requested_url", "warc_filename", "warc_offset", "warc_length"])


def url_top(pointers: DataFrame, requested: DataFrame, per_url: int, url_col: str = "requested_url") -> DataFrame:
    """At most per_url captures of each requested URL, newest first (none or less: all), with their rank."""
    w = Window.partitionBy("requested_url").orderBy(*newest_first(), F.col("warc_length"))
    hit = url_join(pointers, requested, url_col).withColumn("rank", F.row_number().over(w))
    return hit.filter(F.col("rank") <= per_url) if per_url > 0 else hit


def capture_counts(pointers: DataFrame, requested: DataFrame, url_col: str = "requested_url") -> DataFrame:
    """One row for each requested URL: n, the number of its captures, 0 without any."""
    n = url_join(pointers, requested, url_col).groupBy("requested_url").agg(F.count("*").alias("n"))
    return requested.select(F.col(url_col).alias("requested_url")).distinct().join(n, "requested_url", "left").fillna(0, ["n"])


def resolve(pointers: DataFrame, requested: DataFrame, per_url: int, url_col: str = "requested_url") -> DataFrame:
    """One row for each requested URL: its newest captures as an array of per_url at most, empty without any."""
    if per_url < 1:
        raise ValueError("per_url bounds the array; all captures are rows of url_join()")
    hit = url_top(pointers, requested, per_url, url_col)
    each = hit.groupBy("requested_url").agg(F.array_sort(F.collect_list(F.struct("rank", "collection", "ts", "url", "status", "mime", "warc_filename", "warc_offset", "warc_length"))).alias("captures"))
    all_of = requested.select(F.col(url_col).alias("requested_url")).distinct()
    return all_of.join(each, "requested_url", "left").withColumn("captures", F.coalesce("captures", F.array().cast(each.schema["captures"].dataType)))


def canonical_match(pointers: DataFrame, requested: DataFrame, url_col: str = "requested_url") -> DataFrame:
    """Captures whose canonical URL is that of a requested one, many to many."""
    r = requested.select(F.col(url_col).alias("requested_url"), urls.canonical_url(url_col).alias("canonical")).filter("canonical <> ''").distinct()
    return pointers.withColumn("canonical", urls.canonical_url("url")).join(r, "canonical")


def per_url_cap_by_domain(pointers: DataFrame, requested: DataFrame, per_url: int, per_domain: int, url_col: str = "requested_url") -> DataFrame:
    """The other strategy: at most per_domain captures of each requested host, newest first, then matched by canonical URL."""
    hosts = requested.select(urls.host_to_rev_or_null(urls.extract_host(url_col)).alias("host_rev")).dropna().distinct()
    w = Window.partitionBy("host_rev").orderBy(*newest_first())
    some = pointers.join(hosts, "host_rev", "left_semi").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_domain).drop("_n")
    cap = Window.partitionBy("requested_url").orderBy(*newest_first())
    return canonical_match(some, requested, url_col).withColumn("rank", F.row_number().over(cap)).filter(F.col("rank") <= per_url)


def url_top_by_folder(spark: SparkSession, path: str, requested: DataFrame, per_url: int, url_col: str = "requested_url", folders: int = 1) -> DataFrame:
    """url_top() over a layout by year and collection, which is read folder by folder, the newest collection first, and only until
    every requested URL has per_url captures: older folders are then neither listed nor opened.

    A round reads `folders` collections. It joins them with the spellings of the URLs that are still open, each with the number of
    captures it has, so a later rank goes on from there. What a round found and what it leaves open are written, so a lost
    executor costs one round; only the number of open rows reaches the driver. A place that a newer collection named counts once."""
    if per_url < 1:
        raise ValueError("without a limit nothing is ever satisfied: use url_join()")
    names = {p.rsplit("collection=", 1)[1]: p for p in paths.matching(spark, f"{path}/year=*/collection=*")}
    newest = sorted(names, reverse=True)
    base = paths.scratch(spark)
    wanted = with_variants(requested, url_col).withColumn("had", F.lit(0))
    wanted.write.parquet(f"{base}/open-0")
    found, k = None, 0
    order = Window.partitionBy("requested_url").orderBy(*newest_first(), F.col("warc_length"))
    while k * folders < len(newest):
        still = spark.read.parquet(f"{base}/open-{k}")
        if not still.count():
            break
        some = [names[c] for c in newest[k * folders : (k + 1) * folders]]
        hit = spark.read.option("basePath", path).parquet(*some).join(still, "url").dropDuplicates(["requested_url", *PLACE])
        if found is not None:
            same = found.select(*[F.col(c).alias(f"_{c}") for c in ("requested_url", *PLACE)])
            hit = hit.join(same, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("requested_url", *PLACE)], "left_anti")
        hit = hit.withColumn("rank", F.row_number().over(order) + F.col("had")).filter(F.col("rank") <= per_url)
        hit.drop("had").write.parquet(f"{base}/found/round={k}")
        found = spark.read.parquet(f"{base}/found").drop("round")
        more = spark.read.parquet(f"{base}/found/round={k}").groupBy("requested_url").agg(F.max("rank").alias("reached"))
        left = still.join(more, "requested_url", "left").withColumn("had", F.coalesce("reached", "had")).drop("reached")
        left.filter(F.col("had") < per_url).write.parquet(f"{base}/open-{k + 1}")
        paths.remove(spark, f"{base}/open-{k}")
        k += 1
    if found is None:  # a layout without folders, or nothing requested
        return url_top(spark.createDataFrame([], "collection string, ts string, url string, warc_filename string, warc_offset long, warc_length long"), requested, per_url, url_col)
    return found
