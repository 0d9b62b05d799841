"""Views and table functions for SQL users: temporary ones, over tables that exist already."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import index

#: The reversed key of a domain or URL, as search.key_of(); the argument is a literal, so the key is one too when the query is planned.
#: (No lambda in it: Spark folds constants only without them.)
KEY = "array_join(reverse(array_remove(split(regexp_replace(substring_index(regexp_replace(regexp_replace(lower(trim({0})), '^http://', ''), '^https://', ''), '/', 1), '^www[.]', ''), '[.]'), '')), ',')"


def create_views(pointers: DataFrame, name: str = "captures") -> list[str]:
    """Temporary views <name>, <name>_by_collection and <name>_by_year; their names. They hold plans, no rows."""
    views = {name: pointers, f"{name}_by_collection": (per := index.registry_year(pointers)), f"{name}_by_year": index.registry_master(per)}
    for v, df in views.items():
        df.createOrReplaceTempView(v)
    return list(views)


def create_functions(spark: SparkSession, columns: str, view: str = "captures") -> list[str]:
    """Temporary table functions over the view, whose columns are given as DDL; their names.

    captures_of(domain): the domain and its subdomains. captures_between(domain, first, last): those with times from first to last. url_captures(prefix):
    URLs that start so. Functions are unfolded into the query, so filters reach the scan as they would from a DataFrame."""
    subtree = f"(host_rev = {KEY.format('domain')} or startswith(host_rev, concat({KEY.format('domain')}, ','))) and {KEY.format('domain')} <> ''"
    bodies = {
        "captures_of(domain string)": subtree,
        "captures_between(domain string, first string, last string)": f"{subtree} and ts between first and last",
        "url_captures(prefix string)": "startswith(url, prefix)",
    }
    for head, cond in bodies.items():
        spark.sql(f"create or replace temporary function {head} returns table ({columns}) return select * from {view} where {cond}")
    return [h.split("(")[0] for h in bodies]
