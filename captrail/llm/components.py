"""Connected components by alternating large-star and small-star steps, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables


def _star(links: DataFrame, large: bool, tables: Tables) -> DataFrame:
    """links (u, v): each u's neighbours are linked with the smallest of u and them; large: only neighbours above u move."""
    # Written, so that the join deals both sides anew and Spark can split the partition of a hot centre u.
    least = tables.put(links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    moved = links.join(least, "u")
    if large:
        out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    out = tables.put(out.filter("u <> v").distinct(), "star")
    tables.drop(least)
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b", tables: Tables | None = None) -> DataFrame:
    """(id, component) for each id that has an edge; component is the smallest id reachable.

    Edges between null ids and loops are ignored. Rounds end when all edges lead to roots, one from each id: that is the fixed
    point. The result is a stored table; each round is written to the shared folder, and only two flags of it reach the driver."""
    tables = tables or Tables(edges.sparkSession, "links")
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    e = tables.put(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    done = False
    while not done:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True, tables)
        tables.drop(e)
        e = _star(large, False, tables)
        tables.drop(large)
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(e.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        done = not ends.agg(F.max((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0)))).first()[0]
    roots = e.select(F.col("v").alias("id")).distinct()
    out = tables.put(e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select("id", F.col("id").alias("component"))), "labels")
    tables.drop(e)
    return out
