"""Sharding of vector tables for the per-shard search trees.

1. A sample of SAMPLE rows at most (by hash, the same on each run) reaches the driver; some of them are pivots. Each row is
   dealt to the region of its nearest pivot; a region keeps the least and greatest distance of its rows. Regions of many
   rows are cut into shards by a hash, so no shard grows with the table.
2. A query's distance from the k nearest sample rows bounds that of its k nearest rows. In a first round it is answered by
   the region of the nearest pivot, which tightens the bound to the k-th distance found there. By the triangle inequality
   the second round skips all regions whose rows are farther away than that.
3. Shards are put in bundles of a bounded size. A task gets whole bundles, each followed by its queries, so a query's vector
   travels once to a bundle, with the list of the shards that it has to see there. A shard's tree is built when the first
   query asks for it; what a query finds in one shard bounds its search in the next.
4. The k best of each bundle are merged by a window over k rows per query and bundle.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables

#: Rows of the sample, and the most regions.
SAMPLE = 4096
#: Vector components that a bundle of several shards may hold.
CELLS = 1 << 23
#: Relative and absolute slack for rounding in bounds.
SLACK, LEAST = 1e-9, 1e-9


def usable(vectors: DataFrame, id_col: str, vec_col: str, nonzero: bool = False) -> DataFrame:
    """(vec_id, v array<double>, dim): rows with an id and a vector whose components are all finite numbers."""
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    fine = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if nonzero:
        fine = fine & F.exists("v", lambda x: x != 0)
    return v.filter(fine).withColumn("dim", F.size("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a list column, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.float64)


def by_dimension(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = b.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, b.filter(pa.array(dims == dim)) if len(np.unique(dims)) > 1 else b


def distances(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = rows - q
    return np.sqrt((d * d).sum(axis=-1))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all a from all b but for rounding: good enough to choose by, not to bound with."""
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]


def _dealt(rows: DataFrame, pivots: dict[int, np.ndarray], point: Callable) -> DataFrame:
    """rows with region, that of the nearest pivot (-1: there is none of this dimension), and d, the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for dim, b in by_dimension(whole):
                if dim in pivots and len(b):
                    x = point(matrix(b.column("v"), dim))
                    region = squares(x, pivots[dim]).argmin(axis=1)
                    d = distances(x, pivots[dim][region])
                else:
                    region, d = np.full(len(b), -1), np.zeros(len(b))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(region.astype(np.int32)), pa.array(d)], names=[*b.schema.names, "region", "d"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, dim int, region int, d double")


def _bundles(regions: list[tuple[int, int]], shard_rows: int, most: int) -> list[tuple[int, int]]:
    """(first bundle, shards of the region in a bundle) of regions (rows, shards) in order: a bundle holds whole regions of
    `most` rows together, or a part of a larger one, one shard at least."""
    out, at, held = [], 0, 0
    for n, subs in regions:
        if held and held + n > most:
            at, held = at + 1, 0
        each = subs if n <= most else max(1, most // shard_rows)
        out.append((at, each))
        if n <= most:
            held += n
        else:
            at += -(-subs // each)
    return out


def _shard(region: int, sub: int) -> int:
    return (region << 32) + sub


def _routed(queries: DataFrame, sample: dict[int, tuple[np.ndarray, np.ndarray]], regions: dict[int, tuple], point: Callable, bound: Callable, k: int, factor: float, home: bool) -> DataFrame:
    """(row, vec_id, v, dim, tau, bundle, shards) for each bundle of which a query (row, vec_id, v, dim, kth) has to see the
    shards: those of its home region, or all others that it cannot skip. kth is the k-th score found at home, if any."""

    def seen_by(q: np.ndarray, own: int, dim: int, guess: np.ndarray, kth: float | None) -> tuple[float, dict[int, list[int]]]:
        """(tau, shards by bundle) of a query point; guess: its squared distances from the sample, about."""
        ids, rows = sample[dim]
        numbers, centres, near, far, subs, first, each = regions[dim]
        other, tau = np.flatnonzero(ids != own), np.inf
        if len(other) >= k:
            some = other[np.argpartition(guess[other], k - 1)[:k]]
            tau = float(distances(rows[some], q).max()) * (1 + SLACK) + LEAST
        d = distances(centres, q)
        if home:
            chosen = [int(d.argmin())]
        else:
            if kth is not None:
                tau = min(tau, bound(q, kth) * (1 + SLACK) + LEAST)
            low = np.maximum(d - far, near - d) * (1 - SLACK) - LEAST
            low[d.argmin()] = np.inf
            chosen = np.flatnonzero(low * factor <= tau).tolist()
        found = defaultdict(list)
        for r in chosen:
            for j in range(int(subs[r])):
                found[int(first[r]) + j // int(each[r])].append(_shard(int(numbers[r]), j))
        return tau, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for dim, b in by_dimension(whole):
                for at in range(0, len(b), 256):
                    part = b.slice(at, 256)
                    q = point(matrix(part.column("v"), dim))
                    guess = squares(q, sample[dim][1]) if dim in sample else None
                    found: list[tuple] = []
                    for i, (own, kth) in enumerate(zip(part.column("vec_id").to_pylist(), part.column("kth").to_pylist(), strict=True)):
                        # Rows of a dimension that the sample lacks are one region of their own.
                        tau, bundles = seen_by(q[i], own, dim, guess[i], kth) if dim in sample else (np.inf, {-1: [_shard(-1, 0)]} if home else {})
                        found += [(i, tau, *x) for x in bundles.items()]
                        if len(found) > 4096 or i == len(part) - 1 and found:
                            of, taus, bundle, shards = zip(*found, strict=True)
                            got = part.take(pa.array(of, pa.int64()))
                            yield pa.RecordBatch.from_arrays([*[got.column(c) for c in ("row", "vec_id", "v", "dim")], pa.array(taus, pa.float64()), pa.array(bundle, pa.int32()), pa.array(shards, pa.list_(pa.int64()))],
                                                             names=["row", "vec_id", "v", "dim", "tau", "bundle", "shards"])
                            found = []

    return queries.select("row", "vec_id", "v", "dim", "kth").mapInArrow(run, "row long, vec_id long, v array<double>, dim int, tau double, bundle int, shards array<long>")


def _answered(parts: DataFrame, build: Callable, search: Callable, point: Callable, bound: Callable, k: int, score_type: str, smallest: bool) -> DataFrame:
    """(row, query_id, vec_id, score) of parts (dim, bundle, shards, row, vec_id, v, tau) in order of bundle and row: rows of
    the table have no row number and come first."""
    score = pa.int64() if score_type == "long" else pa.float64()

    def best(held: dict, trees: dict, shards: list[list[int]], ids: np.ndarray, v: np.ndarray, tau: np.ndarray) -> list[list[tuple]]:
        """[(score, vec_id)] of the k best of each query in its shards of a bundle. A shard answers all its queries at once."""
        found: list[list[tuple]] = [[] for _ in shards]
        asked = defaultdict(list)
        for i, some in enumerate(shards):
            for shard in some:
                asked[shard].append(i)
        for shard, who in asked.items():
            if shard not in held:
                continue
            if shard not in trees:
                own, rows = np.concatenate([h[0] for h in held[shard]]), np.concatenate([h[1] for h in held[shard]])
                order = np.argsort(own, kind="stable")
                trees[shard] = build(own[order], rows[order])
            for i, more in zip(who, search(trees[shard], ids[who], v[who], k, tau[who]), strict=True):
                found[i] = sorted(found[i] + more, key=lambda x: (x[0] if smallest else -x[0], x[1]))[:k]
                if len(found[i]) == k:
                    tau[i] = min(tau[i], bound(point(v[i : i + 1])[0], found[i][-1][0]) * (1 + SLACK) + LEAST)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, trees = None, defaultdict(list), {}
        for b in batches:
            out: list[tuple] = []
            dims, bundles, is_row = b.column("dim").to_numpy(), b.column("bundle").to_numpy(), b.column("row").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(bundles) != 0) | (is_row[1:] != is_row[:-1])) + 1 if len(b) else []
            for start, end in zip([0, *cuts], [*cuts, len(b)], strict=True) if len(b) else []:
                part, bundle = b.slice(start, end - start), (int(dims[start]), int(bundles[start]))
                if bundle != key:
                    key, held, trees = bundle, defaultdict(list), {}
                v, ids = matrix(part.column("v"), bundle[0]), part.column("vec_id").to_numpy()
                if is_row[start]:
                    of = part.column("shards").flatten().to_numpy()
                    for shard in np.unique(of).tolist():
                        held[shard].append((ids[of == shard], v[of == shard]))
                else:
                    tau = np.array(part.column("tau").to_pylist(), float)
                    for row, i, got in zip(part.column("row").to_pylist(), ids.tolist(), best(held, trees, part.column("shards").to_pylist(), ids, v, tau), strict=True):
                        out += [(row, i, vec, s) for s, vec in got]
            cells = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cells[:3]], pa.array(cells[3], score)], names=["row", "query_id", "vec_id", "score"])

    return parts.mapInArrow(run, f"row long, query_id long, vec_id long, score {score_type}")


def search_shards(rows: DataFrame, n: int, every: int, point: Callable, query_point: Callable, bound: Callable, build: Callable, search: Callable, k: int, score_type: str,
                  smallest: bool, region_rows: int, shard_rows: int, factor: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of n rows for each query, ties to the smaller vec_id, rows of its own id left out.

    Queries are the rows whose id is divisible by every. point(matrix) and query_point(matrix) give the points between which
    the triangle inequality holds; bound(query point, score) is the distance of a row of that score. build(ids, matrix) makes
    a tree; search(tree, query_ids, vectors, k, taus) gives each query's (score, vec_id) of the shard's best k within its distance tau. There
    is a region for about region_rows rows, SAMPLE at most; shards hold about shard_rows rows. Only the sample and a few
    numbers for each region reach the driver."""
    spark = rows.sparkSession
    tables = Tables(spark, "search")
    drawn = rows.orderBy(F.xxhash64(F.lit(11), "vec_id", "v"), "vec_id").limit(SAMPLE).collect()
    by_dim = defaultdict(list)
    for r in drawn:
        by_dim[r["dim"]].append((r["vec_id"], r["v"]))
    sample = {dim: (np.array([i for i, _ in x], np.int64), point(np.array([v for _, v in x], np.float64).reshape(len(x), dim))) for dim, x in by_dim.items()}
    # Each dimension gets its share of the pivots, one at least.
    share = min(1.0, -(-n // region_rows) / max(1, len(drawn)))
    pivots = {dim: points[: max(1, round(share * len(points)))] for dim, (_, points) in sample.items()}
    dealt = tables.put(_dealt(rows, pivots, point).withColumn("row", F.monotonically_increasing_id()), "rows")
    of = defaultdict(list)
    for r in dealt.filter("region >= 0").groupBy("dim", "region").agg(F.count("*").alias("n"), F.min("d").alias("near"), F.max("d").alias("far")).orderBy("dim", "region").collect():
        of[r["dim"]].append((r["region"], r["near"], r["far"], -(-r["n"] // shard_rows), r["n"]))
    # As many bundles as there are partitions of a shuffle, and more where they would be too large.
    each_rows = -(-n // int(spark.conf.get("spark.sql.shuffle.partitions")))
    regions, many = {}, []
    for dim, x in of.items():
        numbers, near, far, subs, sizes = (np.array(c) for c in zip(*x, strict=True))
        first, each = np.array(_bundles(list(zip(sizes.tolist(), subs.tolist(), strict=True)), shard_rows, min(each_rows, CELLS // max(1, dim)))).T
        regions[dim] = (numbers, pivots[dim][numbers], near, far, subs, first, each)
        many += zip(itertools.repeat(dim), numbers.tolist(), subs.tolist(), first.tolist(), each.tolist())
    of_region = spark.createDataFrame(many, "dim int, region int, subs long, first int, each int")
    placed = dealt.join(F.broadcast(of_region), ["dim", "region"], "left").withColumn("sub", F.pmod(F.xxhash64("vec_id", "v"), F.coalesce("subs", F.lit(1))))
    bundle = F.coalesce((F.col("first") + F.floor(F.col("sub") / F.col("each"))).cast("int"), F.lit(-1))
    shards = F.array(F.shiftleft(F.col("region").cast("long"), 32) + F.col("sub"))
    null = lambda kind: F.lit(None).cast(kind)
    placed = placed.select("dim", bundle.alias("bundle"), shards.alias("shards"), null("long").alias("row"), "vec_id", "v", null("double").alias("tau"))
    queries = dealt.filter(F.pmod("vec_id", F.lit(every)) == 0)
    order = Window.partitionBy("row").orderBy(F.col("score").asc() if smallest else F.col("score").desc(), "vec_id")

    def answers(asked: DataFrame, home: bool) -> DataFrame:
        routed = _routed(asked, sample, regions, query_point, bound, k, factor, home).select(*placed.columns)
        parts = placed.union(routed).repartition("dim", "bundle").sortWithinPartitions("dim", "bundle", F.col("row").asc_nulls_first())
        return _answered(parts, build, search, query_point, bound, k, score_type, smallest)

    found = answers(queries.withColumn("kth", null("double")), True)
    if any(len(x) > 1 for x in of.values()):
        found = tables.put(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "home")
        kth = found.filter(F.col("rank") == k).select("row", F.col("score").cast("double").alias("kth"))
        found = found.drop("rank").union(answers(queries.join(kth, "row", "left"), False))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    out = tables.put(best, "best")
    tables.drop_all(out)
    return out
