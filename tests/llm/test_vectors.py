"""Vector searches against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from captrail.llm import mtree, vectors, vptree

from . import brute


def data(spark, n=400, dim=8, seed=1):
    x = np.random.default_rng(seed).normal(0, 1, (n, dim)).round(1)
    return [(i, v.tolist()) for i, v in enumerate(x)]


def ints(v):
    return [int(np.floor(256 * x)) for x in v]


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_top_k(spark):
    rows = data(spark) + [(1000 + i, v) for i, v in data(spark, 40)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in d.collect()]
    want = brute.nearest(rows, 50, 5, lambda a, b: sum(x * y for x, y in zip(ints(a), ints(b), strict=True)), False)
    for region, shard in ((30, 20), (60, 8192), (8192, 100), (8192, 8192)):
        assert found(mtree.top_k(d, region_rows=region, shard_rows=shard, page=8)) == want


@pytest.mark.parametrize("cells", [64, 1 << 20])
def test_top_k_answers_queries_together(monkeypatch, cells):
    """A tree answers many queries in one call, as all pairs do, with equal rows and loose and tight bounds among them."""
    monkeypatch.setattr(mtree, "CELLS", cells)
    rng = np.random.default_rng(9)
    v = np.concatenate((rng.normal(0, 1, (700, 6)).round(2), np.tile(rng.normal(0, 1, 6).round(2), (90, 1))))
    ids = np.arange(len(v)) * 3
    tree = mtree.build(ids, v, page=12)
    own = np.arange(0, len(v), 4)
    ints = np.floor(256 * v)
    want = []
    for i in own:
        s = ints @ ints[i]
        want.append([(int(s[j]), int(ids[j])) for j in sorted(range(len(v)), key=lambda j: (-s[j], ids[j])) if j != i][:5])
    reach = np.array([np.sqrt(ints[i] @ ints[i] + tree["most"] - 2 * w[-1][0]) for i, w in zip(own, want, strict=True)])
    for taus in (np.full(len(own), np.inf), np.where(np.arange(len(own)) % 2, np.inf, reach)):
        assert mtree.search(tree, ids[own], v[own], 5, taus) == want


def test_nearest(spark):
    rows = data(spark) + [(1000 + i, v) for i, v in data(spark, 40)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute.nearest(rows, 100, 10, lambda a, b: float(np.sqrt(np.cumsum((np.array(a) - np.array(b)) ** 2)[-1])), True)
    for region, shard in ((30, 20), (100, 8192), (8192, 8192)):
        assert found(vptree.nearest(d, region_rows=region, shard_rows=shard, leaf=16)) == want
    some = found(vptree.nearest(d, factor=1.5, leaf=8, region_rows=60))
    hits = sum(len({i for i, _ in some[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hits >= 0.9


def test_regions_are_skipped(spark, monkeypatch):
    """Of vectors about twelve centres a query sees the shards near it only, and the result is that of all pairs."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 30, (12, 6))
    rows = [(i, (centres[i % 12] + rng.normal(0, 0.1, 6)).tolist()) for i in range(1200)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = routes(monkeypatch)
    got = found(vptree.nearest(d, every=10, region_rows=25))
    assert got == brute.nearest(rows, 10, 10, lambda a, b: float(np.sqrt(np.cumsum((np.array(a) - np.array(b)) ** 2)[-1])), True)
    (home, home_shards), (_, shards) = seen
    assert home == home_shards == 120 and home_shards + shards < 120 * 48 / 4


def routes(monkeypatch):
    """Collects, for each round of a search, (rows sent to bundles, shards that they name)."""
    seen, routed = [], vectors._routed

    def counted(*args):
        out = routed(*args)
        seen.append(tuple(x or 0 for x in out.agg(F.count("*"), F.sum(F.size("shards"))).first()))
        return out

    monkeypatch.setattr(vectors, "_routed", counted)
    return seen


def test_the_second_round_has_the_tighter_bound(spark, monkeypatch):
    """Of rows on a curve the sample of 64 tells little of the 10 nearest; the home region tells nearly all. Shards travel
    in bundles."""
    t = np.linspace(0, 40, 4000)
    rows = [(i, [float(x), float(np.sin(x)), float(np.cos(x))]) for i, x in enumerate(t)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    monkeypatch.setattr(vectors, "SAMPLE", 64)
    seen = routes(monkeypatch)
    want = brute.nearest(rows, 100, 10, lambda a, b: float(np.sqrt(np.cumsum((np.array(a) - np.array(b)) ** 2)[-1])), True)
    assert found(vptree.nearest(d, region_rows=60)) == want
    assert seen[0] == (40, 40) and seen[1][1] < 40 * 4
    seen.clear()
    # Where nothing can be skipped (a bound that is no bound) all shards are seen, but few rows travel.
    monkeypatch.setattr(vectors, "LEAST", 1e9)
    assert found(vptree.nearest(d, region_rows=60, shard_rows=20)) == want
    assert seen[1][1] > 9000 and seen[1][0] < 9000 / 5


def test_bundles():
    assert vectors._bundles([(10, 1), (10, 1), (25, 2), (100, 5), (5, 1)], 20, 40) == [(0, 1), (0, 1), (1, 2), (2, 2), (5, 1)]
    assert vectors._bundles([(10, 1), (10, 1)], 20, 0) == [(0, 1), (1, 1)]
    assert vectors._bundles([], 20, 40) == []


def test_inner_products_stay_exact(spark):
    d = spark.createDataFrame([(0, [1e7]), (1, [2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        mtree.top_k(d, scale=1e3)


def test_repeated_query_ids(spark):
    """Each query row of an id has a ranking of its own; rows of its id are no candidates."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), *[(i, [float(i), 1.0]) for i in range(1, 8)]]
    got = mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 1, 7), (0, 2, 2), (0, 2, 6), (0, 3, 3), (0, 3, 5)]


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.0, 0.0]), (100, [1.0, float("nan")]), (101, None), (102, [1.0, None]), (103, [float("inf"), 0.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [1.0]), (None, [1.0, 1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as v", "2 as dim", "3 as shard")
    assert found(mtree.top_k(d)) == {0: [(3, 327680), (3, 327680), (50, 0)], 50: [(0, 0), (3, 0), (3, 0)]}
    assert found(vptree.nearest(d)) == {0: [(3, 0.0), (3, 0.0)]}
    for f in (mtree.top_k, vptree.nearest):
        assert f(d.limit(0)).count() == 0 and f(d.filter(F.col("vec_id") == 0)).count() == 0
