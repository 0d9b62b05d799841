"""Nearest neighbours by vantage-point trees, one per shard.

A node holds a vantage row, the median distance of its rows from it, and an inner and an outer half. With tau the
distance of the k-th nearest found so far, a half is skipped if its lower bound by the triangle inequality times the
factor is over tau: factor 1 is exact, larger factors skip more and may miss neighbours.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import SLACK, distances, search_shards, usable


def exact(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distances with the squares summed in order, so that every engine that does so has the same last digit."""
    return np.sqrt(np.cumsum((rows - q) ** 2, axis=1)[:, -1]) if rows.size else np.zeros(len(rows))


def build(ids: np.ndarray, x: np.ndarray, leaf: int = 64) -> dict:
    """{"nodes": [(vantage, inner radius bounds, outer bounds, inner node, outer node) or (rows,)], ...}; node 0 is the root."""
    nodes: list = []
    rng = np.random.default_rng(len(ids))
    todo = [(np.arange(len(ids)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = at
        if len(rows) <= leaf:
            nodes.append([rows])
            continue
        # Of a few rows the vantage row is the one whose distances from a sample vary most.
        tries, sample = rng.choice(rows, 5, replace=False), rng.choice(rows, min(len(rows), 64), replace=False)
        spread = [distances(x[sample], x[t]).var() for t in tries]
        vantage = tries[int(np.argmax(spread))]
        rest = rows[rows != vantage]
        d = distances(x[rest], x[vantage])
        order = np.argsort(d, kind="stable")
        half = len(order) // 2
        nodes.append([vantage, (d[order[0]], d[order[half - 1]]), (d[order[half]], d[order[-1]]), 0, 0])
        todo += [(rest[order[half:]], at, 1), (rest[order[:half]], at, 0)]
    return {"ids": ids, "x": x, "nodes": nodes}


def search(tree: dict, query_id: int, q: np.ndarray, k: int, tau: float = np.inf, factor: float = 1.0) -> list[tuple[float, int]]:
    """[(distance, vec_id)] of the k nearest within the distance tau, ties to the smaller id."""
    x, ids, nodes = tree["x"], tree["ids"], tree["nodes"]
    best: list[tuple[float, int, int]] = []  # a heap whose first is the worst: (-distance, -id, row)

    def offer(d: float, row: int) -> None:
        one = (-d, -int(ids[row]), row)
        if -one[1] != query_id:
            if len(best) < k:
                heapq.heappush(best, one)
            elif one > best[0]:
                heapq.heapreplace(best, one)

    heap = [(0.0, 0)]
    while heap:
        bound, at = heapq.heappop(heap)
        if bound * factor * (1 - SLACK) > (min(tau, -best[0][0]) if len(best) == k else tau):
            break
        node = nodes[at]
        if len(node) == 1:
            d = distances(x[node[0]], q)
            if len(best) == k:
                near = np.flatnonzero(d <= -best[0][0])
                d, rows = d[near], node[0][near]
            else:
                rows = node[0]
            for e, row in zip(d.tolist(), rows.tolist(), strict=True):
                offer(e, row)
            continue
        d = float(distances(x[node[0]], q))
        offer(d, int(node[0]))
        for (low, high), child in ((node[1], node[3]), (node[2], node[4])):
            heapq.heappush(heap, (max(bound, low - d, d - high), child))
    rows = np.array([row for _, _, row in best], np.int64)
    return list(zip(exact(x[rows], q).tolist(), ids[rows].tolist(), strict=True))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 100, k: int = 10, factor: float = 1.0,
            leaf: int = 64, region_rows: int = 4096, shard_rows: int = 32768) -> DataFrame:
    """(query_id, rank, vec_id, score double): the k nearest by Euclidean distance, for the rows whose id is divisible by every.

    Vectors null, zero or with null or non-finite components take no part; vectors of another dimension are not compared.
    With fewer than k other rows all are returned; a row that is alone, or an empty table, gives none. Ties go to the
    smaller id, and each query row has a ranking of its own. factor 1 is exact, also in the choice of shards; every row is in
    the index of its shard."""
    rows = usable(vectors, id_col, vec_col, nonzero=True)
    same = lambda v: v
    return search_shards(rows, rows.count(), every, same, same, lambda _, score: score, lambda ids, v: build(ids, v, leaf), lambda t, ids, q, n, taus: [search(t, *one, n, tau, factor) for *one, tau in zip(ids.tolist(), q, taus.tolist(), strict=True)], k, "double", True,
                         region_rows, shard_rows, factor)
