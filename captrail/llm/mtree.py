"""Exact top-k inner products by M-trees that are searched by many queries at once.

Vectors become integers floor(scale * x). One more coordinate, sqrt(M - |x|^2) with M the table's largest squared norm,
gives all rows the same norm, so the largest inner product is the smallest Euclidean distance and the triangle inequality
holds. A tree has pages of rows under a routing row, and pages of routing rows above them; each page keeps its covering
radius and each entry its distance from the routing row (parent distance), by which distances need not be computed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import search_shards, squares, usable

#: Slack for rounding in distances of integer vectors: bounds are loosened by it, scores themselves are exact integers.
SLACK = 1e-6
#: Scores of queries and rows of a page that are held at a time.
CELLS = 1 << 20


def _pages(x: np.ndarray, size: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(routing rows, the routing row of each row): a sample of rows, each row with its nearest."""
    pivots = np.sort(rng.choice(len(x), max(1, len(x) // size), replace=False))
    d = (x * x).sum(1)[:, None] - 2 * (x @ x[pivots].T) + (x[pivots] ** 2).sum(1)[None, :]
    return pivots, d.argmin(axis=1)


def points(v: np.ndarray, scale: float, most: float) -> np.ndarray:
    """Integer vectors with the coordinate that gives all the squared norm most."""
    ints = np.floor(scale * v)
    return np.hstack((ints, np.sqrt(np.maximum(0.0, most - (ints * ints).sum(axis=1)))[:, None]))


def query_points(v: np.ndarray, scale: float) -> np.ndarray:
    return np.hstack((np.floor(scale * v), np.zeros((len(v), 1))))


def build(ids: np.ndarray, v: np.ndarray, scale: float = 256.0, page: int = 48, most: float | None = None) -> dict:
    ints = np.floor(scale * v)
    most = float((ints * ints).sum(axis=1).max()) if most is None else most
    x = points(v, scale, most)
    rng = np.random.default_rng(len(ids))

    def split(points: np.ndarray) -> list[dict]:
        pivots, of = _pages(x[points], page, rng)
        out = []
        for i, p in enumerate(pivots):
            inside = points[of == i]
            if len(inside):
                parent = np.sqrt(((x[inside] - x[points[p]]) ** 2).sum(axis=1))
                order = np.argsort(parent)
                out.append({"at": points[p], "rows": inside[order], "parent": parent[order], "radius": parent.max()})
        return out

    leaves = split(np.arange(len(ids)))
    routing = np.array([leaf["at"] for leaf in leaves])
    tops = []
    pivots, of = _pages(x[routing], page, rng)
    for i, p in enumerate(pivots):
        inside = np.flatnonzero(of == i)
        if len(inside):
            parent = np.sqrt(((x[routing[inside]] - x[routing[p]]) ** 2).sum(axis=1))
            radii = np.array([leaves[j]["radius"] for j in inside])
            tops.append({"at": routing[p], "pages": inside, "parent": parent, "radii": radii, "radius": (parent + radii).max()})
    return {"ids": ids, "x": x, "ints": ints, "leaves": leaves, "tops": tops, "top_at": np.array([t["at"] for t in tops]), "most": most, "scale": scale}


def search(tree: dict, own_ids: np.ndarray, vectors: np.ndarray, k: int, taus: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each query [(score, vec_id)] of its k largest scores within its distance tau, ties to the smaller id. A page is opened
    for the queries whose bounds may still tie, for all of them at once; each query's nearest page comes first."""
    x, ids, leaves, tops = tree["x"], tree["ids"], tree["leaves"], tree["tops"]
    own = np.floor(tree["scale"] * vectors)
    q = np.hstack((own, np.zeros((len(own), 1))))
    q2 = (own * own).sum(axis=1)
    scores, names = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
    reach = np.asarray(taus, float) + SLACK  # the distance at which a row ties with the worst of the k: |q|^2 + M - 2 score
    # The square of a distance is a difference of larger numbers: what rounding may take from it is added to the reach.
    wide = lambda rows: reach[rows] + np.sqrt(4e-15 * q.shape[1] * (q2[rows] + tree["most"]))

    def between(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, squares(q[rows], x[at])))

    def opened(leaf: int, who: np.ndarray, d: np.ndarray) -> None:
        page = leaves[leaf]
        most = max(1, CELLS // len(page["rows"]))
        if len(who) > most:  # a page of many equal rows
            for at in range(0, len(who), most):
                opened(leaf, who[at : at + most], d[at : at + most])
            return
        r = wide(who)
        near = page["parent"][(page["parent"] >= (d - r).min()) & (page["parent"] <= (d + r).max())] if np.isfinite(r).all() else page["parent"]
        first = int(np.searchsorted(page["parent"], near[0])) if len(near) else 0
        rows = page["rows"][first : first + len(near)]
        s = own[who] @ tree["ints"][rows].T
        s[ids[rows][None, :] == own_ids[who][:, None]] = -np.inf
        better = np.flatnonzero((s >= scores[who, -1:]).any(axis=1) & (s > -np.inf).any(axis=1))
        if not len(better):
            return
        who, s = who[better], np.hstack((scores[who[better]], s[better]))
        n = np.hstack((names[who], np.broadcast_to(ids[rows], (len(who), len(rows)))))
        order = np.lexsort((n, -s), axis=1)[:, :k]
        scores[who], names[who] = np.take_along_axis(s, order, 1), np.take_along_axis(n, order, 1)
        full = who[scores[who, -1] > -np.inf]
        reach[full] = np.minimum(reach[full], np.sqrt(np.maximum(0.0, q2[full] + tree["most"] - 2 * scores[full, -1])) + SLACK)

    every = np.arange(len(q))
    d_top = between(every, tree["top_at"])
    low_top = np.maximum(0.0, d_top - np.array([t["radius"] for t in tops])[None, :])
    done = np.full(len(q), -1)  # the page that each query has seen first: one below its nearest routing row
    nearest = low_top.argmin(axis=1)
    for first in (True, False):
        for t in np.argsort(low_top.min(axis=0), kind="stable").tolist():
            who = every[(nearest == t) if first else (low_top[:, t] <= wide(every))]
            if not len(who):
                continue
            top = tops[t]
            # The pages' bounds by the parent distances come before any distance from their own routing rows.
            d = d_top[who, t]
            pages = np.flatnonzero((np.abs(d[:, None] - top["parent"]) - top["radii"] <= wide(who)[:, None]).any(axis=0))
            if not len(pages):
                continue
            e = between(who, np.array([leaves[j]["at"] for j in top["pages"][pages]], np.int64))
            low = np.maximum(0.0, e - top["radii"][pages])
            best = low.argmin(axis=1)
            for c in np.argsort(low.min(axis=0), kind="stable").tolist():
                leaf = int(top["pages"][pages[c]])
                go = np.flatnonzero((best == c) if first else (low[:, c] <= wide(who)) & (done[who] != leaf))
                if len(go):
                    opened(leaf, who[go], e[go, c])
                    if first:
                        done[who[go]] = leaf
    return [[(int(s), int(n)) for s, n in zip(a, b, strict=True) if s > -np.inf] for a, b in zip(scores.tolist(), names.tolist(), strict=True)]


def top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5, scale: float = 256.0,
          page: int = 48, region_rows: int = 4096, shard_rows: int = 32768) -> DataFrame:
    """(query_id, rank, vec_id, score long): exact, for the rows whose id is divisible by every.

    Vectors null or with null or non-finite components take no part; vectors of another dimension are not compared.
    With fewer than k other rows all are returned; a row that is alone, or an empty table, gives none. Repeated ids:
    each row of another id is a candidate of its own, and each query row has a ranking of its own. Scores are exact: where the
    largest squared norm of the integer vectors reaches 2^53, a ValueError is raised."""
    rows = usable(vectors, id_col, vec_col)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.floor(F.lit(scale) * x).cast("double") * F.floor(F.lit(scale) * x).cast("double"))
    n, most = rows.agg(F.count("*"), F.coalesce(F.max(norm), F.lit(0.0))).first()
    if most >= 2**53:
        raise ValueError("inner products of these vectors are not exact in double precision: use a smaller scale")
    # What rounding may take from a small difference of large squares is added.
    bound = lambda q, score: np.sqrt(max(0.0, float(q @ q) + most - 2 * score) + 1e-15 * most)
    return search_shards(rows, n, every, lambda v: points(v, scale, most), lambda v: query_points(v, scale), bound, lambda ids, v: build(ids, v, scale, page, most), search, k, "long", False,
                         region_rows, shard_rows)
