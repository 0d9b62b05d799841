"""Substring deduplication by super-k-mer partitioning.

1. A pass over the texts cuts each document's windows of `window` words into runs that share a minimiser (the smallest
   hash of `inner` consecutive words, the leftmost of equals). Only (document, minimiser, start, length) leaves the task.
2. Windows can be equal only if their minimisers are, so runs whose minimiser occurs once in the corpus are done.
3. The other runs travel as one packed string (super-k-mer) to their minimiser's bucket. Equal packed strings become one
   with a count before the shuffle. Runs of a minimiser in more than `hot` places travel as single windows, each to a
   bucket of its own, so no bucket grows with the corpus.
4. A bucket sorts its windows and counts them exactly; runs with a repeated window go back as a bit mask to their
   documents, which drop the words that repeated windows cover.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Tables, renamed
from .words import hashes, minimisers, sequences, words


def runs(ws: list[bytes], window: int, inner: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows) of each run of windows with one minimiser place."""
    m = sequences(hashes(ws), inner) if len(ws) >= window else np.zeros(0, np.uint64)
    at = minimisers(m, window - inner + 1)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    return m[at[first]].view(np.int64), first, np.diff(np.append(first, len(at)))


def _runs(docs: DataFrame, window: int, inner: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [runs(words(t.as_py()), window, inner) for t in b.column("text")]
            of = np.repeat(np.arange(b.num_rows), [len(f[0]) for f in found])
            join = lambda k: np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(of)), b.column("th").take(pa.array(of)), pa.array(join(0)), pa.array(join(1).astype(np.int32)), pa.array(join(2).astype(np.int32))],
                                             names=["doc_id", "th", "mer", "first", "n"])

    return docs.mapInArrow(run, "doc_id long, th long, mer long, first int, n int")


def _packed(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, th, bucket, packed, firsts, n) of (doc_id, th, text, runs array<struct<first,n,mer,hot>>)."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("bucket", pa.int64()), ("packed", pa.binary()), ("firsts", pa.list_(pa.int32())), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for doc, th, text, rs in zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist(), b.column("text"), b.column("runs"), strict=True):
                ws, out = words(text.as_py()), {}
                for r in rs.as_py():
                    first, n = r["first"], r["n"]
                    if r["hot"]:
                        for i in range(first, first + n):
                            p = b" ".join(ws[i : i + window])
                            h = xxh64_intdigest(p)
                            out.setdefault((h - (1 << 64) if h >> 63 else h, p, 1), []).append(i)
                    else:
                        out.setdefault((r["mer"], b" ".join(ws[first : first + n + window - 1]), n), []).append(first)
                for (bucket, p, n), firsts in out.items():
                    rows.append((doc, th, bucket, p, firsts, n))
                    size += len(p) + 4 * len(firsts)
                if size > 1 << 22:
                    yield flush()
                    rows, size = [], 0
        if rows:
            yield flush()

    return docs.mapInArrow(run, "doc_id long, th long, bucket long, packed binary, firsts array<int>, n int")


def count_bucket(rows: list[tuple[bytes, int, int]], window: int) -> list[int]:
    """For each (packed, windows, times) of a bucket, the bits of its windows that start twice or more in the bucket."""
    seen: Counter = Counter()
    each = []
    for packed, n, times in rows:
        ws = packed.split(b" ")
        mine = [b" ".join(ws[i : i + window]) for i in range(n)]
        each.append(mine)
        for w in mine:
            seen[w] += times
    return [sum(1 << i for i, w in enumerate(mine) if seen[w] > 1) for mine in each]


def _repeated(strings: DataFrame, window: int) -> DataFrame:
    """(bucket, packed, mask) of (bucket, packed, n, times), rows of a bucket together in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int]] = []
        bucket = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held and (len(held) > 1 or held[0][1] > 1 or held[0][2] > 1):
                hit = [(p[0], m) for p, m in zip(held, count_bucket(held, window), strict=True) if m]
                if hit:
                    yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(hit), pa.int64()), pa.array([p for p, _ in hit], pa.binary()), pa.array([m for _, m in hit], pa.int64())], names=["bucket", "packed", "mask"])

        for b in batches:
            for k, p, n, t in zip(*[b.column(c).to_pylist() for c in ("bucket", "packed", "n", "times")], strict=True):
                if k != bucket:
                    yield from flush()
                    held, bucket = [], k
                held.append((p, n, t))
        yield from flush()

    return strings.mapInArrow(run, "bucket long, packed binary, mask long")


def _kept(docs: DataFrame, window: int, text: bool) -> DataFrame:
    """The result of (doc_id, text, hits array<struct<firsts,mask>>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, sha, texts = [], [], [], []
            for t, hits in zip(b.column("text"), b.column("hits").to_pylist(), strict=True):
                ws = words(t.as_py())
                if hits:
                    edge = np.zeros(len(ws) + 1, np.int64)
                    for h in hits:
                        bits = [i for i in range(63) if h["mask"] >> i & 1]
                        for first in h["firsts"]:
                            for i in bits:
                                edge[first + i] += 1
                                edge[first + i + window] -= 1
                    cover = np.cumsum(edge[:-1]) > 0
                    kept = [w for w, c in zip(ws, cover.tolist(), strict=True) if not c]
                else:
                    kept = ws
                joined = b" ".join(kept)
                total.append(len(ws)), removed.append(len(ws) - len(kept)), sha.append(hashlib.sha256(joined).hexdigest())
                texts.append(joined.decode("utf-8", "surrogatepass") if text else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, inner: int = 6, hot: int = 256, keep_text: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank), kept_text if asked for.

    A word is removed if a window of `window` words covers it whose words also start anywhere else, in its document or
    another, with windows judged on the input. Null texts have no words; texts of fewer words have no window. Rows
    equal in id and text repeat each other's windows; an id may be null. An empty table gives no rows. Runs have at most
    window - inner + 1 windows, which must be under 63."""
    d = renamed(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"))
    tables = Tables(docs.sparkSession, "windows")
    found = tables.put(_runs(d, window, inner), "runs")
    # Written, so that the join deals both sides anew and Spark can split a hot minimiser's partition.
    often = tables.put(found.groupBy("mer").agg(F.count("*").alias("places")).filter("places > 1").select("mer", (F.col("places") > hot).alias("hot")), "often")
    some = found.join(often, "mer").groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "n", "mer", "hot")).alias("runs"))
    some = some.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "runs")
    packed = tables.put(_packed(d.join(some, d["doc_id"].eqNullSafe(some["_id"]) & (d["th"] == some["_th"])).select("doc_id", "th", "text", "runs"), window), "packed")
    tables.drop(found, often)

    strings = packed.groupBy("bucket", "packed", "n").agg(F.sum(F.size("firsts")).cast("int").alias("times"))
    twice = _repeated(strings.repartition("bucket").sortWithinPartitions("bucket", "packed"), window)
    twice = tables.put(twice.select("bucket", F.md5("packed").alias("key"), "mask"), "repeated")
    hits = packed.select("doc_id", "th", "bucket", F.md5("packed").alias("key"), "firsts").join(twice, ["bucket", "key"])
    hits = hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct("firsts", "mask")).alias("hits"))
    hits = tables.put(hits.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "hits"), "hits")
    tables.drop(packed, twice)
    both = d.join(hits, d["doc_id"].eqNullSafe(hits["_id"]) & (d["th"] == hits["_th"]), "left").select("doc_id", "text", "hits")
    out = _kept(both, window, keep_text)
    return out if keep_text else out.drop("kept_text")
