"""Repeated passages by sparse suffix arrays.

1. Of each window of `sparse` sequences of `inner` words, the place of the smallest hash is retained: equal passages
   retain equal places, whatever stands around them. A suffix starts at each retained place.
2. Suffixes whose first `head` words occur once in the corpus match nothing long enough and are done.
3. The others meet within their head. Two suffixes that agree on `least` words in all, right and left of their places, mark
   that passage in both documents. Up to reach + 1 places are compared in all pairs. More are sorted by their words to the
   right and by those to the left: places that agree in n words are neighbours there, so the classes of equal words of each
   length are known, and two places share a window if both their classes are equal. No pair is left out.

A passage of `least` words retains a place among its first `sparse` sequences, after which at least `head` of its words
follow, so sparse + head <= least + 1 must hold. Suffixes carry a bounded context: the retained places within a long
passage mark it piece by piece. Texts that are equal as a whole are taken once and counted.

Heads in more than `hot` places are not compared in one task. There each place gives the windows of `least` words around
it, at most head + 1, that no earlier place gives: a run. A run that occurs twice marks its words; the windows of one run of
each kind, weighed by the places of that kind, are counted, and those that occur twice mark the words of runs that occur once.
So copies of a passage cost a row each, not one for each of its windows. Runs and windows are told by two 64-bit hashes and
counted with partial sums. Texts are equal if two 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Tables, renamed
from .words import hashes, minimisers, mixed, sequences, words


def _suffixes(docs: DataFrame, inner: int, sparse: int, head: int) -> DataFrame:
    """(doc_id, th, n_words, head, at) for each retained place of (doc_id, th, text); at -1 carries only the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, places, of = [], [], []
            for k, t in enumerate(b.column("text")):
                h = hashes(words(t.as_py()))
                if len(h) < head:
                    continue
                at = np.unique(minimisers(sequences(h, inner), sparse))
                at = at[at + head <= len(h)]
                heads.append(sequences(h, head)[at]), places.append(at), of.append(np.full(len(at), k))
            cat = lambda x, dtype: np.concatenate(x).astype(dtype) if x else np.zeros(0, dtype)
            of = pa.array(cat(of, np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(of), b.column("th").take(of), pa.array(cat(heads, np.uint64).view(np.int64)), pa.array(cat(places, np.int32))], names=["doc_id", "th", "head", "at"])

    return docs.mapInArrow(run, "doc_id long, th long, head long, at int")


def _runs(places: list[int], n_words: int, least: int, left: int) -> list[tuple[int, int]]:
    """[(first, end)] of the first words of the windows that hot places give, each window once: a run ends at its place and
    begins after the place before."""
    out, before = [], -1
    for at in sorted(places):
        first, end = max(at - left, before + 1), min(at, n_words - least) + 1
        if first < end:
            out.append((first, end))
        before = at
    return out


def _contexts(docs: DataFrame, least: int, head: int) -> DataFrame:
    """(head, hot, wide, suffix, prefix, windows, doc_id, th, at): up to 2 * head words from each place and up to least - head
    before it, nearest first; for a hot place instead its run of windows at its first word: head is the hash of all words of
    the run and wide a second one, windows has two hashes of each."""
    window = pa.struct([("head", pa.int64()), ("wide", pa.int64())])
    schema = pa.schema([("head", pa.int64()), ("hot", pa.bool_()), ("wide", pa.int64()), ("suffix", pa.binary()), ("prefix", pa.binary()), ("windows", pa.list_(window)), ("doc_id", pa.int64()), ("th", pa.int64()), ("at", pa.int32())])
    left, right = least - head, 2 * head

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for doc, th, text, places in zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist(), b.column("text"), b.column("places").to_pylist(), strict=True):
                ws = words(text.as_py())
                runs = _runs([p["at"] for p in places if p["hot"]], len(ws), least, left)
                if runs:
                    h = hashes(ws)
                    windows, second = (sequences(x, least).view(np.int64).tolist() for x in (h, mixed(h)))
                    whole = [b" ".join(ws[first : end - 1 + least]) for first, end in runs]
                    one, two = (np.array([xxh64_intdigest(x, seed) for x in whole], np.uint64).view(np.int64).tolist() for seed in (0, 1))
                    rows += [(a, True, b, None, None, list(zip(windows[first:end], second[first:end], strict=True)), doc, th, first) for a, b, (first, end) in zip(one, two, runs, strict=True)]
                for p in places:
                    if not p["hot"]:
                        at = p["at"]
                        rows.append((p["head"], False, None, b" ".join(ws[at : at + right]), b" ".join(reversed(ws[max(0, at - left) : at])), None, doc, th, at))
                if len(rows) > 4096:
                    yield flush()
                    rows = []
        if rows:
            yield flush()

    return docs.mapInArrow(run, "head long, hot boolean, wide long, suffix binary, prefix binary, windows array<struct<head:long,wide:long>>, doc_id long, th long, at int")


def agreed(a: list[bytes], b: list[bytes]) -> int:
    """Leading words in common."""
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def _classes(keys: list[list[bytes]], longest: int) -> np.ndarray:
    """classes[n, i]: equal for two lists if and only if both have n words at least and their first n agree, for n up to longest."""
    order = sorted(range(len(keys)), key=keys.__getitem__)
    # In order of their words, lists that agree in n words are next to each other.
    same = np.array([-1, *[agreed(keys[i], keys[j]) for i, j in zip(order, order[1:], strict=False)]])
    out = np.empty((longest + 1, len(keys)), np.int64)
    out[:, order] = np.cumsum(same < np.arange(longest + 1)[:, None], axis=1)
    return out


def _group(rows: list[tuple], least: int, left: int, reach: int) -> list[tuple]:
    """(doc_id, th, first, last) of the passages that the places (suffix, prefix, doc_id, th, at) of one head share."""
    out: list[tuple] = []
    if len(rows) <= reach + 1:
        for i, x in enumerate(rows):
            for y in rows[:i]:
                after, before = agreed(x[0], y[0]), agreed(x[1], y[1])
                if after + before >= least:
                    out += [(z[2], z[3], z[4] - before, z[4] + after) for z in (x, y)]
        return list(dict.fromkeys(out))
    # The window with k words before its place is equal where k words before and least - k words from it are.
    before, after = _classes([r[1] for r in rows], left), _classes([r[0] for r in rows], least)
    windows = before * (len(rows) + 1) + after[least - np.arange(left + 1)]
    order = np.argsort(windows, axis=1, kind="stable")
    ranked = np.take_along_axis(windows, order, 1)
    equal = np.zeros((left + 1, len(rows) + 1), bool)
    equal[:, 1:-1] = ranked[:, 1:] == ranked[:, :-1]
    twice = np.zeros((left + 3, len(rows)), np.int8)
    np.put_along_axis(twice[1:-1], order, (equal[:, 1:] | equal[:, :-1]).astype(np.int8), 1)
    # Runs of k give one passage each.
    step = np.diff(twice, axis=0).T
    for (i, k), (_, end) in zip(np.argwhere(step == 1).tolist(), np.argwhere(step == -1).tolist(), strict=True):
        _, _, doc, th, at = rows[i]
        out.append((doc, th, at - end + 1, at - k + least))
    return out


def _shared(suffixes: DataFrame, least: int, left: int, reach: int) -> DataFrame:
    """(doc_id, th, first, last) of suffixes in order of their head: the passages that places of one head share, all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())], names=["doc_id", "th", "first", "last"])

        for b in batches:
            for head, suffix, prefix, doc, th, at in zip(*[b.column(c).to_pylist() for c in ("head", "suffix", "prefix", "doc_id", "th", "at")], strict=True):
                if head != key:
                    out += _group(rows, least, left, reach)
                    key, rows = head, []
                rows.append((suffix.split(b" "), prefix.split(b" ") if prefix else [], doc, th, at))
            yield flush()
            out = []
        out += _group(rows, least, left, reach)
        yield flush()

    return suffixes.mapInArrow(run, "doc_id long, th long, first int, last int")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50, inner: int = 8, sparse: int = 24, head: int = 25,
                      reach: int = 8, hot: int = 1024) -> DataFrame:
    """One row per row of docs that holds a repeated passage: doc_id, n_passages, n_repeated (words), spans (first:end of
    words, end exclusive, comma-joined, disjoint and in order).

    A passage is repeated if at least `least` words in a row also stand elsewhere, in another document or in the same.
    Null texts and texts of fewer words hold none. Rows whose texts are equal repeat each other as a whole. An empty table
    gives no rows. A null id is carried as null; rows of one id are judged by their own texts."""
    d = renamed(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"), F.xxhash64(F.lit(1), "text").alias("th2"))
    d = d.filter("text is not null")
    n_words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    # One row for each text; of equal texts the smallest id stands for all. From here on (th, that id) names a text.
    tables = Tables(docs.sparkSession, "suffix")
    same = tables.put(d.groupBy("th", "th2").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("rep"), F.count("*").alias("copies")), "texts")
    kept = d.withColumn("_rep", F.coalesce("doc_id", F.lit(-(2**63)))).select("_rep", "text", "th")
    every = tables.put(_suffixes(kept.withColumnRenamed("_rep", "doc_id"), inner, sparse, head), "places")
    alone = same.select(F.col("th"), F.col("rep").alias("doc_id"))
    found = every.join(alone, ["th", "doc_id"], "left_semi").distinct()
    # Written, so that the join deals both sides anew and Spark can split a hot head's partition.
    often = tables.put(found.groupBy("head").agg(F.count("*").alias("places")).filter("places > 1"), "often")
    some = found.join(often, "head").groupBy("th", "doc_id").agg(F.collect_list(F.struct("head", (F.col("places") > hot).alias("hot"), "at")).alias("places"))
    texts = kept.select(F.col("_rep").alias("doc_id"), "th", "text").join(some, ["th", "doc_id"])
    contexts = tables.put(_contexts(texts.select("doc_id", "th", "text", "places"), least, head), "contexts")
    tables.drop(every, often)
    ordered = contexts.filter("not hot").repartition("head").sortWithinPartitions("head")
    runs = contexts.filter("hot").select("head", "wide", "doc_id", "th", "at", "windows")
    kinds = tables.put(runs.groupBy("head", "wide").agg(F.count("*").alias("n"), F.min(F.struct("th", "doc_id", "at", "windows")).alias("one")), "kinds")
    both = ["head", "wide"]
    wholes = runs.withColumn("last", F.col("at") + F.size("windows") - 1 + least).drop("windows").join(kinds.filter("n > 1").select(*both), both, "left_semi")
    windows = kinds.select("n", "one.th", "one.doc_id", "one.at", F.posexplode("one.windows").alias("k", "w")).select("n", "th", "doc_id", (F.col("at") + F.col("k")).alias("at"), "w.head", "w.wide")
    twice = windows.groupBy(*both).agg(F.sum("n").alias("n")).filter("n > 1").select(*both)
    single = windows.filter("n = 1").join(twice, both, "left_semi").withColumn("last", F.col("at") + least)
    marked = [x.select("doc_id", "th", F.col("at").alias("first"), "last") for x in (wholes, single)]
    spans = tables.put(_shared(ordered, least, least - head, reach).union(marked[0]).union(marked[1]).distinct(), "spans")
    tables.drop(contexts, kinds)
    # Spans of a text: in order, joined where they touch. All steps are by text, so they share one shuffle.
    order = Window.partitionBy("th", "doc_id").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    isle = spans.withColumn("new", F.when(F.col("first") <= reached, 0).otherwise(1))
    isle = isle.withColumn("isle", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("th", "doc_id", "isle").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    per = isle.groupBy("th", "doc_id").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("passages"))
    per = same.withColumnRenamed("rep", "doc_id").join(per, ["th", "doc_id"], "left").filter((F.col("copies") > 1) | F.col("passages").isNotNull())
    per = per.select(F.col("th").alias("_th"), F.col("th2").alias("_th2"), "copies", "passages")
    out = d.join(per, (d["th"] == per["_th"]) & (d["th2"] == per["_th2"])).withColumn("_n", n_words)
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("_n").cast("int").alias("last")))
    out = out.withColumn("_p", F.when((F.col("copies") > 1) & (F.col("_n") >= least), whole).otherwise(F.col("passages"))).filter("_p is not null")
    return out.select("doc_id", F.size("_p").cast("long").alias("n_passages"), F.aggregate("_p", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"]).alias("n_repeated"),
                      F.array_join(F.transform("_p", lambda s: F.concat_ws(":", s["first"], s["last"])), ",").alias("spans"))
