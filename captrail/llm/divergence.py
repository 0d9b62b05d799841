"""How the sources of a language differ in their words: an audit by sketch-prefiltered counting.

1. Each task keeps a count-min sketch of document frequencies: a document adds one to the cells of each of its terms, in ROWS
   rows of cells. Sketches are merged by adding. A cell never holds less than any of its terms' documents, so a term with
   a cell below the wanted frequency cannot reach it.
2. Terms that the merged sketch rules out are discarded within tasks, before anything is shuffled. What survives is counted
   exactly by language, source and term, and terms that only collisions let through go by their exact document frequency.
3. Smoothed shares are integers, from exact decimals. Two sources of a language meet only under terms that both have. What the
   terms of one source alone add depends on their count only, so it comes from a table of how many terms have which count.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Tables, renamed
from .words import mixed

#: Bytes outside terms become blanks, A-Z become small; shares are in billionths, smoothed by five.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))
SCALE, SMOOTH = 1_000_000_000, 5
#: Rows of the sketch; bounds of a row's cells: its bitmap, which all tasks hold, has 16 MB at most.
ROWS, LEAST_CELLS, MOST_CELLS = 2, 1 << 20, 1 << 27
#: Terms that a task holds before it hands on their counts, and rows of a batch that leaves it.
HELD, BATCH = 300_000, 50_000
_BITS = 32768  # Spark's bitmaps


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and non-ASCII characters as UTF-8, A-Z in lower case."""
    return text.encode("utf-8").translate(LETTERS).split() if text else []


def cells_of(lang: bytes, found: list[bytes], cells: int) -> np.ndarray:
    """(ROWS, n): each term's cell in each row, numbered over all rows."""
    seed = xxh64_intdigest(lang) & 0xFFFFFFFF
    h = np.fromiter((xxh64_intdigest(t, seed) for t in found), np.uint64, len(found))
    return np.stack([(mixed(h ^ np.uint64(r)) % np.uint64(cells)).astype(np.int64) + r * cells for r in range(ROWS)])


def _cells(docs: DataFrame) -> int:
    """Cells of a row: 64 a document, a power of two."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (64 * docs.count()).bit_length()))


def _sketch(docs: DataFrame, cells: int, least: int) -> DataFrame:
    """(bucket, bits): the cells that hold least documents or more, as Spark's bitmaps, buckets from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                places = cells_of(lang, list(counts), cells).ravel()
                at, which = np.unique(places, return_inverse=True)
                n = np.bincount(which, weights=np.tile(np.fromiter(counts.values(), np.int64, len(counts)), ROWS)).astype(np.int64)
                for k in range(0, len(at), BATCH):
                    yield pa.RecordBatch.from_arrays([pa.array(at[k : k + BATCH]), pa.array(n[k : k + BATCH])], names=["cell", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                held[lang.encode()].update(set(terms(text.as_py())))
            if sum(map(len, held.values())) > HELD:
                yield from flush()
        yield from flush()

    got = docs.select("lang", "text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    bucket = F.expr(f"cell div {_BITS}").alias("bucket")
    return got.groupBy(bucket).agg(F.bitmap_construct_agg(F.col("cell") % _BITS).alias("bits"))


def _survivors(docs: DataFrame, sketch: Broadcast, cells: int) -> DataFrame:
    """(lang, source, term, n, docs): counts of terms that the sketch lets through, several rows each, from tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sketch.value, np.uint8)
        uses: dict[tuple, Counter] = defaultdict(Counter)
        docs: dict[tuple, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in uses.items():
                found = list(counts)
                passes = np.ones(len(found), bool)
                for row in cells_of(lang.encode(), found, cells):
                    passes &= (bits[row >> 3] >> (row & 7).astype(np.uint8) & 1).astype(bool)
                found = [t for t, p in zip(found, passes, strict=True) if p]
                for k in range(0, len(found), BATCH):
                    part = found[k : k + BATCH]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([counts[t] for t in part], pa.int64()), pa.array([docs[lang, source][t] for t in part], pa.int64()),
                    ], names=["lang", "source", "term", "n", "docs"])
            uses.clear()
            docs.clear()

        for b in batches:
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text"), strict=True):
                found = terms(text.as_py())
                uses[lang, source].update(found)
                docs[lang, source].update(set(found))
            if sum(map(len, uses.values())) > HELD:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)), exactly, for counts up to 10^19."""
    wide = lambda c: c.cast("decimal(20,0)")
    top, low = wide(count + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + SMOOTH * kept)
    return F.when(low > 0, F.call_function("div", top, low) + 1)


def counted(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 30, tables: Tables | None = None) -> tuple[DataFrame, DataFrame]:
    """(counts, groups), both stored: the exact counts of kept terms, and one row for each language and source.

    counts: lang, source, term, n, lang_n (uses in the whole language), share, lang_share. groups: lang, source, total (N),
    kept (V), lang_total, rest (the share of a kept term that the group has not; null without kept terms)."""
    spark = docs.sparkSession
    tables = tables or Tables(spark, "divergence")
    d = renamed(docs, lang=lang_col, source=source_col, text=text_col)
    d = d.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    cells = _cells(docs)
    bits = bytearray(ROWS * cells // 8)  # 32 MB at most
    for bucket, part in _sketch(d, cells, least_docs).toLocalIterator():
        bits[bucket * _BITS // 8 : (bucket + 1) * _BITS // 8] = part
    some = _survivors(d, spark.sparkContext.broadcast(bytes(bits)), cells)
    # Dealt by term, so that the counts of groups, of the language and the document frequency need no further shuffle.
    some = some.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    some = some.select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("docs"), (F.row_number().over(term.orderBy("source")) == 1).cast("long").alias("head"))
    exact = tables.put(some.filter(F.col("docs") >= least_docs).drop("docs"), "counts")
    by_lang = exact.groupBy("lang").agg(F.sum("head").alias("kept"), F.sum("n").alias("lang_total"))
    groups = d.select("lang", "source").distinct().join(exact.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(by_lang, "lang", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = groups.select("lang", "source", zero("total"), zero("kept"), zero("lang_total"))
    groups = tables.put(groups.withColumn("rest", share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))), "groups")
    counts = exact.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "lang_n", share(F.col("n"), F.col("total"), F.col("kept")).alias("share"), share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("lang_share"))
    out = tables.put(counts, "shares")
    tables.drop(exact)
    return out, groups


def distances(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each two sources of a language, both ways, the summed differences of their shares.

    Over terms that either has, |p - q| is written as what it would be if the other source had none of them, plus what their
    meeting changes. The first part follows from counts alone, the second from an equi-join by term."""
    size = lambda x, y: F.abs(F.col(x) - F.col(y))
    g = groups.select("lang", F.col("source").alias("a"), F.col("rest").alias("rest_a"), "kept")
    h = groups.select("lang", F.col("source").alias("b"), F.col("rest").alias("rest_b"))
    pairs = g.join(h, "lang").filter("a <> b").select("lang", "a", "b", F.coalesce(F.col("kept") * size("rest_a", "rest_b"), F.lit(0)).alias("value"))
    # One source alone: terms of one count have one share.
    levels = counts.groupBy("lang", F.col("source").alias("a"), "share").agg(F.count("*").alias("terms"))
    alone = levels.join(g, ["lang", "a"]).join(h, "lang").filter("a <> b").select("lang", "a", "b", (F.col("terms") * (size("share", "rest_b") - size("rest_a", "rest_b"))).alias("value"))
    alone = alone.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both_ways = lambda df: df.union(df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    # Terms of both: each pair is met once.
    c = counts.join(groups.select("lang", "source", "rest"), ["lang", "source"])
    one = c.select("lang", "term", F.col("source").alias("a"), F.col("share").alias("p"), F.col("rest").alias("rest_a"))
    two = c.select("lang", "term", F.col("source").alias("b"), F.col("share").alias("q"), F.col("rest").alias("rest_b"))
    met = one.join(two, ["lang", "term"]).filter("a < b").select("lang", "a", "b", (size("p", "q") - size("p", "rest_b") - size("q", "rest_a") + size("rest_a", "rest_b")).alias("value"))
    met = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    every = pairs.union(both_ways(alone)).union(both_ways(met)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return every.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank). Part 'pair': each other source of the language, the farthest first. Part 'term':
    the top terms that a source uses more than its language does, by the difference of their shares.

    Null text, language and source read as ''. A group whose rows have no term takes part with counts of 0; a language without kept
    terms has pairs of value 0 and no terms. Repeated rows count each. Ties rank by the item's UTF-8. An empty table gives no
    rows; other columns are not read. The driver holds bitmaps of at most 32 MB."""
    counts, groups = counted(docs, lang_col, source_col, text_col, least_docs)
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))
    pairs = ranked(distances(counts, groups)).withColumn("part", F.lit("pair"))
    over = counts.filter("share > lang_share").select("lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("lang_share")).alias("value"))
    over = ranked(over).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*cols).union(over.select(*cols))
