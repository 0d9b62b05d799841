"""Spelling variants: words one edit apart, found by rolling-hash deletion keys.

1. Words are counted: within tasks first, then by word. A word's hash is a sum of its code points times powers of an odd number
   modulo 2^64, so that of the word without one code point follows from its prefix sum and its suffix sum, shifted by one
   power: a task makes all deletion keys of a batch of words as NumPy integers.
2. Keys are dealt by their value and sorted within tasks. Under one key stand the word itself and the longer words that one deletion
   turns into it; longer words with the same place of the deletion are a replacement apart. So no key holds more words
   than an alphabet times the length allows, and no key is hot.
3. Pairs that meet are verified on their strings, since keys may collide. A word's form is its most frequent near word, if
   that is much more frequent; roots follow forms to the end, by joins that double their reach.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, renamed
from .words import mixed

#: A-Z in lower case, runs of letters.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BASE = 0x9E3779B97F4A7C15
#: Words that a task holds before it hands on their counts, rows of a batch that leaves it.
HELD, BATCH = 300_000, 50_000


def variants(doc_id: int | None, text: str | None, run: re.Pattern, every: int, least: int) -> Counter:
    """The counts of a document's words of at least `least` code points, after its marked runs lost one."""
    out = Counter()
    if not text:
        return out
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for w, n in Counter(run.findall(text.encode("utf-8").translate(_LOWER).decode("utf-8"))).items():
        h = zlib.crc32(w.encode("utf-8"), prefix)
        if every and h % every == 0:
            k = h % len(w)
            w = w[:k] + w[k + 1 :]
        if len(w) >= least:
            out[w] += n
    return out


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2, every: int = 31) -> DataFrame:
    """(word, n) of the words that occur least_count times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, held = re.compile(f"[a-z\\u00C0-\\u00FF]{{{least_length},}}"), Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            ws = list(held)
            for k in range(0, len(ws), BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(ws[k : k + BATCH], pa.string()), pa.array([held[w] for w in ws[k : k + BATCH]], pa.int64())], names=["word", "n"])
            held.clear()

        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                held.update(variants(i, text.as_py(), letters, every, least_length))
                if len(held) > HELD:
                    yield from flush()
        yield from flush()

    d = renamed(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return d.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def keys_of(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index of the word, key, place) of each word and of each of its deletions, in parts of a bounded number of rows.

    place is -1 for the word itself, else twice the deleted code point's place, plus one if the code point before it is the
    same: such a deletion gives a string that another one gives too."""
    start = 0
    while start < len(words):
        end, size = start, 0
        while end < len(words) and (end == start or size + len(words[end]) <= BATCH):
            size += len(words[end])
            end += 1
        part = words[start:end]
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        flat = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).astype(np.uint64)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.arange(len(flat)) - first
        powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(1, int(lengths.max(initial=1))), BASE, np.uint64))])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * powers[at])])
        prefix, whole = sums[:-1] - sums[first], sums[first + np.repeat(lengths, lengths)] - sums[first]
        rest = whole - (sums[1:] - sums[first])
        less = mixed(prefix + rest * np.uint64(pow(BASE, -1, 1 << 64)) + np.repeat(lengths - 1, lengths).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        again = np.zeros(len(flat), np.int64)
        again[1:] = (flat[1:] == flat[:-1]) & (at[1:] > 0)
        ends = np.cumsum(lengths)
        own = mixed(sums[ends] - sums[ends - lengths] + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        index = np.concatenate([np.arange(len(part)), np.repeat(np.arange(len(part)), lengths)]) + start
        yield index, np.concatenate([own, less]).view(np.int64), np.concatenate([np.full(len(part), -1, np.int64), 2 * at + again])
        start = end


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("id").to_numpy(zero_copy_only=False)
        for index, key, place in keys_of(b.column("word").to_pylist()):
            for k in range(0, len(key), BATCH):
                s = slice(k, k + BATCH)
                yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(place[s]), pa.array(ids[index[s]])], names=["key", "place", "id"])


def meetings(key: np.ndarray, place: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, at, longer) of sorted whole runs of keys: b without its code point `at` should be a, the word itself (longer), or a
    without the one there. Of deletions that give one string only the first meets the word itself."""
    out, at, step = [], np.arange(len(key)), 1
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        p, q = place[at], place[at + step]
        hit = ((p == -1) & (q >= 0) & (q % 2 == 0)) | ((p >= 0) & (p >> 1 == q >> 1))
        out.append((ids[at[hit]], ids[at[hit] + step], q[hit] >> 1, p[hit] == -1))
        step += 1
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (ids[:0], ids[:0], place[:0], place[:0] == 0)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by key and place; the last key of a batch waits for the next one."""
    kept = None
    met = lambda run: pa.RecordBatch.from_arrays([pa.array(x) for x in meetings(*run)], names=["a", "b", "at", "longer"])
    for b in batches:
        now = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "place", "id")]
        now = now if kept is None else [np.concatenate(x) for x in zip(kept, now, strict=True)]
        cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
        kept = [x[cut:] for x in now]
        yield met([x[:cut] for x in now])
    if kept is not None:
        yield met(kept)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, a_word, b_word, a_n, b_n): each two of the words (id, word, n) that are one edit apart, once.

    Strings decide, at the place where the keys met, in linear time. Empty words count as words; null words take no part."""
    keys = words.filter("word is not null").select("id", "word").mapInArrow(_keys, "key long, place long, id long")
    met = keys.repartition("key").sortWithinPartitions("key", "place").mapInArrow(_meet, "a long, b long, at long, longer boolean")
    side = lambda s: words.select(F.col("id").alias(s), F.col("word").alias(f"{s}_word"), F.col("n").alias(f"{s}_n"))
    less = lambda w: F.expr(f"concat(substring({w}, 1, cast(at as int)), substring({w}, cast(at as int) + 2))")
    same = F.when(F.col("longer"), F.col("a_word") == less("b_word")).otherwise((less("a_word") == less("b_word")) & (F.col("a_word") != F.col("b_word")) & (F.length("a_word") == F.length("b_word")))
    return met.join(side("a"), "a").join(side("b"), "b").filter(same).drop("at", "longer")


def roots(forms: DataFrame, tables: Tables, most: int, factor: int) -> DataFrame:
    """(word, root) of words with a form: each round a root becomes the root of the root, so steps double.

    A form occurs factor times as often as its word, so the largest count bounds the steps and the rounds are known."""
    steps = max(1, ceil(log(max(most, 2), factor)))
    at = tables.put(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ceil(log2(steps))):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = tables.put(at.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
        tables.drop(at)
        at = further
    return at


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2, factor: int = 10, every: int = 31) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the maximal runs of Latin letters (ASCII and U+00C0 to U+00FF, A-Z in lower case) of least_length code points and
    least_count occurrences; every `every`-th run by a hash of document and run loses one code point first (0: none does). form: the near
    word of largest n, ties to the smallest in code-point order, if its n is factor times the word's; root: where the forms end.
    Null and empty texts have no words; a null id is hashed as empty; repeated rows count each; an empty table gives no rows;
    other columns are not read. Only the largest n reaches the driver."""
    if factor < 2:
        raise ValueError("a form must be more frequent than its word, or forms could run in circles")
    tables = Tables(docs.sparkSession, "spelling")
    words = tables.put(counted(docs, id_col, text_col, least_length, least_count, every).withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = tables.put(near_pairs(words).select("a", "b", "a_word", "b_word", "a_n", "b_n"), "near")
    sides = pairs.select(F.col("a").alias("id"), F.col("b_word").alias("near"), F.col("b_n").alias("m")).union(pairs.select("b", "a_word", "a_n"))
    best = sides.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    w = words.join(best, "id", "left")
    much = -F.col("best.m") >= factor * F.col("n")
    w = tables.put(w.select("word", F.when(much, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(much, -F.col("best.m")).alias("form_n")), "forms")
    tables.drop(words, pairs)
    most = w.agg(F.max("form_n")).first()[0]
    if most is None:
        return w.select("word", "form", F.col("word").alias("root"), "n", "n_near", "form_n")
    ends = roots(w.filter("form is not null"), tables, most, factor)
    return w.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
