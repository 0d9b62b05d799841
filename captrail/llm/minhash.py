"""Near-duplicates by bottom-k sketches of one hash function.

1. A pass over the texts gives each document the size of its shingle set, a 128-bit signature of the set and its sketch:
   the SKETCH smallest hash values. Documents with equal sets form a class; the smallest id stands for it. Classes are numbered
   in the order of these ids.
2. Inverted lists: each class is listed under retained values. Two sets with at least the wanted similarity share many
   of their INDEXED smallest values, so a class needs no list under its most frequent ones (prefix filter, rarest first):
   common lines and passages give no long lists. For small sets the filter is exact, for others a miss needs a sketch
   overlap of chance below 1e-9.
3. Members of a short list meet each other, pass the estimate of the union's sketch and are confirmed by exact Jaccard.
4. Members of a long list (a group of copies) meet a pivot R of it instead, a member with few rare values, and are compared
   with it exactly. Linked sets A, B share alpha = percent * (|A| + |B|) / (100 + percent) items at least, of which R holds
   no more than the smaller of |A & R|, |B & R|. So what is not yet linked must share alpha less that many items outside R,
   and meets under its rarest ones (the same prefix filter, exact here): a group's common items are in R and give no lists,
   and items of one member only need none. Only pairs with a set smaller than R can do with R's items alone; those form lists by
   steps of size. Lists that are long again take another pivot, round by round. What is long grows fourfold with each round, so that
   rounds are few, up to LONGEST: a member meets no more than so many others under each of its items. Within that bound groups
   whose members are alike but not linked (differing in a few of many places) do meet in pairs, the more the larger the group.
   Only lists of former pivots, one a list and round, are paired as they are.
5. Components of all confirmed links give the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

from .common import Tables, free, renamed
from .components import components
from .words import hashes, sequences, words

SKETCH, INDEXED = 48, 32
#: Members of a list that meet in all pairs, of sketch values and of items outside a first pivot; longer ones take a pivot. Few
#: lists are left from round to round, and the second number grows fourfold with each, up to the third.
SHORT, SHORT_OUTSIDE, LONGEST = 16, 64, 1024
#: Steps of sizes in which sets smaller than a pivot meet.
STEP = math.log(1.02)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text; with fewer words the whole sequence is one shingle."""
    h = hashes(words(text, lower=True))
    return np.unique(sequences(h, min(size, len(h)))) if len(h) else np.zeros(0, np.uint64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, th, n, sig, sketch) for each row of (doc_id, th, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), size) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                pa.array([(s[:SKETCH] >> np.uint64(1)).view(np.int64) for s in sets], pa.list_(pa.int64())),
            ], names=["doc_id", "th", "n", "sig", "sketch"])

    return docs.mapInArrow(run, "doc_id long, th long, n long, sig string, sketch array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, shingles binary) of the given rows (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([shingle_set(t.as_py(), size).tobytes() for t in part.column("text")], pa.binary())], names=["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, sa, sb) of stored pairs. Only the sets that they need move. Light rows meet a's set first, so a hot pivot moves
    no sets but its own; then b's join evenly."""
    sets = sets.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    first = pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    return first.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, outside: bool = False) -> DataFrame:
    """(a, b, linked, na, nb, shared, out) of the stored pairs (a, b): exact comparison of full sets; out: b's items that a
    lacks, if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                    a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                    shared = len(np.intersect1d(a, b, assume_unique=True))
                    out = np.setdiff1d(b, a, assume_unique=True).view(np.int64) if outside else None
                    rows.append((100 * shared >= percent * (len(a) + len(b) - shared), len(a), len(b), shared, out))
                cells = list(zip(*rows, strict=True)) or [()] * 5
                types = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *[pa.array(c, t) for c, t in zip(cells, types, strict=True)]], names=["a", "b", "linked", "na", "nb", "shared", "out"])

    return _with_sets(pairs, sets).mapInArrow(run, "a long, b long, linked boolean, na long, nb long, shared long, out array<long>")


def _promising(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches and sizes allow the similarity."""
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}"))
    p = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("ka", "kb")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect(union, F.col("ka")), F.col("kb")))
    return p.filter((shared >= (percent / 100 - 0.45) * F.size(union)) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b")


def _within(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of each list (value, rep, n, c) whose sizes allow the similarity and whose components c differ."""
    x, y = (lists.select("value", F.col("rep").alias(i), F.col("n").alias(f"n{i}"), F.col("c").alias(f"c{i}")) for i in "ab")
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return x.join(y, "value").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & alike).select("a", "b")


def _rarest(rows: DataFrame, key: list[str], owner: list[str], item: str, size: Column, prefix: Column, tables: Tables) -> DataFrame:
    """Of rows (key + item, owner, c) those within the owner's prefix of rarest items, with pop, the mean frequency of the
    owner's items. Items that owners of one component c hold link no others: they count as the rarest and need no row."""
    # Written, so that the join deals both sides anew and Spark can split a hot item's partition.
    often = rows.groupBy(*key, item).agg(F.count("*").alias("df"), F.min("c").alias("low"), F.max("c").alias("high"))
    often = tables.put(often.filter("low < high").drop("low", "high"), "often")
    held = rows.join(often, [*key, item])
    own = Window.partitionBy(*owner)
    held = held.withColumns({"nth": F.row_number().over(own.orderBy("df", item)), "common": F.count("*").over(own), "pop": F.sum("df").over(own) / size})
    return held.filter(F.col("nth") <= prefix - (size - F.col("common")))


def _sorted_out(lists: DataFrame, most: int, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """(short, long): the lists (value, rep, n, c, pop) of two to most members and of more; lists of one component are done."""
    sized = lists.groupBy("value").agg(F.count("*").alias("m"), F.min("c").alias("low"), F.max("c").alias("high")).filter("m > 1 and low < high")
    sized = tables.put(sized.select("value", (F.col("m") > most).alias("is_long")), "sized")
    both = tables.put(lists.join(sized, "value"), "open")
    return both.filter("not is_long").drop("is_long"), both.filter("is_long").drop("is_long")


def _labelled(labels: DataFrame | None, links: DataFrame, tables: Tables) -> DataFrame:
    """(id, component): labels after a step along the links. Equal labels mean one component; the whole ones come at the end."""
    both = links
    for x in "ab":
        known = F.col(x)
        if labels is not None:
            both = both.join(labels.select(F.col("id").alias(x), F.col("component").alias(f"l{x}")), x, "left")
            known = F.coalesce(f"l{x}", x)
        both = both.withColumn(f"m{x}", known)
    ends = both.select(F.explode(F.array("a", "b")).alias("id"), F.least("ma", "mb").alias("component"))
    ends = ends if labels is None else ends.union(labels)
    return tables.put(ends.groupBy("id").agg(F.min("component").alias("component")), "labels")


def _by_pivots(long: DataFrame, links: DataFrame, sets: DataFrame, percent: int, tables: Tables) -> DataFrame:
    """(a, b): links, and those of the members of long lists that they leave in different components."""
    used, labels, most = None, None, SHORT_OUTSIDE
    fresh_links = links
    while not long.isEmpty():
        # A member is a pivot in one round at most, so rounds end. Lists of former pivots only have no other way than pairs.
        rank = F.struct("fresh", "pop", (-F.col("rep")).alias("rep"))
        known = long.join(used, long["rep"] == used["pivot"], "left").withColumn("fresh", F.col("pivot").isNull()).drop("pivot") if used is not None else long.withColumn("fresh", F.lit(True))
        # Written, as it is read again and so that Spark can split the join with a hot list.
        best = known.groupBy("value").agg(F.max(rank).alias("p"), F.min("n").alias("least")).select("value", (-F.col("p.rep")).alias("pivot"), F.col("p.fresh").alias("fresh"), "least")
        best = tables.put(best, "pivots")
        placed = long.join(best, "value")
        meet = placed.filter("fresh and rep <> pivot").groupBy(F.col("pivot").alias("a"), F.col("rep").alias("b")).agg(F.max("pop").alias("pop"), F.min("least").alias("least"))
        meet = tables.put(meet, "meet")
        pivots = best.filter("fresh").select("pivot").distinct()
        used = pivots if used is None else used.union(pivots)
        against = tables.put(_compared(meet, sets, percent, outside=True), "against")
        linked = against.filter("linked").select("a", "b")
        links, labels = links.union(linked), _labelled(labels, fresh_links.union(linked), tables)

        # Any partner has `other` items at least, so that `need` shared ones must be outside the pivot; none: the pivot's may do.
        of = lambda x: labels.select(F.col("id").alias(x), "component")
        other = F.greatest("least", F.ceil(percent * F.col("nb") / 100))
        need = F.ceil(percent * (F.col("nb") + other) / (100 + percent)) - F.col("shared")
        named = against.join(meet, ["a", "b"]).join(of("b"), "b", "left").withColumns({"c": F.coalesce("component", "b"), "need": need})
        named = tables.put(named.drop("component", "least"), "named")
        each = named.select("a", "b", "c", F.col("nb").alias("n"), F.size("out").alias("size"), F.greatest("need", F.lit(1)).alias("need"), F.explode("out").alias("e"))
        rare = _rarest(each, ["a"], ["a", "b"], "e", F.col("size"), F.col("size") - F.col("need") + 1, tables)
        # Without such, a linked pair lies within the pivot for the most part, is not linked with it on one side, and smaller
        # on one. It meets in the step of its smaller size, which the other side's share of the pivot bounds.
        step = lambda c: F.floor(F.log(c) / STEP).cast("int")
        low, high = F.ceil(percent * F.col("nb") / 100), F.least("nb", F.floor((100 + percent) * F.col("shared") / percent) - F.col("nb"))
        own = F.array(step(F.col("nb")))
        at = F.array_distinct(F.concat(F.when(low <= high, F.sequence(step(low), step(high))).otherwise(own), own))
        inside = named.filter("need <= 0 and (nb < na or not linked)").select("a", F.col("b").alias("rep"), F.col("nb").alias("n"), "c", "pop", F.explode(at).alias("at"))
        inside = inside.select(F.xxhash64("a", F.lit("inside"), "at").alias("value"), "rep", "n", "c", "pop")
        lists = rare.select(F.xxhash64("a", "e").alias("value"), F.col("b").alias("rep"), "n", "c", "pop").union(inside)
        short, following = _sorted_out(lists, most, tables)
        left = placed.filter("not fresh").join(of("rep"), "rep", "left").select("value", "rep", "n", F.coalesce("component", "rep").alias("c"))
        near = tables.put(_within(short.drop("pop").union(left), percent).distinct(), "near")
        fresh_links = tables.put(_compared(near, sets, percent).filter("linked").select("a", "b"), "links")
        links = links.union(fresh_links)
        long, most = following, min(4 * most, LONGEST)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Texts are lower-cased in A-Z. Null texts and texts without words have no shingles and are linked with nothing.
    Rows of one id are judged by their own texts. A row without an id takes the component of the class of its equals if
    one of these has an id, else null; it is kept if it has none. An empty table gives no rows."""
    out = _grouped(docs, id_col, text_col, shingle, percent, nameless=False)
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, nameless: bool) -> DataFrame:
    """One row per row of docs: doc_id, th (hash of the text), n, root, root_id, root_th.

    root is the number of the first class of the row's component, root_id and root_th are the id and text hash of the row
    that stands for it: of the smallest id, nulls last, then of the first class; root is null without shingles. Classes in which no row
    has an id take part if nameless."""
    tables = Tables(docs.sparkSession, "near")
    d = renamed(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    rows = tables.put(sketches(d, shingle), "rows")
    full = rows.filter("n > 0")
    firsts = full.groupBy("sig").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("f"))
    firsts = firsts.select("sig", F.col("f.none").alias("none"), F.col("f.doc_id").alias("first_id"), F.col("f.th").alias("first_th"))
    if not nameless:
        firsts = firsts.filter("not none")
    # Numbers in order; they are fixed by writing them.
    classes = tables.put(firsts.orderBy("none", "first_id", "sig").withColumn("rep", F.monotonically_increasing_id()), "classes")
    reps = full.join(classes.withColumnRenamed("sig", "_sig"), (F.col("sig") == F.col("_sig")) & F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("th") == F.col("first_th")))
    reps = tables.put(reps.groupBy("rep").agg(*[F.first(c).alias(c) for c in ("n", "sketch", "first_id", "first_th")], F.count("*").alias("copies")), "reps")

    # Lists under the rarest retained values. Values of one class only count as rare but need no list.
    least = max(1, int(INDEXED * (2 * percent / 100 - 1.33)))
    kept = F.least("n", F.lit(INDEXED))
    whole = F.col("n") <= math.floor(INDEXED * percent / 100)
    prefix = kept - F.when(whole, F.ceil(F.col("n") * percent / 100)).otherwise(least) + 1
    each = reps.select("rep", "n", F.col("rep").alias("c"), F.explode(F.slice("sketch", 1, INDEXED)).alias("value"))
    lists = _rarest(each, [], ["rep"], "value", kept, prefix, tables).select("value", "rep", "n", "c", "pop")
    short, long = _sorted_out(lists, SHORT, tables)
    some = tables.put(reps.join(short.union(long).select("rep").distinct(), "rep", "left_semi"), "candidates")
    pairs = tables.put(_promising(_within(short, percent), some, percent), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).union(long.select("rep")).distinct()
    ids = tables.put(some.join(ids, "rep").select(F.col("rep").alias("id"), "first_id", "first_th", "copies"), "ids")
    # A sorted join at any size: the ids grow with the corpus, so no plan may count on sending them to all tasks.
    texts = lambda of: d.join(of.hint("merge"), F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("th") == F.col("first_th"))).select("id", "text")
    chosen, again = texts(ids.filter("copies = 1")), ids.filter("copies > 1")
    if not again.isEmpty():  # of repeated rows of one id and text, one
        chosen = chosen.union(texts(tables.put(again, "again")).dropDuplicates(["id"]))
    sets = tables.put(_sets(chosen, shingle), "sets")
    links = tables.put(_compared(pairs, sets, percent).filter("linked").select("a", "b"), "links")
    label = components(_by_pivots(long, links, sets, percent, tables), tables=tables)

    roots = classes.select(F.col("rep").alias("root"), F.col("first_id").alias("root_id"), F.col("first_th").alias("root_th"))
    known = classes.join(label, classes["rep"] == label["id"], "left").select(F.col("sig").alias("_sig"), F.coalesce("component", "rep").alias("root")).join(roots, "root")
    out = tables.put(rows.join(known, rows["sig"] == known["_sig"], "left").select("doc_id", "th", "n", "root", "root_id", "root_th"), "grouped")
    tables.drop_all(out)
    return out


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group of near-duplicates: the smallest id, one without an id only if none has one; of
    repeated rows of one id and text, one. Rows are told apart by id and text, so that all are compared. Null texts and
    texts without words are in no group and stay. An empty table gives no rows; columns may have any names."""
    found = _grouped(docs, id_col, text_col, shingle, percent, nameless=True)
    kept = found.filter(F.col("root").isNull() | (F.col("doc_id").eqNullSafe(F.col("root_id")) & (F.col("th") == F.col("root_th"))))
    tables = Tables(docs.sparkSession, "near-kept")
    i, th, copies = free(docs, "_id", "_th", "_copies")
    kept = tables.put(kept.groupBy(F.col("doc_id").alias(i), F.col("th").alias(th)).agg(F.count("*").alias(copies)), "kept")
    mine = [F.col(f"`{c}`") for c in docs.columns]
    one = lambda of: docs.join(of, F.col(f"`{id_col}`").eqNullSafe(F.col(i)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(th)))
    out, again = one(kept.filter(F.col(copies) == 1)).select(*mine), kept.filter(F.col(copies) > 1)
    if not again.isEmpty():
        out = out.union(one(tables.put(again, "again")).dropDuplicates([i, th]).select(*mine))
    return out
