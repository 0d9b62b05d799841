"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame operations only).

1. Sources in code-point order (null last) weigh 1, 2, 3, repeating. Shares of all words by weight become targets;
   a target stops at max_repeats times the source's words and the excess is shared anew by weight (water-filling).
2. Slot i of the schedule has the phase (i + 1) * GOLDEN modulo CIRCLE, in whole numbers, so that phases stay apart in a corpus of
   any size. Cumulative targets cut the circle into arcs; slots and the beginnings of arcs are sorted together, and a slot belongs to
   the arc that began last. There is a slot for each block of words, and the size of blocks does not grow with the corpus.
3. Each source's documents, shuffled by a hash of their id, form a stream of words that repeats up to max_repeats
   times and is cut into blocks of equal size. A source's slots are ranked, and the slot of rank r is joined with block r.
   A source that no slot falls to takes its first block, or as much of it as its target.

Running sums are built in two levels (totals per bucket, then rows within a bucket), so no task holds all rows or slots of one
source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, free, renamed, stored

#: The circle, and the odd number nearest to its golden section.
CIRCLE, GOLDEN = 1 << 62, 2850178704830799621


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """(doc_id, source, size): words of the text; null text has none. With row_col also row."""
    d = renamed(docs, doc_id=id_col, source=source_col, text=text_col, **({"row": row_col} if row_col else {}))
    return d.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *(["row"] if row_col else []))


def targets(sized: DataFrame, max_repeats: int = 3) -> DataFrame:
    """(source, known, source_size, weight, target, lo, hi): one row per source; its arc is from lo to below hi, of CIRCLE.

    The windows without partition see one row per source, never one per document."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.select("source", "source_size", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).alias("weight"))
    # Sources fill up in the order of cap / weight. With all before a source full, the level is what is left over the weight left.
    s = s.withColumn("cap", (F.lit(max_repeats) * F.col("source_size")).cast("double"))
    by_fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    every = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "total": F.sum("source_size").over(every).cast("double"),
        "full_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    s = s.withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
    s = s.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    # The level that holds is that of the first source that does not fill up.
    s = s.withColumn("level", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(every)["level"])
    s = s.withColumn("target", F.when(F.col("full") | F.col("level").isNull(), F.col("cap")).otherwise(F.col("level") * F.col("weight")))
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)
    share = F.least(F.lit(1.0), F.sum("target").over(up_to) / F.greatest(F.col("total"), F.lit(1.0)))
    s = s.withColumn("hi", F.floor(share * F.lit(float(CIRCLE))).cast("long"))
    return s.select("source", F.col("source").isNotNull().alias("known"), "source_size", "weight", "target",
                    F.coalesce(F.lag("hi").over(order), F.lit(0).cast("long")).alias("lo"), "hi")


def running(df: DataFrame, group: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """The sum of value over the rows before each row of its group, by (bucket, order): bucket totals first, then rows."""
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(g).alias(f"_{g}") for g in [*group, bucket]], F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_before"))
    same = [df[g].eqNullSafe(totals[f"_{g}"]) for g in [*group, bucket]]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    inner = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(totals, cond).withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_before", *[f"_{g}" for g in [*group, bucket]])


def slot_phases(spark: SparkSession, first: int, n_slots: int, slots_per_task: int) -> DataFrame:
    """(slot, phase) of n_slots slots from a given one on."""
    slots = spark.range(first, first + n_slots, 1, max(1, -(-n_slots // slots_per_task)))
    phase = F.pmod((F.col("id") + 1).cast("decimal(18,0)") * F.lit(GOLDEN).cast("decimal(19,0)"), F.lit(CIRCLE).cast("decimal(19,0)"))
    return slots.select(F.col("id").alias("slot"), phase.cast("long").alias("phase"))


def schedule(marks: DataFrame, slots: DataFrame) -> DataFrame:
    """(slot, source, known, rank): the source that each slot (slot, phase) falls to, and its rank among the source's slots, from 0.

    Arcs and slots are dealt by ranges of the circle and written with their part. Within a part the arc that began last is carried
    along; the first slots of a part belong to the last arc of the parts before it, of which there is one row a part."""
    arcs = marks.filter("hi > lo").select(F.col("lo").alias("phase"), F.lit(None).cast("long").alias("slot"), F.struct(F.coalesce("source", F.lit("")).alias("source"), "known").alias("arc"))
    both = arcs.unionByName(slots.withColumn("arc", F.lit(None).cast(arcs.schema["arc"].dataType)))
    dealt = stored(both.repartitionByRange("phase").withColumn("_part", F.spark_partition_id()), "mix-slots")
    per = dealt.groupBy("_part").agg(F.max(F.when(F.col("arc").isNotNull(), F.struct("phase", "arc")))["arc"].alias("_end"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_part", F.last("_end", ignorenulls=True).over(before).alias("_from"))
    within = Window.partitionBy("_part").orderBy("phase", F.col("slot").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    hit = dealt.withColumn("_arc", F.last("arc", ignorenulls=True).over(within)).filter("slot is not null").join(per, "_part")
    hit = hit.withColumn("arc", F.coalesce("_arc", "_from")).filter("arc is not null").select("slot", "arc.source", "arc.known", F.expr("slot div 65536").alias("_bucket"), F.lit(1).alias("_one"))
    return running(hit, ["source", "known"], "_bucket", [F.col("slot")], "_one", "rank").select("slot", "source", "known", "rank")


def _streams(sized: DataFrame, rows_per_bucket: int, seed: str) -> tuple[DataFrame, int]:
    n, total = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    d = sized.select("row", "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNotNull().alias("known"), "size",
                     F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_key"))
    d = d.withColumn("_bucket", F.pmod(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long"), F.lit(max(1, -(-n // rows_per_bucket)))))
    return running(d, ["source", "known"], "_bucket", [F.col("_key"), F.col("doc_id"), F.col("size"), F.col("row")], "size", "start").drop("_key", "_bucket"), total


def _mixed(sized: DataFrame, max_repeats: int, block: int, slots_per_task: int, rows_per_bucket: int, seed: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(streams, marks, pieces), all written. pieces: slot, row, lap, at, words: which words of a document a slot takes; at counts from the
    beginning of the document."""
    marks = stored(targets(sized, max_repeats), "mix-targets")
    streams, total = _streams(sized, rows_per_bucket, seed)
    m = marks.select(F.coalesce("source", F.lit("")).alias("source"), "known", "source_size", "target")
    streams = stored(streams.join(m, ["source", "known"]), "mix-streams")
    ranked = schedule(marks, slot_phases(marks.sparkSession, 0, -(-total // block), slots_per_task))
    ranked = stored(ranked, "mix-ranks")
    # No slot: the first block, as far as the target reaches. Else as many blocks as slots, each under its own slot.
    counts = ranked.groupBy("source", "known").agg(F.count("*").alias("slots"))
    few = m.join(counts, ["source", "known"], "left_anti").filter("target > 0")
    ranked = ranked.select("slot", "source", "known", "rank", F.lit(block).cast("long").alias("most"))
    ranked = ranked.union(few.select(F.lit(None).cast("long"), "source", "known", F.lit(0).cast("long"), F.least(F.lit(block), F.ceil("target")).cast("long")))
    reach = stored(m.join(counts, ["source", "known"], "left").select("source", "known", F.coalesce("slots", F.lit(1)).alias("blocks")), "mix-reach")
    lap = streams.filter("size > 0").join(reach, ["source", "known"]).withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))).withColumn("a", F.col("start") + F.col("lap") * F.col("source_size"))
    lap = lap.withColumn("last", F.least(F.expr(f"(a + size - 1) div {block}"), F.col("blocks") - 1)).filter(f"a div {block} <= last")
    parts = lap.withColumn("rank", F.explode(F.expr(f"sequence(a div {block}, last)"))).select("source", "known", "rank", "row", "size", "lap", "a")
    lo, hi = F.greatest(F.col("a"), F.col("rank") * block), F.least(F.col("a") + F.col("size"), F.col("rank") * block + F.col("most"))
    pieces = parts.join(ranked, ["source", "known", "rank"]).select("slot", "row", "lap", (lo - F.col("a")).alias("at"), (hi - lo).alias("words")).filter("words > 0")
    return streams, marks, pieces


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeats: int = 3,
        min_block: int = 64, max_slots: int = 65536, rows_per_bucket: int = 2048, seed: str = "mix") -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, start (its place in the source's stream), taken.

    Null or empty texts have size 0 and taken 0. A null source is a source of its own, the last. Repeated rows are laid
    out one after the other. An empty table gives no rows. Blocks have min_block words in a corpus of any size, so a source
    misses its target by a few blocks at most, and none with a target is left out. A task lists max_slots slots at most. Only the number of rows and of words reach the driver."""
    sized = stored(sizes(docs, id_col, text_col, source_col).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    streams, _, pieces = _mixed(sized, max_repeats, min_block, max_slots, rows_per_bucket, seed)
    got = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    out = streams.join(got, "row", "left")
    return out.select("doc_id", F.when(F.col("known"), F.col("source")).alias("source"), "size", "source_size", "target", "start", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeats: int = 3,
                min_block: int = 64, max_slots: int = 65536, rows_per_bucket: int = 2048, seed: str = "mix") -> DataFrame:
    """The mix itself: (slot, doc_id, source, lap, at, words) says that a slot takes so many words of a document from its at-th word (from 0)
    on. Sorted by slot, it is the order in which sources take turns; slot is null for sources that no slot falls to."""
    sized = stored(sizes(docs, id_col, text_col, source_col).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    streams, _, pieces = _mixed(sized, max_repeats, min_block, max_slots, rows_per_bucket, seed)
    return pieces.join(streams.select("row", "doc_id", F.when(F.col("known"), F.col("source")).alias("source")), "row").select("slot", "doc_id", "source", "lap", "at", "words")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeats: int = 3,
                    min_block: int = 64, max_slots: int = 65536, rows_per_bucket: int = 2048, seed: str = "mix") -> DataFrame:
    """docs with its own columns: a row for each lap in which the mix takes words of it, none if it takes none.

    Rows get a number, which is fixed by writing them, and each has its own laps, whatever its id. Whole texts stay whole. Documents
    without words have no place in a mix. An empty table gives no rows; columns may have any names."""
    row, laps, lap = free(docs, "_row", "_laps", "_lap")
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    s = sizes(kept, id_col, text_col, source_col, row)
    _, _, pieces = _mixed(stored(s, "mix-sizes"), max_repeats, min_block, max_slots, rows_per_bucket, seed)
    got = pieces.groupBy(F.col("row").alias(row)).agg((F.max("lap") + 1).cast("int").alias(laps))
    hit = kept.join(stored(got, "mix-laps"), row)
    return hit.withColumn(lap, F.explode(F.sequence(F.lit(1), F.col(laps)))).select(*[F.col(f"`{c}`") for c in docs.columns])
