"""Byte ranges: coalescing, size-capped slices, members of slices, summaries per archive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from captrail.functions.values import free
from captrail.session import ship


def coalesce_ranges(ranges: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """Half-open ranges of a key joined where they overlap or touch."""
    n, nth = free(ranges, "_new", "_isle")
    w = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = ranges.withColumn(n, F.when(F.col(start) <= reach, 0).otherwise(1))
    isle = flagged.withColumn(nth, F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return isle.groupBy(key, nth).agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop(nth)


def islands(spans: DataFrame, max_gap: int, key: str = "w", offset: str = "o", length: str = "l") -> DataFrame:
    """spans with _isle: where the gap to everything before exceeds max_gap, any greedy slicing starts anew, so each island
    can be cut into slices by itself, and an archive is cut by many tasks."""
    w = Window.partitionBy(key).orderBy(offset, length)
    reach = F.max(F.col(offset) + F.col(length) - 1).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(offset) - reach - 1 > max_gap, 1).otherwise(0)
    return spans.withColumn("_new", new).withColumn("_isle", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def slice_starts(first: np.ndarray, last: np.ndarray, forced: np.ndarray, max_gap: int, max_slice: int) -> np.ndarray:
    """Where slices start among ranges in order: the next one is the first range that is forced to, too far from what the slice has
    reached, or too much for it. It is looked for in a window that doubles, by the running reach of the window."""
    starts, at, n, width = np.zeros(len(first), bool), 0, len(first), 16
    while at < n:
        starts[at] = True
        upto, found = at, None
        while found is None and upto < n:
            upto = min(n, at + width)
            reach = np.maximum.accumulate(last[at:upto])
            breaks = forced[at + 1 : upto] | (first[at + 1 : upto] - reach[:-1] > max_gap + 1) | (reach[1:] - first[at] >= max_slice)
            found = int(breaks.argmax()) if breaks.any() else None
            width = 2 * width if found is None else max(16, 2 * found)
        at = n if found is None else at + 1 + found
    return starts


def _numbered(spans: DataFrame, max_gap: int, max_slice: int, key: str) -> DataFrame:
    """(key, _isle, o, l) with _slice, a number for each slice of an island. Ranges pass in batches; of the slice that is open
    at the end of a batch only its first byte and its reach are held, as a range before the next batch."""
    ship(spans.sparkSession)
    ordered = spans.repartition(key, "_isle").sortWithinPartitions(key, "_isle", "o", "l")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            names, isles, o, length = (b.column(c) for c in (key, "_isle", "o", "l"))
            first, isle = o.to_numpy(zero_copy_only=False), isles.to_numpy(zero_copy_only=False)
            last = first + length.to_numpy(zero_copy_only=False) - 1
            code = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            forced = np.ones(len(first), bool)
            forced[1:] = (code[1:] != code[:-1]) | (isle[1:] != isle[:-1])
            opened = held is not None and held[:2] == (names[0].as_py(), int(isle[0]))
            if opened:
                first, last, forced = np.append(held[2], first), np.append(held[3], last), np.append(True, forced)
                forced[1] = False
            starts = slice_starts(first, last, forced, max_gap, max_slice)
            numbers = n + np.cumsum(starts) - int(opened)
            n, at = int(numbers[-1]), int(np.flatnonzero(starts)[-1])
            held = (names[len(names) - 1].as_py(), int(isle[-1]), int(first[at]), int(last[at:].max()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers[int(opened) :], pa.int64())], names=[*b.schema.names, "_slice"])

    return ordered.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields) + ", _slice long")


def slice_plan(spans: DataFrame, max_gap: int, max_slice: int, min_slice: int = 0, key: str = "w", offset: str = "o", length: str = "l") -> DataFrame:
    """(key, slice_start, slice_end inclusive, slice_len, member_count, members): greedy slices of distinct valid ranges.

    A range joins the open slice if the gap is max_gap at most and the slice stays within max_slice (none or less: no
    limit). Slices shorter than min_slice grow forward, within max_slice; members are those of the slice before it grows."""
    s = spans.select(key, F.col(offset).cast("long").alias(offset), F.col(length).cast("long").alias(length)).filter((F.col(offset) >= 0) & (F.col(length) > 0)).distinct()
    s = islands(s, max_gap, key, offset, length)
    s = s.select(key, "_isle", F.col(offset).alias("o"), F.col(length).alias("l"))
    s = _numbered(s, max_gap, max_slice, key) if max_slice > 0 else s.withColumn("_slice", F.lit(0))
    each = s.groupBy(key, "_isle", "_slice").agg(F.min("o").alias("slice_start"), F.max(F.col("o") + F.col("l") - 1).alias("slice_end"), F.array_sort(F.collect_list(F.struct("o", "l"))).alias("members"))
    if min_slice > 0:
        least = min(min_slice, max_slice) if max_slice > 0 else min_slice
        each = each.withColumn("slice_end", F.when(F.col("slice_end") - F.col("slice_start") + 1 >= min_slice, F.col("slice_end")).otherwise(F.greatest("slice_end", F.col("slice_start") + least - 1)))
    return each.select(key, "slice_start", "slice_end", (F.col("slice_end") - F.col("slice_start") + 1).alias("slice_len"), F.size("members").alias("member_count"), "members")


def slice_members(plan: DataFrame, key: str = "w") -> DataFrame:
    """(key, slice_start, slice_end, o, l): the ranges of each slice."""
    return plan.select(key, "slice_start", "slice_end", F.explode("members").alias("m")).select(key, "slice_start", "slice_end", "m.o", "m.l")


def cut_members(blobs: DataFrame, members: DataFrame, key: str = "w") -> DataFrame:
    """The bytes of each member out of its slice's blob (key, slice_start, blob); null where the blob is missing or short."""
    m = members.join(blobs.select(key, "slice_start", "blob"), [key, "slice_start"], "left")
    at = F.col("o") - F.col("slice_start")
    fits = (at >= 0) & (at + F.col("l") <= F.length("blob"))
    return m.withColumn("bytes", F.when(fits, F.substring("blob", (at + 1).cast("int"), F.col("l").cast("int")))).drop("blob")


def warc_summary(found: DataFrame) -> DataFrame:
    """Per archive: captures, bytes, first offset and last end; the last three over rows with both numbers."""
    both = F.col("warc_offset").isNotNull() & F.col("warc_length").isNotNull()
    return found.filter(F.col("warc_filename") != "").groupBy("warc_filename").agg(
        F.count("*").alias("captures"), F.coalesce(F.sum(F.when(both, F.col("warc_length"))), F.lit(0)).alias("bytes"),
        F.min(F.when(both, F.col("warc_offset"))).alias("first_offset"), F.max(F.when(both, F.col("warc_offset") + F.col("warc_length"))).alias("last_end"),
    )


def warc_candidates(found: DataFrame, sort: str = "bytes", min_captures: int = 1, limit: int = 0) -> DataFrame:
    """Archives worth fetching, by 'bytes', 'captures' or 'warc_filename'."""
    s = warc_summary(found).filter(F.col("captures") >= min_captures)
    order = [F.col("warc_filename")] if sort == "warc_filename" else [F.col(sort).desc(), F.col("warc_filename")]
    return s.orderBy(*order).limit(limit) if limit > 0 else s.orderBy(*order)
