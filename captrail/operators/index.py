"""Index tables derived from capture pointers: shards of a host, runs, pointers by rank, zone maps, registries, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captrail.functions import urls
from captrail.functions.values import free

FILE = ["collection", "shard_file"]


def domain_shards(pointers: DataFrame, order: str = "ts") -> DataFrame:
    """(collection, year, shard_file, host_rev, host): which shards hold a host, with the host as first named there, in the
    given order and then by name."""
    first = F.min(F.struct(order, "host"))["host"]
    return pointers.filter("host_rev is not null").groupBy(*FILE, "host_rev").agg(first.alias("host")).withColumn("year", urls.collection_year("collection"))


def refreshed(index: DataFrame, pointers: DataFrame, order: str = "ts") -> DataFrame:
    """The index with the entries of the shards in pointers made anew; entries of other shards stay. Repeating it changes nothing."""
    return index.join(pointers.select(*FILE).distinct(), FILE, "left_anti").unionByName(domain_shards(pointers, order))


def shards_of(index: DataFrame, key: str) -> DataFrame:
    """The distinct shards that hold a subtree, newest collection first."""
    from .search import in_subtree

    return index.filter(in_subtree(key)).select(*FILE).distinct().orderBy(F.col("collection").desc(), "shard_file")


def domains_listing(index: DataFrame) -> DataFrame:
    """(host_rev, host, shards): hosts with the number of shards that hold them."""
    return index.groupBy("host_rev").agg(F.min("host").alias("host"), F.countDistinct(F.struct(*FILE)).alias("shards"))


def url_counts(pointers: DataFrame) -> DataFrame:
    return pointers.groupBy(*FILE, "host_rev").agg(F.count("*").alias("n"))


def domain_pointers(pointers: DataFrame) -> DataFrame:
    """(shard, domain, row_offset, row_count) by rank within the shard sorted by domain and URL; '' where a URL has no domain."""
    p = pointers.withColumn("domain", urls.domain_from_url("url"))
    w = Window.partitionBy(*FILE).orderBy("domain", "url", "warc_offset")
    n = p.withColumn("_n", F.row_number().over(w) - 1)
    return n.groupBy(*FILE, "domain").agg(F.min("_n").cast("long").alias("row_offset"), F.count("*").alias("row_count"))


def domain_rows(rows: DataFrame, group: list[str], at: str = "row_index") -> DataFrame:
    """Per group (file and row group) and domain: first and last row (inclusive) and count, by physical position."""
    return rows.groupBy(*group, "domain").agg(F.min(at).alias("start_row"), F.max(at).alias("end_row"), F.count("*").alias("domain_count"))


def segments(rows: DataFrame, group: list[str], at: str, key: str = "host_rev") -> DataFrame:
    """Runs of equal keys in order of position within each group, ends exclusive. A null ends a run and is no run itself."""
    n, isle = free(rows, "_new", "_isle")
    w = Window.partitionBy(*group).orderBy(at)
    new = F.when(F.col(key).eqNullSafe(F.lag(key).over(w)) & F.lag(at).over(w).isNotNull(), 0).otherwise(1)
    runs = rows.withColumn(n, new).withColumn(isle, F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy(*group, isle).agg(F.first(key).alias(key), F.min(at).alias("row_start"), (F.max(at) + 1).alias("row_end"))
    return out.filter(F.col(key).isNotNull()).drop(isle)


def segment_offsets(rows: DataFrame, group: list[str], at: str, key: str = "host_rev") -> DataFrame:
    """segments() of row groups with six offsets: of the row group and of the run in the file (rg_row_*, dom_row_*), and of
    the run in its row group (dom_rg_row_*); starts inclusive, ends exclusive."""
    bounds = rows.groupBy(*group).agg(F.min(at).alias("rg_row_start"), (F.max(at) + 1).alias("rg_row_end"))
    runs = segments(rows, group, at, key).withColumnsRenamed({"row_start": "dom_row_start", "row_end": "dom_row_end"})
    inside = lambda c: F.col(c) - F.col("rg_row_start")
    return runs.join(bounds, group).withColumns({"dom_rg_row_start": inside("dom_row_start"), "dom_rg_row_end": inside("dom_row_end")})


def run_lengths(rows: DataFrame, group: list[str], at: str, key: str = "host_rev") -> DataFrame:
    """Runs of equal non-null keys, nulls left out before runs are formed."""
    return segments(rows.filter(F.col(key).isNotNull()), group, at, key).withColumn("run_len", F.col("row_end") - F.col("row_start"))


def positions(pointers: DataFrame) -> DataFrame:
    """Pointers with their 0-based row in their shard's order (host key, URL, time; nulls last)."""
    order = [F.col(c).asc_nulls_last() for c in ("host_rev", "url", "ts", "warc_offset")]
    return pointers.withColumn("row_index", (F.row_number().over(Window.partitionBy(*FILE).orderBy(*order)) - 1).cast("long"))


def zone_map(rows: DataFrame, group: list[str], key: str = "host_rev") -> DataFrame:
    """Least and greatest key and rows of each group."""
    return rows.groupBy(*group).agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"), F.count("*").alias("n_rows"))


def zone_point(zones: DataFrame, key: str) -> DataFrame:
    return zones.filter(F.lit(key).between(F.col("min_key"), F.col("max_key")))


def zone_subtree(zones: DataFrame, key: str) -> DataFrame:
    """Zones that may hold the key or a key under it: '-' follows ',' in byte order."""
    return zones.filter((F.col("min_key") < key + "-") & (F.col("max_key") >= key))


def zone_keys(zones: DataFrame, keys: DataFrame, key_col: str = "key", depth: int = 32) -> DataFrame:
    """Zones for many keys, by equi-joins: a key can only be in a zone whose bounds agree with it in as many leading characters
    as they agree in with each other, so zones and keys meet under these, up to depth of them.

    Zones of a sorted file that agree in one head and no further part at different next characters, so a head has no more zones
    a file than the alphabet has letters. A key is listed for those lengths of heads that any zone has, which are collected:
    depth + 1 numbers at most."""
    level, head = free(zones.select("*", *[F.lit(0).alias(c) for c in keys.columns if c not in zones.columns]), "_level", "_head")
    same = lambda n: F.substring("min_key", 1, n) == F.substring("max_key", 1, n)
    whole = F.least(F.lit(depth), F.length("min_key"), F.length("max_key"))
    agree = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), whole), same)), F.lit(0))
    z = zones.filter("min_key is not null and max_key is not null").withColumn(level, F.when(whole < 1, 0).otherwise(agree))
    z = z.withColumn(head, F.expr(f"substring(min_key, 1, `{level}`)"))
    lengths = [r[0] for r in z.select(level).distinct().collect()]
    k = keys.filter(F.col(key_col).isNotNull()).withColumn(level, F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>")))
    k = k.withColumn(head, F.expr(f"substring(`{key_col}`, 1, `{level}`)"))
    met = z.join(k, [level, head])
    return met.filter((F.col(key_col) >= F.col("min_key")) & (F.col(key_col) <= F.col("max_key"))).drop(level, head)


def zones_of_footers(groups: DataFrame) -> DataFrame:
    """The zone map of written files, from footers(): no data page is read."""
    return groups.select("path", "row_group", F.col("min_value").alias("min_key"), F.col("max_value").alias("max_key"), F.col("num_rows").alias("n_rows"))


def boundary_check(zones: DataFrame, file_cols: list[str], order: str) -> DataFrame:
    """Per file: pairs of neighbouring zones in order, out of order, and unknown for want of statistics."""
    w = Window.partitionBy(*file_cols).orderBy(order)
    last = F.lead(order).over(w).isNull()
    step = F.when(last, None).when(F.col("max_key").isNull() | F.lead("min_key").over(w).isNull(), "unknown").when(F.col("max_key") <= F.lead("min_key").over(w), "ok").otherwise("bad")
    z = zones.withColumn("_step", step)
    n = lambda what: F.sum(F.when(F.col("_step") == what, 1).otherwise(0)).cast("long").alias(what)
    return z.groupBy(*file_cols).agg(n("ok"), n("bad"), n("unknown"))


def inversions(rows: DataFrame, file_cols: list[str], at: str, key: str = "host_rev", first: int = 0) -> DataFrame:
    """Per file: rows whose key is less than the one before, among non-null keys (the first so many, if given)."""
    k = rows.filter(F.col(key).isNotNull())
    nth, before = free(rows, "_n", "_before")
    w = Window.partitionBy(*file_cols).orderBy(at)
    if first > 0:
        k = k.withColumn(nth, F.row_number().over(w)).filter(F.col(nth) <= first)
    k = k.withColumn(before, F.lag(key).over(w))
    return k.groupBy(*file_cols).agg(F.sum(F.when(F.col(key) < F.col(before), 1).otherwise(0)).cast("long").alias("inversions"), F.count("*").alias("checked"))


def row_starts(groups: DataFrame, file_col: str = "path", order: str = "row_group", n: str = "num_rows") -> DataFrame:
    """The first row of each row group: the rows of those before it."""
    w = Window.partitionBy(file_col).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumn("row_start", F.coalesce(F.sum(n).over(w), F.lit(0)))


def registry_year(pointers: DataFrame) -> DataFrame:
    """Per collection: shards, rows, host entries per shard summed (total_domains) and distinct hosts."""
    per = pointers.groupBy("collection", "shard_file").agg(F.count("*").alias("r"), F.countDistinct("host_rev").alias("d"))
    sums = per.groupBy("collection").agg(F.count("*").alias("total_shards"), F.sum("r").alias("total_rows"), F.sum("d").alias("total_domains"))
    distinct = pointers.groupBy("collection").agg(F.countDistinct("host_rev").alias("distinct_domains"))
    return sums.join(distinct, "collection").withColumn("year", urls.collection_year("collection"))


def registry_master(by_collection: DataFrame) -> DataFrame:
    """Per year: the sums of its collections."""
    return by_collection.groupBy("year").agg(F.count("*").alias("collections"), *[F.sum(c).alias(c) for c in ("total_shards", "total_rows", "total_domains")])


def consolidate(year_table: DataFrame | None, collections: dict[str, DataFrame]) -> DataFrame:
    """A year's table with the collections it lacks, each with its name as a constant column; present ones are skipped."""
    out = year_table
    for name, df in sorted(collections.items()):
        d = df.withColumn("collection", F.lit(name))
        if year_table is not None:
            d = d.join(year_table.select("collection").distinct(), "collection", "left_anti")
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def fingerprint_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, state): 'missing', 'extra', 'changed' or 'same' of (path, size_bytes, mtime_ns)."""
    o = old.select("path", F.col("size_bytes").alias("s0"), F.col("mtime_ns").alias("t0"), F.lit(True).alias("in_old"))
    n = new.select("path", F.col("size_bytes").alias("s1"), F.col("mtime_ns").alias("t1"), F.lit(True).alias("in_new"))
    same = F.col("s0").eqNullSafe(F.col("s1")) & F.col("t0").eqNullSafe(F.col("t1"))
    state = F.when(F.col("in_new").isNull(), "missing").when(F.col("in_old").isNull(), "extra").when(same, "same").otherwise("changed")
    return o.join(n, "path", "full_outer").select("path", state.alias("state"))


def without_stale(index: DataFrame, stale: DataFrame, path: str = "source_path") -> DataFrame:
    return index.join(stale.select(path).distinct(), path, "left_anti")


def parts(df: DataFrame, rows: int = 200_000) -> int:
    """Partitions of about `rows` rows: joins of so many sort as much in a task however long df is. Counts df."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def upsert(table: DataFrame, new: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """table with the rows of new in place of those of equal keys; with n, both are dealt by the keys to n partitions.

    An outer join, as Spark moves semi and anti joins below repartition(), to partitions of its own number."""
    (mark,) = free(table, "_in_new")
    given = new.select(*keys).withColumn(mark, F.lit(True))
    old = table
    if n:
        old, given = table.repartition(n, *keys), given.repartition(n, *keys)
    return old.join(given.distinct(), keys, "left").filter(F.col(mark).isNull()).select(*table.columns).unionByName(new)


def percentile_rank(col: str, p: float) -> Column:
    """Nearest-rank percentile: the value at ceil(p * n)."""
    return F.expr(f"percentile_disc({p}) within group (order by {col})")


def row_group_advice(runs: DataFrame, bytes_per_row: float, percent: float = 90.0, min_mb: float = 8.0, low: int = 10_000, high: int = 200_000, step: int = 5_000) -> DataFrame:
    """(runs, target_run, rows): rows of a row group near a high percentile of run lengths, rounded up to the step, within
    low and high, and worth min_mb at least."""
    t = runs.agg(F.count("*").alias("runs"), percentile_rank("run_len", min(99.9, max(50.0, percent)) / 100).cast("long").alias("target_run"))
    wanted = F.greatest("target_run", F.lit(int(min_mb * 1024 * 1024 / max(1.0, bytes_per_row))))
    return t.withColumn("rows", F.least(F.lit(high), F.greatest(F.lit(low), F.ceil(wanted / step) * step)).cast("long"))


def row_group_cost(runs: DataFrame, bytes_per_row: float, overhead_mb: float = 2.0) -> DataFrame:
    """(rows, cost): mean bytes read for a run at each candidate size; the candidates are a fixed list of nine."""
    sizes = [10_000, 20_000, 30_000, 50_000, 75_000, 100_000, 150_000, 200_000, 300_000]
    each = runs.select("run_len", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("rows"))
    return each.groupBy("rows").agg(F.avg(F.ceil(F.col("run_len") / F.col("rows")) * (F.col("rows") * bytes_per_row + overhead_mb * 1024 * 1024)).alias("cost"))


def rows_by_bytes(total_bytes: float, rows: int, target_mb: int = 128) -> int:
    """Rows of a row group of about target_mb (16 to 512), to the next ten thousand within 50,000 and 1,000,000."""
    per = max(1.0, total_bytes / max(1, rows))
    tens = round(min(512, max(16, target_mb)) * 1024 * 1024 / per / 10_000)
    return 10_000 * min(100, max(5, tens))


def write_by_shard(table: DataFrame, path: str) -> None:
    """An index table with a folder for each shard, one file in it: what refresh_in_place() replaces."""
    _by_shard(table).mode("overwrite").partitionBy(*FILE).parquet(path)


def _by_shard(table: DataFrame):
    return table.repartition(*FILE).sortWithinPartitions(*FILE, "host_rev").write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd")


def refresh_in_place(path: str, pointers: DataFrame, gone: DataFrame | None = None, order: str = "ts") -> None:
    """Replaces the entries of the shards in pointers in the table at path, and removes those of the shards (collection, shard_file) in
    gone. Only the folders of these shards are touched: a dynamic partition overwrite. Repeating it gives the same table.

    Shards that have no entries any more are removed too. Their names and those of the gone ones pass the driver, nothing else."""
    from captrail.paths import clear_partitions

    entries = domain_shards(pointers, order)
    _by_shard(entries).mode("overwrite").partitionBy(*FILE).parquet(path)
    named = pointers.select(*FILE).distinct()
    clear_partitions(path, named.join(entries.select(*FILE).distinct(), FILE, "left_anti"))
    if gone is not None:
        clear_partitions(path, gone.select(*FILE).distinct().join(named, FILE, "left_anti"))
