"""Further named queries: sources written and read again, fetched bytes, index upkeep and small operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captrail.functions import urls, values
from captrail.operators import aggregates, audit, hierarchy, index, layout, search, slices, warc
from captrail.paths import scratch
from captrail.plans.fixtures import PTR_SQL, REV, ptr, read, spans
from captrail.plans.registry import _AUDIT, _FILES, _GROUPED, _INV, _S, _SLICES, _ZONES, SHOWN, _audited, _files, _groups, _members, _ptr, _shards, _sub, _zones, _zones_below, query
from captrail.sources import cdxj, fetch, footers, shards

COLLECTIONS = ("CC-MAIN-2024-10", "CC-MAIN-2024-18", "CC-MAIN-2025-05")


# Sources

def _lines(s, d) -> DataFrame:
    """CDXJ lines, every sixth without a URL; shard_file carries the page."""
    p = ptr(s, d).withColumn("url", F.when(F.col("page_id") % 6 != 0, F.col("url")))
    return cdxj.to_cdxj(p.withColumn("shard_file", F.col("page_id").cast("string")))


@query(_ptr("select collection, host_rev || ')/' surt, ts, url, host_rev, status, warc_offset from ptr where page_id % 6 <> 0"))
def cdxj_gzip_scan(s, d):
    """Listings in gzip files below a folder for each collection."""
    base = scratch(s)
    lines = _lines(s, d).select("collection", "value")
    for c in COLLECTIONS:
        lines.filter(F.col("collection") == c).select("value").write.option("compression", "gzip").text(f"{base}/{c}")
    return cdxj.parse_cdxj(cdxj.read_cdxj(s, f"{base}/*/*.gz")).select("collection", "surt", "ts", "url", "host_rev", "status", "warc_offset")


@query(_ptr("select page_id, case when page_id % 6 <> 0 then url end url, case when page_id % 6 <> 0 then host_rev end host_rev, status, warc_offset from ptr"))
def cdxj_bulk_parse(s, d):
    return cdxj.parse_cdxj(_lines(s, d), require_url=False).select(F.col("shard_file").cast("long").alias("page_id"), "url", "host_rev", "status", "warc_offset")


@query(_ptr("select page_id, ts as \"timestamp\", case when page_id % 6 <> 0 then url end url, mime, digest, warc_length from ptr"))
def cdxj_sample_parse(s, d):
    return cdxj.parse_sample(_lines(s, d)).select(F.col("shard_file").cast("long").alias("page_id"), "timestamp", "url", "mime", "digest", "warc_length")


@query(_ptr("select host_rev || ')/x' surt, url, ts, array_to_string(list_reverse(string_split(host_rev, ',')), '.') host, host_rev, warc_filename, warc_offset, warc_length from ptr where page_id % 4 <> 0"))
def legacy_parse(s, d):
    """Blank-separated listings among lines that are too short."""
    p = ptr(s, d)
    full = F.concat_ws(" ", F.concat("host_rev", F.lit(")/x")), "url", "ts", F.lit("a b c d e"), "warc_filename", "warc_offset", "warc_length")
    return cdxj.parse_legacy(p.select(F.when(F.col("page_id") % 4 == 0, F.lit(" short line ")).otherwise(full).alias("value")))


@query(_ptr("select url, ts, collection, case when page_id % 2 = 0 then status end status, warc_offset from ptr"))
def pointers_of_any_age(s, d):
    """Files of two generations: the older ones lack columns and name the time otherwise."""
    base, p = scratch(s), ptr(s, d)
    p.filter("page_id % 2 = 0").drop("page_id").write.parquet(f"{base}/new")
    p.filter("page_id % 2 = 1").select("url", F.col("ts").alias("timestamp"), "warc_filename", "warc_offset").write.parquet(f"{base}/old")
    return cdxj.read_pointers(s, f"{base}/new", f"{base}/old").select("url", "ts", "collection", "status", "warc_offset")


@query(_ptr("select page_id, url, status from ptr"))
def jsonl_scan(s, d):
    """Objects a line, among blank and broken lines."""
    base = scratch(s)
    lines = ptr(s, d).select(F.to_json(F.struct("page_id", "url", "status")).alias("value"))
    noise = lines.select(F.explode(F.array(F.lit(""), F.lit("{bad"))).alias("value"))
    lines.union(noise).write.text(f"{base}/jsonl")
    return cdxj.read_jsonl(s, f"{base}/jsonl", "page_id long, url string, status int")


@query(_ptr("select cast(page_id as varchar) gnis, host place_name, '' state_code, url source_url, case when page_id % 2 = 0 then 'active' else '' end status from ptr"))
def planner_csv_scan(s, d):
    """The planner's seed file with blanks around values and missing ones."""
    base = scratch(s)
    rows = ptr(s, d).select(F.col("page_id").cast("string").alias("gnis"), F.concat(F.lit("  "), "host", F.lit(" ")).alias("place_name"), F.lit(None).cast("string").alias("state_code"), F.col("url").alias("source_url"), F.when(F.col("page_id") % 2 == 0, "active").alias("status"))
    rows.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{base}/csv")
    return cdxj.read_planner_csv(s, f"{base}/csv")


@query(_ptr("select distinct collection id, concat('Crawl ', collection) as \"name\" from ptr"))
def catalog_scan(s, d):
    """A catalog in one JSON array."""
    base = scratch(s)
    c = ptr(s, d).select(F.col("collection").alias("id"), F.concat(F.lit("Crawl "), "collection").alias("name")).distinct()
    c.agg(F.to_json(F.array_sort(F.collect_list(F.struct("id", "name")))).alias("value")).write.text(f"{base}/catalog")
    return cdxj.read_catalog(s, f"{base}/catalog").select("id", "name")


@query(_ptr("select page_id, concat('C', cast(page_id % 4 as varchar)) as \"label\" from ptr where page_id % 4 < 3"))
def label_by_file(s, d):
    """Rows labelled by the file they are from; files without a label give none."""
    rows = ptr(s, d).select("page_id", F.concat(F.lit("file:/data/"), "collection", F.lit("/"), "shard_file").alias("source_path"))
    files = s.createDataFrame([(f"/elsewhere/cdx-0000{k}.gz", f"C{k}") for k in range(3)], "path string, collection string")
    return cdxj.labelled(rows, files).select("page_id", "label")


# Sinks

@query(_ptr("select page_id, url, status from ptr"))
def jsonl_sink(s, d):
    path = f"{scratch(s)}/out"
    layout.write_jsonl(ptr(s, d).select("page_id", "url", "status"), path)
    return s.read.schema("page_id long, url string, status int").json(path)


_FORMS = _ptr("select form, warc_filename from (select distinct warc_filename from ptr), (select unnest(['csv', 'json', 'jsonl', 'list']) form)")


@query(_FORMS)
def candidate_files(s, d):
    """Archives worth fetching, written in each form and read again."""
    base, c = scratch(s), slices.warc_candidates(ptr(s, d))
    for form in ("csv", "json", "jsonl", "list"):
        layout.write_candidates(c, f"{base}/{form}", form)
    back = {"csv": s.read.option("header", True).csv(f"{base}/csv"), "json": s.read.option("multiLine", True).json(f"{base}/json"), "jsonl": s.read.json(f"{base}/jsonl"), "list": s.read.text(f"{base}/list").withColumnRenamed("value", "warc_filename")}
    return aggregates.bag_union([df.select(F.lit(form).alias("form"), "warc_filename") for form, df in back.items()])


@query(_ptr("select 'zstd' codecs, count(*) as \"rows\", true as first_time, false as second_time from ptr"))
def codec_rewrite(s, d):
    """A table of another codec is written anew, one that has the codec is not."""
    base = scratch(s)
    ptr(s, d).write.option("compression", "snappy").parquet(f"{base}/a")
    first, second = layout.recompress(s, f"{base}/a", f"{base}/b"), layout.recompress(s, f"{base}/b", f"{base}/c")
    per = footers.footers(s, f"{base}/b").agg(F.array_join(F.array_distinct(F.flatten(F.collect_list("codecs"))), ",").alias("codecs"), F.sum("num_rows").alias("rows"))
    return per.withColumns({"first_time": F.lit(first), "second_time": F.lit(second)})


@query(_ptr("select count(*) as \"rows\", count(*) = 0 is_empty from ptr union all select 0, true"))
def empty_shard(s, d):
    base, p = scratch(s), ptr(s, d)
    return layout.write_or_mark(p, f"{base}/full").union(layout.write_or_mark(p.filter("status = 0"), f"{base}/none")).select("rows", "is_empty")


@query(_ptr("select case when page_id % 2 = 0 then collection else 'C' end collection, 's.gz' shard_file, page_id, url from ptr"))
def provenance(s, d):
    p = ptr(s, d).select("page_id", F.when(F.col("page_id") % 2 == 0, F.col("collection")).alias("collection"), "url")
    return layout.with_provenance(p, "C", "s.gz")


# Searches and joins

@query(_ptr(f"select {_S} from ptr where {_sub('com,example')} and collection in ('CC-MAIN-2024-10', 'CC-MAIN-2025-05')"))
def domain_search_collections(s, d):
    return search.domain_search(ptr(s, d), "example.com", collections=["CC-MAIN-2024-10", "CC-MAIN-2025-05"]).select(SHOWN)


@query(_ptr(f"select {_S} from ptr where {_sub('com,example')} and collection like 'CC-MAIN-2024-%'"))
def layout_search_year(s, d):
    """A subtree of a year, from a written layout: the year is a folder, the keys are pushed to the scan."""
    path = f"{scratch(s)}/sorted"
    layout.write_sorted(ptr(s, d), path, 4)
    return search.domain_search(s.read.parquet(path), "example.com", year="2024").select(SHOWN)


@query(_ptr("select page_id from ptr where cast(shard_file[5:9] as int) % 3 = 1"))
def shard_part(s, d):
    return ptr(s, d).filter(urls.in_shard_part("shard_file", 3, 1)).select("page_id")


@query(_ptr("select collection, shard_file, row_group, k as \"key\" from z join (select distinct host_rev k from ptr) on k between min_key and max_key", _ZONES))
def zone_keys(s, d):
    keys = ptr(s, d).select(F.col("host_rev").alias("key")).distinct()
    return index.zone_keys(_zones(s, d), keys).select("collection", "shard_file", "row_group", "key")


@query(_ptr("select page_id, warc_filename, warc_offset, url, page_id % 11 not in (3, 5) ok from ptr"))
def member_records(s, d):
    """Parsed records of members with what their pointer says."""
    p = ptr(s, d)
    places = p.select("page_id", "warc_filename", F.col("warc_offset").alias("o"), F.col("warc_length").alias("l"))
    got = warc.extract_members(_members(s, d).join(places, "page_id"), p)
    return got.select("page_id", "warc_filename", "warc_offset", "meta.url", "http.ok")


@query("select page_id, octet_length(encode(html)) n_bytes, sha256(html) sha256, md5(base64(encode(html))) coded, cast(null as varchar) text_preview from pages")
def raw_described(s, d):
    out = warc.described(read(s, d, "pages").select("page_id", F.encode("html", "UTF-8").alias("bytes")))
    return out.select("page_id", "n_bytes", "sha256", F.md5("raw_base64").alias("coded"), "text_preview")


@query(_ptr("select distinct collection, '2024' as \"year\" from ptr where collection like 'CC-MAIN-2024-%'"))
def shard_discovery(s, d):
    """The collections of a year among the files of a written layout, from their names alone."""
    path = f"{scratch(s)}/sorted"
    layout.write_sorted(ptr(s, d), path, 4)
    return shards.discover(s, path, year="2024").filter("size_bytes > 0").select("collection", "year").distinct()


@query(_ptr("select page_id, url from ptr where host_rev = 'org,example,therwh'"))
def row_group_search(s, d):
    """A host in written shards: zones from their footers prune the folders, Spark's reader the row groups."""
    path = _shards(s, d)
    return hierarchy.find_by_zones(s, path, _zones_below(s, path), "therwh.example.org").select("page_id", "url")



# Fetching

def _fetched(s, d) -> DataFrame:
    """Byte ranges of archives whose bytes follow from their place. Some slices fail, and some ranges fail both times."""

    def backend(name: str, start: int, end: int) -> bytes:
        import numpy as np

        if start % 97 == 0:
            raise OSError("status 404")
        if start % 5 == 0 and end - start >= 300:
            raise OSError("no answer for a range of this length")
        return ((np.arange(start, end + 1) * 31 + len(name)) % 251).astype(np.uint8).tobytes()

    return fetch.fetch_members(spans(s, d), fetch.patient(backend, 2, 0.0), 16, 512, 4096, check=False)


_FETCHED = _SLICES + """, f as (select r.w, o, l, case when not (slice_start % 97 = 0 or slice_start % 5 = 0 and slice_end - slice_start >= 300) then 'slice' when o % 97 = 0 then 'failed' else 'range' end how
    from r join sl on r.w = sl.w and r.sid = sl.sid) """


@query(_FETCHED + "select w, o, l, how, case when how <> 'failed' then (o * 31 + length(w)) % 251 end first_byte, case when how <> 'failed' then l end n from f")
def fetch_members(s, d):
    first = F.conv(F.hex(F.substring("bytes", 1, 1)), 16, 10).cast("long")
    return _fetched(s, d).select("w", "o", "l", "how", F.when(F.col("bytes").isNotNull(), first).alias("first_byte"), F.length("bytes").cast("long").alias("n"))


@query(_FETCHED + "select w, count(*) filter (how <> 'failed') n_ok, count(*) filter (how = 'failed') n_failed, count(*) filter (how = 'range') n_second, coalesce(sum(l) filter (how <> 'failed'), 0)::bigint n_bytes from f group by w")
def fetch_counts(s, d):
    return fetch.fetch_counts(_fetched(s, d))


@query("""select event_id, case event_id % 6 when 1 then true when 3 then true when 5 then true else false end transient from events""")
def transient_errors(s, d):
    texts = ["HTTP 404", "HTTP 503 Service Unavailable", "HTTP 500", "Read TIMED OUT", "disk full", "Connection reset by peer"]
    return read(s, d, "events").select("event_id", urls.transient_error(F.get(F.array(*[F.lit(t) for t in texts]), (F.col("event_id") % 6).cast("int"))).alias("transient"))


# Index upkeep

@query(_ptr("select collection, shard_file, host_rev, min(host) host, split_part(collection, '-', 3) as \"year\" from ptr group by collection, shard_file, host_rev"))
def index_refresh(s, d):
    """An index built in two parts, of which the second repeats shards of the first."""
    p = ptr(s, d)
    start = index.domain_shards(p.filter("shard_file in ('cdx-00000.gz', 'cdx-00001.gz')"))
    return index.refreshed(start, p.filter("shard_file <> 'cdx-00000.gz'"))


@query(_ptr("select collection, shard_file, host_rev, arg_min(concat(cast(page_id as varchar), '.', host), page_id) host from ptr group by 1, 2, 3"))
def first_seen_host(s, d):
    """The host as first named in a shard, where names differ."""
    p = ptr(s, d).withColumn("host", F.concat_ws(".", F.col("page_id").cast("string"), "host"))
    return index.domain_shards(p, "page_id").drop("year")


@query(_ptr("""select collection, shard_file, rg row_group, min(host_rev) host_rev, min(ri) dom_row_start, max(ri) + 1 dom_row_end, any_value(s) rg_row_start, any_value(e) rg_row_end, min(ri) - any_value(s) dom_rg_row_start, max(ri) + 1 - any_value(s) dom_rg_row_end
    from (select *, sum(nw) over (partition by collection, shard_file, rg order by ri) isle, min(ri) over (partition by collection, shard_file, rg) s, max(ri) over (partition by collection, shard_file, rg) + 1 e from
      (select *, case when host_rev = lag(host_rev) over (partition by collection, shard_file, rg order by ri) then 0 else 1 end nw from g)) group by collection, shard_file, rg, isle""", _GROUPED))
def segment_offsets(s, d):
    return index.segment_offsets(_groups(s, d), ["collection", "shard_file", "row_group"], "row_index")


@query(_ptr("select collection, shard_file, row_group, n_rows, coalesce(sum(n_rows) over (partition by collection, shard_file order by row_group rows between unbounded preceding and 1 preceding), 0)::bigint row_start from z", _ZONES))
def row_starts(s, d):
    z = _zones(s, d).withColumn("path", F.concat_ws("/", "collection", "shard_file"))
    return index.row_starts(z, "path", "row_group", "n_rows").select("collection", "shard_file", "row_group", "n_rows", "row_start")


@query(f"with {_FILES} select * from new where path not in (select path from old where size_bytes % 2 = 0)")
def without_stale(s, d):
    old, new = _files(s, d)
    return index.without_stale(new, old.filter("size_bytes % 2 = 0"), "path")


@query(_ptr("select collection, url from ptr where collection = 'CC-MAIN-2024-10' union all select 'CC-MAIN-2024-18', url from ptr where collection = 'CC-MAIN-2024-18'"))
def consolidate(s, d):
    """A year's table gets the collection it lacks; the one it holds is not added twice."""
    p = ptr(s, d)
    of = lambda c: p.filter(F.col("collection") == c).select("url")
    year = of(COLLECTIONS[0]).withColumn("collection", F.lit(COLLECTIONS[0]))
    return index.consolidate(year, {c: of(c) for c in COLLECTIONS[:2]}).select("collection", "url")


@query(_ptr("select collection, count(*) n from ptr group by 1 union all select 'none', 0"))
def bag_union_counts(s, d):
    p = ptr(s, d)
    return aggregates.bag_union_counts({c: p.filter(F.col("collection") == c) for c in COLLECTIONS} | {"none": p.filter("false")})


@query(_ptr("select page_id, url, cast(null as int) status from ptr union all select page_id, null, status from ptr"))
def bag_union(s, d):
    p = ptr(s, d)
    return aggregates.bag_union([p.select("page_id", "url"), p.select("page_id", "status")])


# Audits

_SHARDS = """inv as (select distinct concat('CC-MAIN-', cast(2020 + o_custkey % 5 as varchar), '-', lpad(cast(o_custkey % 7 as varchar), 2, '0')) collection, concat('cdx-', lpad(cast(o_orderkey % 300 as varchar), 5, '0'), '.gz') shard, o_orderkey % 300 k from orders)"""


def _inventory(s, d) -> DataFrame:
    o = read(s, d, "orders")
    coll = F.concat(F.lit("CC-MAIN-"), (2020 + F.col("o_custkey") % 5).cast("string"), F.lit("-"), F.lpad((F.col("o_custkey") % 7).cast("string"), 2, "0"))
    return o.select(coll.alias("collection"), F.concat(F.lit("cdx-"), F.lpad((F.col("o_orderkey") % 300).cast("string"), 5, "0"), F.lit(".gz")).alias("name"), (F.col("o_orderkey") % 300).alias("k"))


@query(f"with {_SHARDS} select collection[9:12] as \"year\", count(*) expected, count(*) filter (k % 3 <> 0) ingested, count(*) filter (k % 3 = 0) missing from inv group by 1")
def shard_progress_year(s, d):
    inv = _inventory(s, d)
    return audit.shard_progress(inv, inv.filter("k % 3 <> 0").withColumnRenamed("name", "shard_file"))


@query(f"with {_SHARDS} select collection, count(*) expected, count(*) filter (k % 3 <> 0) ingested, count(*) filter (k % 3 = 0) missing from inv group by 1")
def shard_progress_collection(s, d):
    inv = _inventory(s, d)
    return audit.shard_progress(inv, inv.filter("k % 3 <> 0").withColumnRenamed("name", "shard_file"), "collection")


@query(f"""with {_SHARDS}, c as (select distinct collection id from inv union all select 'CC-MAIN-1999-01') select id collection, count(shard) downloaded, 0::bigint converted, 0::bigint sorted, 0::bigint as "empty", case when count(shard) > 0 then 300 else 0 end expected, false complete,
    contains(id, '2021') indexed from c left join inv on id = collection group by id""")
def pipeline_status(s, d):
    """Collections of a catalog, one of which nothing is there, with the stages of their shards."""
    inv = _inventory(s, d)
    catalog = inv.select(F.col("collection").alias("id")).distinct().union(s.createDataFrame([("CC-MAIN-1999-01",)], "id string"))
    return audit.pipeline_status(catalog, inv, 300, inv.filter(F.col("collection").contains("2021")).select("collection"))


@query(f"with {_AUDIT} select collection, reason, count(*) n from (select collection, unnest(list_filter([case when mis then 'missing_columns' end, case when cod then 'codec' end, case when rg then 'row_group_size' end, case when st is null then 'sort_unknown' when not st then 'unsorted' end], lambda x: x is not null)) reason from au) group by 1, 2")
def reason_counts(s, d):
    return audit.reason_counts(_audited(s, d))


@query(f"with {_INV}, p as (select distinct concat('/', case when \"name\" like 'cdx-0001%' then '.tmp/' else '' end, collection, '/', \"name\") path from inv where \"name\" like '%.parquet') select arg_max(path, case when path like '%.sorted.parquet' then 1 else 0 end) path from p where path not like '%/.%' group by regexp_replace(path, '([.]sorted)?[.]parquet$', '')")
def prefer_sorted(s, d):
    k = F.col("o_orderkey")
    end = F.when(k % 4 == 0, ".gz").when(k % 4 == 1, ".gz.parquet").when(k % 4 == 2, ".gz.sorted.parquet").otherwise(".gz.parquet.empty")
    name = F.concat(F.lit("cdx-"), F.lpad((k % 300).cast("string"), 5, "0"), end)
    path = F.concat(F.lit("/"), F.when(name.like("cdx-0001%"), ".tmp/").otherwise(""), F.lit("CC-"), (F.col("o_custkey") % 7).cast("string"), F.lit("/"), name)
    return audit.prefer_sorted(read(s, d, "orders").select(path.alias("path")).filter(F.col("path").endswith(".parquet")))


# Small aggregates and functions

@query("""with e as (select concat('f/', cast(o_orderkey as varchar)) path, o_custkey::bigint size_bytes, (o_orderkey // 3 * 1000)::bigint mtime_ns from orders),
    r as (select *, sum(size_bytes) over (order by mtime_ns desc, path rows unbounded preceding) kept, (select sum(size_bytes) // 2 from e) most from e) select path, size_bytes, mtime_ns from r where kept > most""")
def cache_eviction(s, d):
    """The older half of a cache, by bytes."""
    o = read(s, d, "orders")
    e = o.select(F.concat(F.lit("f/"), F.col("o_orderkey").cast("string")).alias("path"), F.col("o_custkey").cast("long").alias("size_bytes"), F.expr("cast(o_orderkey div 3 * 1000 as bigint)").alias("mtime_ns"))
    most = e.agg(F.sum("size_bytes")).first()[0] // 2
    return aggregates.evict(e, most, part_ns=1_000_000)


@query("select event_id, event_type from events order by ts desc, event_id limit 25")
def newest_jobs(s, d):
    return aggregates.newest(read(s, d, "events").select("event_id", "event_type", "ts"), "ts", 25, "event_id").select("event_id", "event_type")


@query("""select user_id job, arg_max(event_type, event_id) filter (event_id % 3 <> 0) stage, arg_max(concat('CC-MAIN-2024-', lpad(cast(event_id % 52 as varchar), 2, '0')), event_id) filter (event_id % 4 = 0) collection from events group by 1""")
def log_state(s, d):
    """The last stage and collection that the log lines of each job name."""
    i = F.col("event_id")
    coll = F.when(i % 4 == 0, F.concat(F.lit(" of CC-MAIN-2024-"), F.lpad((i % 52).cast("string"), 2, "0"))).otherwise("")
    line = F.concat(F.when(i % 3 != 0, F.concat(F.lit(" ["), "event_type", F.lit("]"))).otherwise("plain"), F.lit(" done"), coll)
    return aggregates.log_state(read(s, d, "events").select(F.col("user_id").alias("job"), i.alias("line_no"), line.alias("line")))


@query("select page_id, sha256(concat('{\"url\":\"', url, '\",\"page_id\":', cast(page_id as varchar), '}')) k from pages")
def cache_keys(s, d):
    return read(s, d, "pages").select("page_id", values.cache_key("url", "page_id").alias("k"))


@query("select page_id, concat(sha256(url)[1:16], '__', regexp_extract(url, '([^/?]*)([?].*)?$', 1)) cached from pages")
def cache_names(s, d):
    return read(s, d, "pages").select("page_id", urls.warc_cache_name("url").alias("cached"))


@query(_ptr("select page_id, shard_file shard, collection, split_part(collection, '-', 3) as \"year\", '2019' plain_year from ptr"))
def path_parts(s, d):
    path = F.concat(F.lit("/data/"), "collection", F.lit("/"), "shard_file", F.lit(".sorted.parquet"))
    return ptr(s, d).select("page_id", urls.shard_name(path).alias("shard"), urls.collection_of_path(path).alias("collection"), urls.year_of_path(path).alias("year"), urls.year_of_path(F.lit("/d/year=2019/x.parquet")).alias("plain_year"))


@query(_ptr("select page_id, concat(host, '|', mime) parts from ptr"))
def split_lists(s, d):
    return ptr(s, d).select("page_id", F.array_join(urls.split_list(F.concat(F.lit(" ,"), "host", F.lit(" , ,\t"), "mime", F.lit(","))), "|").alias("parts"))


@query(_ptr(f"""select page_id, array_to_string(list_sort(list_distinct([{REV.format('host')}, {REV.format("concat('www.', host)")}, {REV.format('h')}, {REV.format("case when starts_with(h, 'www.') then h[5:] else concat('www.', h) end")}])), ' ') keys
    from (select *, lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)) h from ptr)"""))
def host_keys_of_urls(s, d):
    return ptr(s, d).select("page_id", F.array_join(urls.host_revs_for_urls("host", F.array("url", F.lit("  "))), " ").alias("keys"))


@query("select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then l_partkey when l_orderkey % 3 = 1 then l_partkey end as \"value\" from lineitem")
def truncated_integer(s, d):
    k, v = F.col("l_orderkey") % 3, F.col("l_partkey").cast("string")
    text = F.when(k == 0, v).when(k == 1, F.concat(v, F.lit(".9"))).otherwise(F.concat(F.lit("x"), v))
    return read(s, d, "lineitem").select("l_orderkey", "l_linenumber", values.truncating_int(text).alias("value"))
