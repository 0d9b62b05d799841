"""Named queries of retrieval and upkeep: archives written and read, caches, downloads, indexes replaced in place, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captrail.operators import audit, counters, hierarchy, index, layout, resolve, search, slices, sql, warc
from captrail.paths import scratch
from captrail.plans.fixtures import ptr, read, requested, spans
from captrail.plans.registry import _BATCH, _DAMAGE, _NEW, _S, _SLICES, SHOWN, _members, _ptr, _sub, query
from captrail.sources import archives, cache, cdxj, download, fetch, footers, shipping
from captrail.streaming import ingest


@query(_ptr(f"select requested_url, {_S}, cast(r as int) as \"rank\" from (select *, row_number() over (partition by requested_url order by {_NEW}) r from hits) where r <= 2", _BATCH))
def url_batch_early_stop(s, d):
    """The two newest captures of each URL, from a layout that is read from its newest folder on."""
    path = f"{scratch(s)}/sorted"
    layout.write_sorted(ptr(s, d), path, 4)
    return resolve.url_top_by_folder(s, path, requested(s, d), 2).select("requested_url", *SHOWN, "rank")


# Archives of pages

_PLACES = """m as (select page_id, concat('a', cast(page_id % 7 as varchar), '.bin') w, coalesce(octet_length(encode(html)), 0)::bigint l, html from pages),
    a as (select *, coalesce(sum(l) over (partition by w order by page_id rows between unbounded preceding and 1 preceding), 0)::bigint o from m)"""


def _pages(s, d) -> tuple[str, DataFrame]:
    """The pages as they are, in seven archives: their folder, and where each is."""
    base = scratch(s)
    raw = read(s, d, "pages").select("page_id", F.concat(F.lit("a"), (F.col("page_id") % 7).cast("string"), F.lit(".bin")).alias("w"), F.encode("html", "UTF-8").alias("bytes"))
    archives.write_archives(raw, f"{base}/files", "w").write.parquet(f"{base}/listing")
    return f"{base}/files", s.read.parquet(f"{base}/listing").select("page_id", "w", F.col("warc_offset").alias("o"), F.col("warc_length").alias("l"))


def _records(s, d) -> tuple[str, DataFrame]:
    """The pages as gzip members with HTTP responses, some lost or damaged, in seven archives: their folder, and the listing's."""
    base = scratch(s)
    name = F.concat(F.lit("crawl/w"), (F.col("page_id") % 7).cast("string"), F.lit(".warc.gz"))
    archives.write_archives(_members(s, d).withColumn("warc_filename", name), f"{base}/files").write.parquet(f"{base}/places")
    listing = s.read.parquet(f"{base}/places")
    archives.sorted_listing(listing, f"{base}/listing", 4)
    return f"{base}/files", s.read.parquet(f"{base}/listing")


@query(f"with {_PLACES} select page_id, w, o, l, sha256(coalesce(html, '')) sha256 from a")
def archive_places(s, d):
    """Members of archives as written, read again by range at the places that the writer told."""
    files, places = _pages(s, d)
    got = fetch.fetch_members(places.filter("l > 0"), fetch.store_range(files), 8, check=False)
    some = places.join(got.select("w", "o", "l", "bytes"), ["w", "o", "l"], "left")
    return some.select("page_id", "w", "o", "l", F.sha2(F.coalesce("bytes", F.lit("").cast("binary")), 256).alias("sha256"))


@query(f"""with {_PLACES}, f as (select *, case when o - max(o + l - 1) over (partition by w order by o, l rows between unbounded preceding and 1 preceding) - 1 > 4000 then 1 else 0 end nw from a where page_id % 3 = 0 and l > 0),
    i as (select *, sum(nw) over (partition by w order by o, l rows unbounded preceding) isle from f), c as (select w, min(o) s, max(o + l) e from i group by w, isle)
    select page_id, w, o, l, sha256(html) sha256, case when exists (select 1 from c where c.w = a.w and c.s <= a.o and a.o + a.l <= c.e) then 'cached' else 'fetched' end how from a where l > 0""")
def range_cache(s, d):
    """All pages fetched through a cache that a batch of a third of them has filled: what its slices cover is not fetched again."""
    files, places = _pages(s, d)
    store = f"{scratch(s)}/cache"
    through = lambda rows: cache.fetch_through(rows, fetch.store_range(files), store, 8, max_gap=4000, max_slice=1 << 40)
    through(places.filter("page_id % 3 = 0"))
    got = through(places)
    return places.join(got, ["w", "o", "l"]).select("page_id", "w", "o", "l", F.sha2("bytes", 256).alias("sha256"), "how")


@query(f"select page_id, 1::bigint copies, case when e = 'empty input' then 'missing' when e is not null then 'failed' else 'ok' end state from (select *, {_DAMAGE} e from pages)")
def resumed_download(s, d):
    """Records downloaded in three batches by a run that ends after one and a second one; damaged ones fail in both."""
    files, places = _records(s, d)
    target = f"{scratch(s)}/members"
    want = places.select("page_id", F.col("warc_filename").alias("w"), F.col("warc_offset").alias("o"), F.col("warc_length").alias("l"))
    for stop in (1, None):
        download.download(want, fetch.store_range(files), target, batches=3, tasks=4, stop_after=stop)
    rows = download.downloaded(s, target).groupBy("w", "o", "l").agg(F.count_if(F.col("how") != "failed").alias("copies"), F.count("*").alias("tries"))
    state = want.join(download.verified(want, target), ["w", "o", "l"]).join(rows, ["w", "o", "l"], "left")
    return state.select("page_id", F.when(F.col("state") == "ok", F.col("copies")).otherwise(F.lit(1)).alias("copies"), "state")


@query(f"""select page_id, e is null ok, case when e is null then 200 end http_status, case when e is null then 'text/html' end body_mime, e is null body_is_html,
    case when e is null and length(html) > 0 then cast(least(80000, length(html)) as int) end n, e error from (select *, {_DAMAGE} e from pages)""")
def archive_source(s, d):
    """Records read by the data source, with the pages that the listing names."""
    files, listing = _records(s, d)
    archives.register(s)
    path = listing.inputFiles()[0].rsplit("/", 1)[0]
    columns = "warc_filename string, warc_offset long, warc_length long, ok boolean, http_status int, body_text_preview string, body_is_html boolean, body_mime string, error string"
    got = s.read.format("archive").schema(columns).option("path", files).option("listing", path).load()
    # Lost members have length 0 and share their place with what follows: the length tells them apart, and the rank equal ones.
    at = ["warc_filename", "warc_offset", "warc_length"]
    return listing.join(got.dropDuplicates(at), at).select("page_id", "ok", "http_status", "body_mime", "body_is_html", F.length("body_text_preview").alias("n"), "error")


@query(_SLICES + """, z as (select w, slice_start, slice_end - slice_start + 1 b, md5(concat(w, ':', slice_start)) k from sl),
    t as (select *, coalesce(sum(b) over (order by k rows between unbounded preceding and 1 preceding), 0) before, sum(b) over () every from z)
    select cast(least(15, ((2 * before + b) * 16) // (2 * every)) as int) task, count(*) slices, sum(b)::bigint bytes from t group by 1""")
def fetch_balance(s, d):
    """Slices of very unequal lengths dealt to sixteen tasks by their bytes."""
    plan = fetch.balanced(slices.slice_plan(spans(s, d), 512, 4096), 16)
    return plan.groupBy("task").agg(F.count("*").alias("slices"), F.sum(F.col("slice_end") - F.col("slice_start") + 1).alias("bytes"))


# Index upkeep and searches from the top

@query(_ptr("select collection, shard_file, host_rev, min(host) host, split_part(collection, '-', 3) as \"year\" from ptr group by collection, shard_file, host_rev"))
def index_in_place(s, d):
    """An index table whose second part replaces the shards that it repeats, twice, while the others stay."""
    p, path = ptr(s, d), f"{scratch(s)}/index"
    first = p.filter("shard_file in ('cdx-00000.gz', 'cdx-00001.gz')").withColumn("host", F.when(F.col("shard_file") == "cdx-00001.gz", F.lit("stale")).otherwise(F.col("host")))
    index.write_by_shard(index.domain_shards(first), path)
    for _ in range(2):
        index.refresh_in_place(path, p.filter("shard_file <> 'cdx-00000.gz'"))
    return s.read.parquet(path).select("collection", "shard_file", "host_rev", "host", "year")


@query(_ptr(f"select {_S} from ptr where {_sub('org,example')} and collection like 'CC-MAIN-2024-%'"))
def hierarchy_search(s, d):
    """A subtree of a year from the master registry down to the rows of the shards that hold it."""
    path = f"{scratch(s)}/levels"
    hierarchy.build(ptr(s, d), path, 4)
    return hierarchy.find(s, path, "example.org", year="2024").select(SHOWN)


@query(_ptr("select year, count(*) shards from (select distinct split_part(collection, '-', 3) as year, collection, shard_file from ptr where host_rev = 'org,example,therwh') group by year"))
def hierarchy_shards(s, d):
    """The shards of one host by year, through the registries."""
    path = f"{scratch(s)}/levels"
    hierarchy.build(ptr(s, d), path, 4)
    return hierarchy.shards_of(s, path, "therwh.example.org").groupBy("year").agg(F.count("*").alias("shards"))


@query(_ptr("select collection, concat('cdx-0000', cast(page_id % 4 as varchar)) shard_file, ts, url, host_rev, status, warc_offset from ptr where page_id % 4 <> 1 or status = 200"))
def changed_files_stream(s, d):
    """Listings ingested by a stream of fingerprints; then one file of each collection loses lines and is replaced, once."""
    base = scratch(s)
    p = ptr(s, d).withColumn("kept", (F.col("page_id") % 4 != 1) | (F.col("status") == 200))
    named = lambda rows: cdxj.to_cdxj(rows.withColumn("shard_file", F.concat_ws("|", "page_id", F.concat("collection", F.lit("/cdx-0000"), (F.col("page_id") % 4).cast("string"))))).select(
        F.split_part("shard_file", F.lit("|"), F.lit(1)).cast("long").alias("page_id"), F.split_part("shard_file", F.lit("|"), F.lit(2)).alias("file"), F.encode(F.concat("value", F.lit("\n")), "UTF-8").alias("bytes"))
    for rows in (p, p.filter("page_id % 4 = 1 and kept")):
        archives.write_archives(named(rows), f"{base}/in", "file").write.format("noop").mode("overwrite").save()
        ingest.announce_changes(s, f"{base}/in", f"{base}/state", f"{base}/queue")
        ingest.replace_changed(s, f"{base}/queue", f"{base}/out", f"{base}/state", f"{base}/checkpoint")
    return s.read.parquet(f"{base}/out").select("collection", "shard_file", "ts", "url", "host_rev", "status", "warc_offset")


# Open listings, SQL functions, counters

@query(_ptr("select page_id, case when page_id % 4 <> 0 then url end url, case when page_id % 4 <> 0 then page_id * 3 end depth, case when page_id % 4 <> 0 then 'gone' end why, 'object' kind from ptr"))
def open_listing(s, d):
    """Lines with keys outside the fixed schema, which stay; every fourth has bad JSON, which counts as an empty object."""
    p = ptr(s, d)
    extra = F.when(F.col("page_id") % 4 == 0, F.lit("{bad")).otherwise(F.concat(F.lit('{"url": "'), "url", F.lit('", "x-depth": '), (F.col("page_id") * 3).cast("string"), F.lit(', "nested": {"why": "gone"}}')))
    lines = p.select(F.col("page_id").cast("string").alias("shard_file"), F.concat_ws(" ", "host_rev", "ts", extra).alias("value"))
    got = cdxj.parse_cdxj(lines, require_url=False, keep_meta=True)
    kind = F.when(F.schema_of_variant("meta").startswith("OBJECT"), "object")
    return got.select(F.col("shard_file").cast("long").alias("page_id"), "url", cdxj.meta_value("x-depth", "long").alias("depth"), F.try_variant_get("meta", "$.nested.why", "string").alias("why"), kind.alias("kind"))


@query(_ptr(f"select {_S} from ptr where {_sub('com,example')} and ts between '20240105' and '20240120' and status = 200"))
def sql_functions(s, d):
    """A search by a table function over a view, with further conditions."""
    p = ptr(s, d)
    sql.create_views(p)
    sql.create_functions(s, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in p.schema.fields))
    return s.sql(f"select {_S} from captures_between('https://www.Example.com/x', '20240105', '20240120') where status = 200")


@query(_ptr("""select 'matched' point, 'bytes' counter, sum(warc_length)::bigint as "value" from ptr where starts_with(host_rev, 'com,example') and (host_rev = 'com,example' or starts_with(host_rev, 'com,example,'))
    union all select 'matched', 'n', count(*) from ptr where host_rev = 'com,example' or starts_with(host_rev, 'com,example,') union all select 'scanned', 'n', count(*) from ptr
    union all select 'shown', 'n', count(*) from ptr where (host_rev = 'com,example' or starts_with(host_rev, 'com,example,')) and status = 200"""))
def query_counters(s, d):
    """The counters that a search logged while its result was written."""
    base = scratch(s)

    def plan(c: counters.Counters) -> DataFrame:
        found = c.at(search.domain_search(c.at(ptr(s, d), "scanned"), "example.com"), "matched", bytes=F.sum("warc_length"))
        return c.at(search.result_filter(found, status="200"), "shown")

    counters.run_counted("domain_search", f"{base}/events", plan, lambda df: df.write.parquet(f"{base}/out"))
    return counters.events(s, f"{base}/events").select("point", "counter", "value")


# Shards from elsewhere

@query(_ptr("select collection, page_id, url, status from ptr"))
def remote_shards(s, d):
    """Parquet shards behind a backend that only knows sizes and ranges, copied whole and read; a second run copies nothing."""
    base = scratch(s)
    ptr(s, d).repartition(3, "collection").write.parquet(f"{base}/there")
    names = s.createDataFrame([(p.rsplit("/", 1)[1],) for p in s.read.parquet(f"{base}/there").inputFiles()], "path string")
    for _ in range(2):
        got = shipping.read_remote(s, names, fetch.patient(fetch.store_range(f"{base}/there"), 3, 0.0), fetch.store_size(f"{base}/there"), f"{base}/here", 3)
    return got.select("collection", "page_id", "url", "status")


@query("select page_id, concat('p', cast(page_id as varchar), '.html') member, coalesce(octet_length(encode(html)), 0)::bigint n_bytes, sha256(coalesce(html, '')) sha256 from pages where page_id % 5 <> 2")
def tar_members(s, d):
    """Pages in three tar files, extracted but for those of another ending."""
    base = scratch(s)
    archives.write_archives(_tarred(s, d), f"{base}/tars", "tar").write.format("noop").mode("overwrite").save()
    shipping.untar(s, f"{base}/tars/*.tar", f"{base}/out", ".html").write.parquet(f"{base}/done")
    done = s.read.parquet(f"{base}/done")
    files = s.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base}/out").select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.sha2("content", 256).alias("sha256"))
    d = done.select(F.regexp_extract("member", "([^/]+)$", 1).alias("name"), "n_bytes").join(files, "name")
    return d.select(F.regexp_extract("name", "[0-9]+", 0).cast("long").alias("page_id"), F.col("name").alias("member"), "n_bytes", "sha256")


def _tarred(s, d) -> DataFrame:
    import tarfile

    import pyarrow as pa

    def run(batches):
        for b in batches:
            blocks = []
            for page, html in zip(b.column("page_id").to_pylist(), b.column("html").to_pylist(), strict=True):
                body = (html or "").encode()
                info = tarfile.TarInfo(f"dir/p{page}.{'txt' if page % 5 == 2 else 'html'}")
                info.size = len(body)
                blocks.append(info.tobuf() + body + bytes(-len(body) % 512))
            yield pa.RecordBatch.from_arrays([b.column("tar"), b.column("page_id"), pa.array(blocks, pa.binary())], names=["tar", "page_id", "bytes"])

    pages = read(s, d, "pages").select(F.concat(F.lit("t"), (F.col("page_id") % 3).cast("string"), F.lit(".tar")).alias("tar"), "page_id", "html")
    return pages.mapInArrow(run, "tar string, page_id long, bytes binary")


@query(_ptr("select distinct collection, split_part(collection, '-', 3) as \"year\", case when collection = 'CC-MAIN-2025-05' then 'flat' else 'by year' end layout from ptr"))
def templated_discovery(s, d):
    """Shards under two path templates, of which a collection's first that names any counts."""
    base, p = scratch(s), ptr(s, d)
    p.filter("collection <> 'CC-MAIN-2025-05'").withColumn("year", F.split_part("collection", F.lit("-"), F.lit(3))).write.partitionBy("year", "collection").parquet(f"{base}/a")
    p.write.partitionBy("collection").parquet(f"{base}/b")
    found = shipping.discover_by_templates(s, [f"{base}/a/year={{year}}/collection={{collection}}/*.parquet", f"{base}/b/collection={{collection}}/*.parquet"], p.select("collection"))
    return found.select("collection", "year", F.when(F.col("path").contains("/a/year="), "by year").otherwise("flat").alias("layout")).distinct()


@query(f"""select page_id, case when e is null then md5(left(concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), chr(13), chr(10), 'HTTP/1.1 200 OK', chr(13), chr(10), 'Content-Type: text/html; charset=utf-8', chr(13), chr(10), chr(13), chr(10), coalesce(html, '')), 200)) end preview
    from (select *, {_DAMAGE} e from pages)""")
def raw_preview(s, d):
    """The unpacked beginning of each member; lost and damaged ones have none."""
    out = warc.described(_members(s, d), max_preview=1 << 30)
    return out.select("page_id", F.md5(F.left("text_preview", F.lit(200))).alias("preview"))


@query("""with g as (select concat('f', cast(o_custkey % 60 as varchar)) path, (o_orderkey % (3 + o_custkey % 11) + 1)::bigint * 1048576 b from orders), m as (select path, median(b) / 1048576 mb from g group by path)
    select path, mb median_mb, case when abs(mb - 4.0) > 1.0 then 'row_group_size' else '' end reasons from m""")
def audit_target_mb(s, d):
    """Row groups judged by their bytes: a file's median is to be within a quarter of four megabytes."""
    o = read(s, d, "orders")
    size = ((F.col("o_orderkey") % (3 + F.col("o_custkey") % 11) + 1) * 1048576).cast("long")
    groups = o.select(F.concat(F.lit("f"), (F.col("o_custkey") % 60).cast("string")).alias("path"), F.col("o_orderkey").alias("row_group"), F.lit(1).cast("long").alias("num_rows"), size.alias("total_bytes"),
                      F.lit("a").alias("min_value"), F.lit("a").alias("max_value"), F.array(F.lit("zstd")).alias("codecs"), F.array(F.lit("url")).alias("columns"))
    judged = audit.audit_reasons(footers.shard_summary(groups, ["url"]), target_mb=4.0)
    return judged.select("path", "median_mb", F.array_join("reasons", ",").alias("reasons"))
