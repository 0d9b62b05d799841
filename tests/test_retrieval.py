"""Early stops, caches, downloads that resume, tables replaced in place, pruned searches, the archive source, SQL functions."""

import gzip
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from captrail.operators import counters, hierarchy, index, layout, resolve, search, sql
from captrail.sources import archives, cache, cdxj, download, fetch, footers, shipping
from captrail.streaming import ingest

SPANS = "w string, o long, l long"


def captures(spark, n=600):
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("CC-MAIN-"), (2022 + i % 4).cast("string"), F.lit("-10")).alias("collection"), F.concat(F.lit("cdx-0000"), (i % 3).cast("string"), F.lit(".gz")).alias("shard_file"),
        F.concat(F.lit("20240101"), F.lpad(i.cast("string"), 6, "0")).alias("ts"), F.concat(F.lit("http://h"), (i % 7).cast("string"), F.lit(".com/"), (i % 50).cast("string")).alias("url"),
        F.concat(F.lit("h"), (i % 7).cast("string"), F.lit(".com")).alias("host"), F.concat(F.lit("com,h"), (i % 7).cast("string")).alias("host_rev"), F.lit(200).alias("status"), F.lit("text/html").alias("mime"),
        F.lit("x").alias("digest"), F.concat(F.lit("w"), (i % 5).cast("string")).alias("warc_filename"), (i * 100).alias("warc_offset"), F.lit(50).cast("long").alias("warc_length"),
    )


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def spoil(folder):
    """Files that are listed but cannot be read."""
    for p in Path(folder).rglob("*.parquet"):
        p.write_bytes(b"no parquet")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("folders", [1, 3])
def test_early_stop(spark, tmp_path, folders):
    p, path = captures(spark), str(tmp_path / "t")
    layout.write_sorted(p, path, 4)
    wanted = p.select(F.col("url").alias("requested_url")).union(spark.createDataFrame([("http://none.org/",)], "requested_url string"))
    cols = ("requested_url", "collection", "ts", "url", "warc_filename", "warc_offset", "rank")
    for k in (1, 2, 5):
        assert rows(resolve.url_top_by_folder(spark, path, wanted, k, folders=folders), *cols) == rows(resolve.url_top(p, wanted, k), *cols)
    # URLs of the newest collection alone: once they have their captures, older folders are neither listed nor read.
    newest = p.filter("collection = 'CC-MAIN-2025-10'").select(F.col("url").alias("requested_url"))
    want = rows(resolve.url_top(p, newest, 1), *cols)
    for year in ("2022", "2023", "2024")[: 4 - folders]:
        spoil(f"{path}/year={year}")
    assert rows(resolve.url_top_by_folder(spark, path, newest, 1, folders=folders), *cols) == want
    assert resolve.url_top_by_folder(spark, str(tmp_path / "nothing"), newest, 1).count() == 0
    with pytest.raises(ValueError):
        resolve.url_top_by_folder(spark, path, newest, 0)


def logged(blob, calls):
    """A backend over one blob that leaves a file for each call."""

    def get(name, start, end):
        import uuid

        Path(calls, f"{name}-{start}-{end}-{uuid.uuid4().hex}").touch()
        if name == "gone":
            raise OSError("status 404")
        return blob[start : end + 1]

    return get


def calls_of(folder):
    return sorted(tuple(x.split("-")[:3]) for x in os.listdir(folder))


def test_range_cache(spark, tmp_path):
    blob, log = bytes(range(256)) * 40, tmp_path / "calls"
    log.mkdir()
    get, at = logged(blob, str(log)), str(tmp_path / "cache")
    first = spark.createDataFrame([("a", 0, 100), ("a", 150, 50), ("a", 5000, 10), ("gone", 0, 5)], SPANS)
    got = {(r.w, r.o, r.l): r for r in cache.fetch_through(first, get, at, 2, max_gap=60, max_slice=1000).collect()}
    assert {r.how for k, r in got.items() if k[0] == "a"} == {"fetched"} and got["gone", 0, 5].how == "failed"
    assert calls_of(log) == [("a", "0", "199"), ("a", "5000", "5009"), ("gone", "0", "4")]
    # The gap between two members came along; ranges that reach beyond are fetched. Equal bytes are kept once.
    second = spark.createDataFrame([("a", 110, 20), ("a", 0, 200), ("a", 190, 20), ("a", 5120, 10), ("a", 5000, 10), ("a", 5000, 10), ("a", -1, 4), ("a", 9, 0)], SPANS)
    before = len(calls_of(log))
    got = {(r.w, r.o, r.l): r for r in cache.fetch_through(second, get, at, 2, max_gap=0, max_slice=1000).collect()}
    assert {k[1:]: r.how for k, r in got.items()} == {(110, 20): "cached", (0, 200): "cached", (190, 20): "fetched", (5120, 10): "fetched", (5000, 10): "cached"}
    assert len(calls_of(log)) == before + 2
    assert all(bytes(r.bytes) == blob[o : o + n] for (_, o, n), r in got.items())
    third = spark.createDataFrame([("b", 5000 % 256, 10)], SPANS)
    cache.fetch_through(third, get, at, 2)
    assert spark.read.parquet(f"{at}/ranges").count() == 5 and spark.read.parquet(f"{at}/blobs").count() == 4
    assert cache.fetch_through(third.limit(0), get, at, 2).count() == 0


def test_covering_is_containment(spark):
    import random

    rng = random.Random(5)
    want = {("w", rng.randrange(400), rng.randrange(1, 60)) for _ in range(60)}
    have = [("w", s := rng.randrange(400), s + rng.randrange(90), f"k{i}") for i in range(25)]
    got = {(r.w, r.o, r.l): (r.s, r.key) for r in cache.covering(spark.createDataFrame(sorted(want), SPANS), spark.createDataFrame(have, cache.RANGES), cell=16).collect()}
    for w, o, n in want:
        fits = sorted((e - s, s, k) for _, s, e, k in have if s <= o and o + n - 1 <= e)
        assert got.get((w, o, n)) == (fits[0][1:] if fits else None)


def member(k):
    return gzip.compress(b"WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\nbody %d" % k, mtime=0)


def test_download_resumes(spark, tmp_path):
    blob, places = b"", []
    for k in range(12):
        places.append(("a", len(blob), len(member(k))))
        blob += member(k) + bytes(100_000_000 if k % 4 == 3 and k < 8 else 300)
    log, target = tmp_path / "calls", str(tmp_path / "members")
    log.mkdir()
    want = spark.createDataFrame([*places, ("gone", 0, 5), places[0]], SPANS)

    def get(name, start, end):
        import uuid

        Path(str(log), f"{name}-{start}-{end}-{uuid.uuid4().hex}").touch()
        if name == "gone":
            raise OSError("status 404")
        return big.value[start : end + 1]

    big = spark.sparkContext.broadcast(blob)
    assert download.download(want, get, target, batches=4, tasks=2, max_gap=0, stop_after=1) == 1
    states = {(r.w, r.o): r.state for r in download.verified(want, target).collect()}
    assert 0 < sum(s == "missing" for s in states.values()) < len(states)
    download.download(want, get, target, batches=4, tasks=2, max_gap=0)
    asked = calls_of(log)
    assert all(sum(c == ("a", str(o), str(o + n - 1)) for c in asked) == 1 for _, o, n in places)
    download.download(want, get, target, batches=4, tasks=2, max_gap=0)  # only what failed is tried again
    assert {c[0] for c in calls_of(log)[len([c for c in asked if c[0] == "a"]) :]} == {"gone"}
    states = {(r.w, r.o): r.state for r in download.verified(want, target).collect()}
    assert states == {(w, o): "ok" for w, o, _ in places} | {("gone", 0): "failed"}
    # Damage behind its back is told.
    d = download.downloaded(spark, target).filter("w = 'a'").withColumn("bytes", F.when(F.col("o") == 0, F.lit(b"x")).otherwise(F.concat("bytes", F.lit(b"").cast("binary"))))
    d.write.partitionBy("batch").parquet(str(tmp_path / "bad"))
    assert {r.state for r in download.verified(want, str(tmp_path / "bad")).collect()} == {"ok", "length", "missing"}
    plan = download.planned_bytes(want, 0, 1000).first()
    assert plan.members == 13 and plan.wanted_bytes == sum(n for *_, n in places) + 5 == plan.read_bytes


def test_refresh_in_place(spark, tmp_path):
    p, path = captures(spark), str(tmp_path / "index")
    index.write_by_shard(index.domain_shards(p), path)
    files = lambda: {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    before = files()
    some = p.filter("shard_file = 'cdx-00001.gz' and collection = 'CC-MAIN-2023-10'").withColumn("host", F.lit("new"))
    want = rows(index.refreshed(index.domain_shards(p), some), "collection", "shard_file", "host_rev", "host", "year")
    for _ in range(2):
        index.refresh_in_place(path, some)
        after = files()
        assert rows(spark.read.parquet(path).withColumn("year", F.col("year").cast("string")), "collection", "shard_file", "host_rev", "host", "year") == want
        touched = "collection=CC-MAIN-2023-10/shard_file=cdx-00001.gz/"
        assert {k: v for k, v in before.items() if not k.startswith(touched)} == {k: v for k, v in after.items() if not k.startswith(touched)}
    nameless = p.filter("collection = 'CC-MAIN-2024-10' and shard_file = 'cdx-00000.gz'").withColumn("host_rev", F.lit(None).cast("string"))
    index.refresh_in_place(path, nameless)
    assert spark.read.parquet(path).filter("collection = 'CC-MAIN-2024-10' and shard_file = 'cdx-00000.gz'").count() == 0
    index.refresh_in_place(path, some, gone=p.filter("collection = 'CC-MAIN-2022-10'"))
    assert "CC-MAIN-2022-10" not in {r.collection for r in spark.read.parquet(path).select("collection").distinct().collect()}


def test_hierarchy_prunes(spark, tmp_path):
    # Hosts of their own for each collection and shard, so that a search needs few folders.
    i = F.col("warc_offset") / 100
    p = captures(spark).withColumn("host_rev", F.concat(F.lit("com,s"), (i % 12).cast("int").cast("string"), F.lit(",a")))
    path = str(tmp_path / "levels")
    hierarchy.build(p, path, 3)
    found = hierarchy.find(spark, path, "s5.com")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "StringStartsWith(host_rev,com,s5,)" in plan
    want = p.filter("host_rev = 'com,s5,a'")
    assert rows(found, "url", "ts") == rows(want, "url", "ts")
    assert hierarchy.shards_of(spark, path, "s5.com").count() == 1
    assert hierarchy.find(spark, path, "s5.com", year="1999").count() == 0 and hierarchy.find(spark, path, "", year="2023").count() == 0
    assert rows(hierarchy.find(spark, path, "com", collections=["CC-MAIN-2023-10"]), "url", "ts") == rows(p.filter("collection = 'CC-MAIN-2023-10'"), "url", "ts")
    # Folders that a search does not need are not opened.
    needed = "collection=CC-MAIN-2023-10/shard_file=cdx-00002.gz"
    assert len(list(Path(path, "rows").rglob("shard_file=*"))) == 12
    for folder in Path(path, "rows").rglob("shard_file=*"):
        if not str(folder).endswith(needed):
            spoil(folder)
    assert hierarchy.find(spark, path, "s5.com").count() == want.count()


def test_changed_files(spark, tmp_path):
    root, state, queue, out, check = (str(tmp_path / x) for x in ("in", "state", "queue", "out", "check"))
    at = Path(root, "CC-MAIN-2024-10")
    at.mkdir(parents=True)
    line = lambda k: f'com,a{k})/ 2024010100000{k} {{"url": "http://a{k}.com/", "status": "200"}}\n'
    (at / "cdx-00000").write_text(line(1) + line(2))
    (at / "cdx-00001").write_text(line(3))

    def step():
        n = ingest.announce_changes(spark, root, state, queue)
        if n:
            ingest.replace_changed(spark, queue, out, state, check)
        return n, rows(spark.read.parquet(out), "shard_file", "url")

    assert step() == (2, [("cdx-00000", "http://a1.com/"), ("cdx-00000", "http://a2.com/"), ("cdx-00001", "http://a3.com/")])
    assert step()[0] == 0
    kept = {f: f.stat().st_mtime_ns for f in Path(out).rglob("shard_file=cdx-00001/*.parquet")}
    (at / "cdx-00000").write_text(line(4) + line(5) + line(6))
    n, after = step()
    assert n == 1 and after == [("cdx-00000", f"http://a{k}.com/") for k in (4, 5, 6)] + [("cdx-00001", "http://a3.com/")]
    assert kept == {f: f.stat().st_mtime_ns for f in Path(out).rglob("shard_file=cdx-00001/*.parquet")}
    # A file that has no line left has no row left.
    (at / "cdx-00002").write_text(line(7))
    assert step()[1][-1] == ("cdx-00002", "http://a7.com/")
    (at / "cdx-00002").write_text("# none\n\n")
    assert step() == (1, after)
    # A batch whose commit was lost runs again: the table and the state stay as they are.
    last = max((int(p.name) for p in Path(check, "commits").iterdir() if p.name.isdigit()))
    for p in Path(check, "commits").glob(f"*{last}*"):
        p.unlink()
    ingest.replace_changed(spark, queue, out, state, check)
    assert rows(spark.read.parquet(out), "shard_file", "url") == after and step()[0] == 0


def test_archive_source(spark, tmp_path):
    blobs = [member(0), member(1)[1:], member(2), None, member(4)]
    d = spark.createDataFrame([(f"c/w{k % 2}.gz", k, b) for k, b in enumerate(blobs)], "warc_filename string, page_id long, bytes binary")
    archives.write_archives(d, str(tmp_path / "files")).write.parquet(str(tmp_path / "places"))
    places = spark.read.parquet(str(tmp_path / "places")).drop("page_id")
    extra = spark.createDataFrame([("c/none.gz", 0, 10), ("c/w0.gz", 10**6, 10), (None, 0, 5), ("c/w1.gz", None, 5), ("c/w1.gz", -3, 5)], "warc_filename string, warc_offset long, warc_length long")
    archives.sorted_listing(places.union(extra), str(tmp_path / "listing"), 3)
    archives.register(spark)
    source = lambda **o: spark.read.format("archive").option("path", str(tmp_path / "files")).option("listing", str(tmp_path / "listing")).options(**o)
    for options in ({}, {"gap": "0", "slice": "1"}):
        got = {(r.warc_filename, r.warc_offset, r.warc_length): r for r in source(**options).load().collect()}
        assert len(got) == 10
        ok = sorted(r.body_text_preview for r in got.values() if r.ok)
        assert ok == ["body 0", "body 2", "body 4"] and all(bytes(r.bytes) in (member(0), member(2), member(4)) for r in got.values() if r.ok)
        faults = sorted(r.error.split(":")[0] for r in got.values() if not r.ok)
        assert faults == ["FileNotFoundError", "bad place", "bad place", "bad place", "empty input", "gzip_decompress_failed", "short read"]
    one = source().load().filter("warc_filename = 'c/w1.gz' and ok is not null")
    assert one.count() == 4
    reader = archives.ArchiveReader(str(tmp_path / "files"), str(tmp_path / "listing"), source().load().schema, 0, 1)
    every = len(reader.partitions())
    assert list(reader.pushFilters([archives.EqualTo(("warc_filename",), "zzz")])) == [] and len(reader.partitions()) == 0 < every
    # Without bytes and record nothing is fetched: the archives may be gone.
    for f in Path(tmp_path, "files", "c").iterdir():
        f.unlink()
    assert source().schema("warc_offset long, warc_filename string").load().count() == 10


def test_balanced(spark):
    plan = spark.range(3000).select(F.concat(F.lit("w"), (F.col("id") % 5).cast("string")).alias("w"), (F.col("id") * 10**6).alias("slice_start"), (F.col("id") * 10**6 + F.pmod(F.xxhash64("id"), F.lit(40)) ** 3).cast("long").alias("slice_end"))
    dealt = fetch.balanced(plan, 12)
    per = [r.n for r in dealt.groupBy("task").agg(F.sum(F.col("slice_end") - F.col("slice_start") + 1).alias("n")).collect()]
    assert len(per) == 12 and max(per) <= max(1.2 * sum(per) / 12, 40**3) and dealt.columns == [*plan.columns, "task"]
    assert dealt.groupBy("task").agg(F.countDistinct("w").alias("n")).agg(F.min("n")).first()[0] == 5
    whale = spark.createDataFrame([("w", 0, 10**9), ("w", 2 * 10**9, 2 * 10**9 + 5)], "w string, slice_start long, slice_end long")
    assert fetch.balanced(whale, 4).count() == 2 and fetch.balanced(whale.limit(0), 4).count() == 0


def test_whole_files(tmp_path):
    (tmp_path / "a.gz").write_bytes(bytes(range(100)))
    kept = str(tmp_path / "kept")
    get = fetch.whole_files(str(tmp_path), kept)
    assert get("a.gz", 10, 12) == bytes([10, 11, 12]) and len(os.listdir(kept)) == 1
    (tmp_path / "a.gz").write_bytes(bytes(100))
    assert get("a.gz", 10, 12) == bytes([10, 11, 12])  # same size: the copy serves
    with pytest.raises(ValueError):
        fetch.whole_files(str(tmp_path), kept, most=10)("a.gz", 0, 1)
    with pytest.raises(ValueError):
        get("none.gz", 0, 1)
    assert fetch.store_size(str(tmp_path))("a.gz") == 100 and fetch.store_size(str(tmp_path))("none.gz") is None
    with pytest.raises(OSError):
        fetch.store_range(str(tmp_path))("a.gz", 90, 100)


def test_functions_push_filters(spark, tmp_path):
    captures(spark).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    assert sql.create_views(t, "seen") == ["seen", "seen_by_collection", "seen_by_year"]
    sql.create_functions(spark, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.schema.fields), "seen")
    for domain in ("https://www.H3.com/x?y", "h3.com", "com", "", "..", "none.org"):
        got = spark.sql(f"select url, ts from captures_of('{domain}')")
        assert rows(got, "url", "ts") == rows(search.domain_search(t, domain), "url", "ts")
    plan = spark.sql("select url from captures_of('h3.com') where status = 200")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(host_rev,com,h3,)" in plan and "EqualTo(stat" in plan and "mime" not in plan
    assert spark.sql("select sum(total_rows) n from seen_by_year").first().n == 600
    assert spark.sql("select count(*) n from url_captures('http://h1.com/1')").first().n == t.filter("startswith(url, 'http://h1.com/1')").count()


def test_counters(spark, tmp_path):
    folder = str(tmp_path / "events")
    t = captures(spark)

    def plan(c):
        return c.at(search.domain_search(c.at(t, "scanned"), "h3.com"), "matched", bytes=F.sum("warc_length"))

    for k in range(2):
        event = counters.run_counted(f"q{k}", folder, plan, lambda df: df.write.format("noop").mode("overwrite").save())
        assert event["counts"] == {"scanned": {"n": 600}, "matched": {"n": 86, "bytes": 4300}}
    assert len(os.listdir(folder)) == 2
    assert rows(counters.events(spark, folder), "name", "point", "counter", "value")[:3] == [("q0", "matched", "bytes", 4300), ("q0", "matched", "n", 86), ("q0", "scanned", "n", 600)]


def test_open_json(spark):
    lines = ['a 1 {"url": "u", "x.y": 5, "deep": {"k": [1, 2]}}', "b 2 {bad", "c 3", "d 4 http://d/ {}", 'e 5 {"url": "u", "x.y": "t"}']
    d = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.surt: r for r in cdxj.parse_cdxj(d, require_url=False, keep_meta=True).select("surt", "url", cdxj.meta_value("x.y", "long").alias("x"), F.to_json("meta").alias("j"), F.try_variant_get("meta", "$.deep.k[1]", "int").alias("k")).collect()}
    assert (got["a"].x, got["a"].k, got["a"].url) == (5, 2, "u") and got["e"].x is None and [got[s].j for s in "bcd"] == ["{}"] * 3
    assert "meta" not in cdxj.parse_cdxj(d).columns


def test_remote_parquet_over_http(spark, tmp_path):
    """Shards behind a server of ranges that fails at first, by HEAD and GET, into the shared folder; once each."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    captures(spark).repartition(2).write.parquet(str(tmp_path / "there"))
    asked = []

    class Server(BaseHTTPRequestHandler):
        def do_HEAD(self):  # noqa: N802
            data = Path(str(tmp_path / "there") + self.path).read_bytes()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()

        def do_GET(self):  # noqa: N802
            asked.append(self.path)
            if asked.count(self.path) == 1:
                self.send_error(503)
                return
            data = Path(str(tmp_path / "there") + self.path).read_bytes()
            a, b = self.headers["Range"].removeprefix("bytes=").split("-")
            self.send_response(206)
            self.end_headers()
            self.wfile.write(data[int(a) : int(b) + 1])

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        at = f"http://127.0.0.1:{server.server_port}"
        names = [p.name for p in Path(tmp_path, "there").glob("part-*.parquet")]
        files = spark.createDataFrame([(f"{at}/{n}",) for n in names], "path string")
        for _ in range(2):
            got = shipping.read_remote(spark, files, fetch.patient(fetch.http_range(at), 3, 0.01), fetch.http_size(at), str(tmp_path / "here"), 2)
            assert rows(got, "url", "ts") == rows(captures(spark), "url", "ts")
        assert sorted(asked) == sorted(2 * [f"/{n}" for n in names])
        with pytest.raises(OSError):
            shipping.read_remote(spark, files.union(spark.createDataFrame([(f"{at}/none",)], "path string")), fetch.http_range(at), lambda n: None, str(tmp_path / "other"), 2)
    finally:
        server.shutdown()


def test_untar(spark, tmp_path):
    import io
    import tarfile

    for name, mode in (("a.tar", "w"), ("b.tar.gz", "w:gz")):
        with tarfile.open(tmp_path / name, mode) as t:
            for k in range(3):
                info = tarfile.TarInfo(f"../../x/{name[0]}{k}.parquet" if k < 2 else "readme")
                info.size = 1000
                t.addfile(info, io.BytesIO(bytes([k]) * 1000))
            t.addfile(tarfile.TarInfo("link"), None)
    (tmp_path / "c.tar").write_bytes(b"no tar at all" * 100)
    shipping.untar(spark, str(tmp_path / "*.tar*"), str(tmp_path / "out"), ".parquet").write.parquet(str(tmp_path / "done"))
    done = spark.read.parquet(str(tmp_path / "done")).collect()
    assert sorted(r.member for r in done if r.error is None) == ["../../x/a0.parquet", "../../x/a1.parquet", "../../x/b0.parquet", "../../x/b1.parquet"]
    assert sum(r.error is not None for r in done) == 1 and sorted(p.name for p in (tmp_path / "out").rglob("*.parquet")) == ["a0.parquet", "a1.parquet", "b0.parquet", "b1.parquet"]
    assert (tmp_path / "out" / "b.tar.gz" / "b1.parquet").read_bytes() == b"\1" * 1000


def test_caps_over_one_pass(spark):
    """Caps on rows, shards and both agree with a plain version; columns of passing use give way to those of the input."""
    p = captures(spark).withColumns({"_row": F.lit(1), "_file": F.lit("x")})
    want = sorted(p.collect(), key=lambda r: (r.collection, r.ts), reverse=True)

    def plain(files, per, most):
        some = {c: sorted({r.shard_file for r in want if r.collection == c})[: files or None] for c in {r.collection for r in want}}
        out, seen = [], {}
        for r in want:
            k = (r.collection, r.shard_file)
            if r.shard_file in some[r.collection] and (not per or seen.get(k, 0) < per):
                seen[k] = seen.get(k, 0) + 1
                out.append(r.ts)
        return sorted(out[: most or None])

    for files, per, most in ((2, 5, 20), (2, 0, 0), (0, 3, 0), (1, 7, 9), (0, 0, 4), (0, 0, 0)):
        got = search.capped(p, files, per, most)
        assert sorted(r.ts for r in got.collect()) == plain(files, per, most) and got.columns == p.columns


def test_slices_across_batches(spark):
    """Slices do not depend on how ranges fall into batches."""
    import random

    from captrail.operators import slices

    rng = random.Random(7)
    spans = spark.createDataFrame([(rng.choice("abc"), rng.randrange(30_000), rng.randrange(1, 900)) for _ in range(4000)], SPANS)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, found = spark.conf.get(size), []
    try:
        for n in ("3", "64", "100000"):
            spark.conf.set(size, n)
            found.append(rows(slices.slice_plan(spans, 20, 1500), "w", "slice_start", "slice_end", "member_count"))
    finally:
        spark.conf.set(size, before)
    assert found[0] == found[1] == found[2] and len(found[0]) > 30


def test_search_by_zones_of_footers(spark, tmp_path):
    """Shards have row groups of the wanted rows, and a search opens only folders whose zones may hold the key."""
    path = str(tmp_path / "t")
    p = spark.range(74).select(F.lit("C").alias("collection"), F.expr("concat('s', id div 37)").alias("shard_file"), F.expr("concat('com,h', lpad(id div 2, 3, '0'))").alias("host_rev"),
                               F.expr("concat('http://x/', id)").alias("url"), F.lit("t").alias("ts"), F.col("id").alias("warc_offset"))
    p = p.union(p.limit(1).withColumn("host_rev", F.lit(None).cast("string")).withColumn("shard_file", F.lit("s2")))
    layout.write_shards(p.repartition(5), path, 16)
    groups = footers.footers(spark, path)
    per = groups.groupBy("path").agg(F.expr("transform(array_sort(collect_list(struct(row_group, num_rows))), x -> x.num_rows)").alias("n"))
    assert sorted(r.n for r in per.collect()) == [[1], [16, 16, 5], [16, 16, 5]]
    name = lambda c: F.regexp_extract("path", f"{c}=([^/]*)", 1).alias(c)
    zones = index.zones_of_footers(groups).withColumns({c: name(c) for c in ("collection", "shard_file")})
    assert rows(index.boundary_check(zones, ["shard_file"], "row_group"), "shard_file", "ok", "bad") == [("s0", 2, 0), ("s1", 2, 0), ("s2", 0, 0)]
    found = hierarchy.find_by_zones(spark, path, zones, "h030.com")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "EqualTo(host_rev,com,h030)" in plan
    none = hierarchy.find_by_zones(spark, path, zones, "h999.com")
    assert hierarchy.find_by_zones(spark, path, zones, "").count() == 0
    both = rows(hierarchy.find_by_zones(spark, path, zones, "h018.com"), "url", "shard_file")
    assert both == [("http://x/36", "s0"), ("http://x/37", "s1")]
    spoil(f"{path}/collection=C/shard_file=s0")
    spoil(f"{path}/collection=C/shard_file=s2")
    assert rows(found, "url", "shard_file") == [("http://x/60", "s1"), ("http://x/61", "s1")] and none.count() == 0
