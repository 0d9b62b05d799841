"""Slices, runs, records, footers and sources on small inputs and as properties."""

import gzip
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from captrail.operators import aggregates, audit, index, layout, search, slices, warc
from captrail.sources import cdxj, fetch, footers

SPANS = "w string, o long, l long"


def plan(spark, rows, gap, most, least=0):
    p = slices.slice_plan(spark.createDataFrame(rows, SPANS), gap, most, least)
    return sorted((r.w, r.slice_start, r.slice_end, r.member_count) for r in p.collect())


def greedy(rows, gap, most):
    out = []
    for w in sorted({r[0] for r in rows}):
        cur = None
        for _, o, l in sorted({r for r in rows if r[0] == w and r[1] >= 0 and r[2] > 0}):
            e = o + l - 1
            if cur and o - cur[2] - 1 <= gap and (most <= 0 or max(cur[2], e) - cur[1] + 1 <= most):
                cur[2], cur[3] = max(cur[2], e), cur[3] + 1
            else:
                cur = [w, o, e, 1]
                out.append(cur)
    return sorted(map(tuple, out))


def test_pointer_fixture(spark):
    rows = [("a", 100, 10), ("a", 120, 5), ("a", 120, 5), ("b", 50, 7)]
    assert plan(spark, rows, 1000, 1000) == [("a", 100, 124, 2), ("b", 50, 56, 1)]
    assert plan(spark, [("w", 100, 10), ("w", 300, 20), ("w", 800, 5)], 1000, 500) == [("w", 100, 319, 2), ("w", 800, 804, 1)]
    assert plan(spark, [("w", 100, 10)], 10, 500, 200) == [("w", 100, 299, 1)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-2, 300), st.integers(0, 40)), min_size=1, max_size=40), st.integers(0, 30), st.integers(0, 120))
def test_slices_are_greedy(spark, rows, gap, most):
    assert plan(spark, rows, gap, most) == greedy(rows, gap, most)


def test_members_come_back(spark):
    blob = bytes(range(256)) * 8
    rows = [("w", 100, 10), ("w", 300, 20), ("w", 800, 5), ("w", 2040, 100)]
    p = slices.slice_plan(spark.createDataFrame(rows, SPANS), 1000, 500)

    def from_memory(name, start, end):
        return blob[start : end + 1]

    got = fetch.fetch_slices(p, from_memory, 2)
    cut = {(r.o, r.l): r.bytes for r in slices.cut_members(got, slices.slice_members(p)).collect()}
    assert cut[(100, 10)] == blob[100:110] and cut[(300, 20)] == blob[300:320] and cut[(800, 5)] == blob[800:805] and cut[(2040, 100)] is None


def test_coalesce(spark):
    d = spark.createDataFrame([("k", 0, 5), ("k", 5, 7), ("k", 9, 10)], "k string, start long, end long")
    assert sorted((r.start, r.end) for r in slices.coalesce_ranges(d, "k").collect()) == [(0, 7), (9, 10)]


def test_null_splits_runs(spark):
    rows = spark.createDataFrame([("f", i, k) for i, k in enumerate(["a", "a", None, "a", "b"])], "f string, i long, host_rev string")
    assert sorted((r.row_start, r.row_end) for r in index.segments(rows, ["f"], "i").collect()) == [(0, 2), (3, 4), (4, 5)]
    assert sorted((r.host_rev, r.run_len) for r in index.run_lengths(rows, ["f"], "i").select("host_rev", "run_len").collect()) != []


def member(body=b"<html>x</html>", head=b"Content-Type: text/html; charset=utf-8"):
    return gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + body)


def test_records(spark):
    rows = [member(), member(b"5\r\nhello\r\n0\r\n\r\n", b"Content-Type: text/plain\r\nTransfer-Encoding: chunked"), None, b"junk", gzip.compress(b"WARC/1.0\r\n\r\nplain"), gzip.compress(b"none"), gzip.compress(b"WARC/1.0\r\n\r\nHTTP/1.1 200")]
    got = warc.extract(spark.createDataFrame([(i, b) for i, b in enumerate(rows)], "i int, bytes binary"), keep_body=True).select("i", "http.*").toPandas().set_index("i")
    assert got.ok[0] and got.http_status[0] == 200 and got.body_is_html[0] and got.body_mime[0] == "text/html" and got.warc_headers[0]["warc-type"] == "response"
    assert got.body_text_preview[1] == "hello" and not got.body_is_html[1]
    assert list(got.error[2:]) == ["empty input", "gzip_decompress_failed: BadGzipFile", "no_http_payload", "missing_warc_header_separator", "missing_http_header_separator"]
    faults = warc.validate_blobs(spark.createDataFrame([(member(),), (b"WARC/1.0 x",), (b"x",), (None,)], "bytes binary")).collect()
    assert [r.fault for r in faults] == [None, None, "no_warc", "empty"]


def test_dechunk_notes():
    assert warc.dechunk(b"5\r\nhello", 100) == (b"hello", None)
    assert warc.dechunk(b"9\r\nhello", 100) == (b"", "truncated")
    assert warc.dechunk(b"zz\r\nhello", 100)[1] == "bad chunk size"
    assert warc.dechunk(b"5\r\nhello\r\n0\r\n", 3) == (b"hel", "output truncated")
    assert warc.dechunk(b"", 9) == (b"", None) and warc.dechunk(b"5", 9) == (b"", "missing size line") and warc.dechunk(b"2\nab3", 9) == (b"ab", "missing size line")
    assert warc.dechunk(b"\r\n\n 2 ;x=1\nab\n1\r\nc\r\n0\r\nTrailer: 1\r\n\r\n", 9) == (b"abc", None)
    assert warc.dechunk(b"2\r\nab2\r\ncd\r\n", 9) == (b"abcd", None) and warc.dechunk(b"1\r\na\r\n" * 1000 + b"0\r\n\r\n", 10**6) == (b"a" * 1000, None)


def test_names_of_passing_use(spark):
    """Columns of the input may be named like those of passing use."""
    d = spark.createDataFrame([("f", i, k, 1, 2, 3, 4) for i, k in enumerate("aab")], "f string, i long, host_rev string, _new int, _isle int, _n int, _before int")
    assert index.segments(d, ["f"], "i").count() == 2 and index.inversions(d, ["f"], "i", first=2).first().checked == 2
    r = spark.createDataFrame([("k", 0, 5, 1, 1), ("k", 5, 7, 1, 1)], "k string, start long, end long, _new int, _isle int")
    assert slices.coalesce_ranges(r, "k").count() == 1


def test_zone_heads_are_deep(spark):
    """Keys of one top-level domain do not meet all of its zones."""
    names = sorted(f"com,{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh")
    z = spark.createDataFrame([(k, names[k], names[k + 3]) for k in range(0, len(names), 4)], "id int, min_key string, max_key string")
    keys = spark.createDataFrame([(n,) for n in names], "key string")
    found = index.zone_keys(z, keys)
    assert found.count() == len(names)
    met = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in met and index.zone_keys(z, keys, depth=0).count() == len(names)


def test_cdxj_lines(spark):
    lines = ['com,a)/ 20240101000000 {"url": "http://www.a.com/", "status": "200", "offset": "5", "length": "x"}', "# c", "", "com,b)/ 2024 http://b.com/ {bad", "com,c)/ 2024 {}", "com,d)/"]
    d = spark.createDataFrame([(x,) for x in lines], "value string")
    got = cdxj.parse_cdxj(d).collect()
    assert [(r.surt, r.url, r.host_rev, r.status, r.warc_offset, r.warc_length) for r in got] == [("com,a)/", "http://www.a.com/", "com,a", 200, 5, None), ("com,b)/", "http://b.com/", "com,b", None, None, None)]
    assert cdxj.parse_cdxj(d, require_url=False, least_parts=2).count() == 3
    old = cdxj.parse_legacy(spark.createDataFrame([("com,a)/x http://a.com/x 2024 a b c d e w.gz 5 6",), ("short x",)], "value string")).first()
    assert (old.host, old.host_rev, old.warc_filename, old.warc_offset, old.warc_length) == ("a.com", "com,a", "w.gz", 5, 6)


def test_layout_and_footers(spark, tmp_path):
    d = spark.range(2000).select(F.concat(F.lit("com,h"), (F.col("id") % 7).cast("string")).alias("host_rev"), F.col("id").cast("string").alias("url"), F.lit("2024").alias("ts"), F.lit("CC-MAIN-2024-10").alias("collection"))
    layout.write_sorted(d, str(tmp_path / "t"), 3, bloom=True)
    f = footers.footers(spark, str(tmp_path / "t"))
    assert f.agg(F.sum("num_rows")).first()[0] == 2000
    s = footers.shard_summary(f, ["host_rev", "digest"]).collect()
    assert all(r.codecs == ["zstd"] and r.missing_columns == ["digest"] and r.is_sorted for r in s)
    assert layout.with_provenance(d.drop("collection"), "C", "s").columns[:2] == ["collection", "shard_file"]


def test_small_aggregates(spark):
    e = spark.createDataFrame([("a", 10, 3), ("b", 20, 2), ("c", 30, 1)], "path string, size_bytes long, mtime_ns long")
    assert [r.path for r in aggregates.evict(e, 30).collect()] == ["c"]
    lines = spark.createDataFrame([("j", 1, "[sort] CC-MAIN-2024-10"), ("j", 2, "[index] x"), ("j", 3, "plain")], "job string, line_no int, line string")
    assert aggregates.log_state(lines).first().asDict() == {"job": "j", "stage": "index", "collection": "CC-MAIN-2024-10"}
    files = spark.createDataFrame([("/a/x.parquet",), ("/a/x.sorted.parquet",), ("/a/.tmp/y.parquet",)], "path string")
    assert [r.path for r in audit.prefer_sorted(files).collect()] == ["/a/x.sorted.parquet"]
    assert index.rows_by_bytes(100_000_000, 1_000_000) == 1_000_000
    a = spark.createDataFrame([(1,)], "x int")
    assert index.consolidate(a.withColumn("collection", F.lit("A")), {"A": a, "B": a}).count() == 2


def test_year_and_keys_are_pushed(spark, tmp_path):
    """A subtree search of a year in a written layout lists its folders only and pushes both parts of the key filter."""
    d = spark.range(500).select(F.concat(F.lit("com,h"), (F.col("id") % 7).cast("string")).alias("host_rev"), F.col("id").cast("string").alias("url"), F.lit("2024").alias("ts"),
                                F.concat(F.lit("CC-MAIN-"), (2023 + F.col("id") % 3).cast("string"), F.lit("-10")).alias("collection"))
    layout.write_sorted(d, str(tmp_path / "t"), 3)
    found = search.domain_search(spark.read.parquet(str(tmp_path / "t")), "h3.com", year="2024").select("url")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan and "PushedFilters: [Or(EqualTo(host_rev,com,h3),StringStartsWith(host_rev,com,h3,))]" in plan
    assert {int(r.url) for r in found.collect()} == {i for i in range(500) if i % 7 == 3 and i % 3 == 1}


def test_caps_and_marks(spark, tmp_path):
    rows = [("A", f"f{k}", i) for k in range(4) for i in range(5)]
    d = spark.createDataFrame([(c, f, f"2024{i}", "w", i, f"u{i}") for c, f, i in rows], "collection string, shard_file string, ts string, warc_filename string, warc_offset long, url string")
    got = search.capped(d, max_files=2, max_per_file=3, max_matches=5).collect()
    assert len(got) == 5 and {r.shard_file for r in got} == {"f0", "f1"} and all(int(r.ts) >= 20242 for r in got)
    groups = spark.createDataFrame([("p", 0, 10, 4 * 1024 * 1024), ("p", 1, 10, 4 * 1024 * 1024)], "path string, row_group int, num_rows long, total_bytes long")
    mb = groups.selectExpr("*", "'a' as min_value", "'a' as max_value", "array('zstd') as codecs", "array('x') as columns")
    s = footers.shard_summary(mb, ["x"]).withColumn("id", F.lit(1))
    assert s.first().median_mb == 4.0
    assert [r.reasons for r in audit.audit_reasons(s, target_mb=4.5).collect()] == [[]] and [r.reasons for r in audit.audit_reasons(s, target_mb=8.0).collect()] == [["row_group_size"]]


def test_bounded_gunzip(spark):
    bomb = gzip.compress(b"WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" + b"x" * 30_000_000)
    assert len(warc.gunzip(bomb, 1000)) == 1000
    assert warc.record(bomb, max_record=100)["ok"] and len(warc.record(bomb, max_record=100)["body_text_preview"]) < 100
    assert warc.headers("\r\nHTTP/1.1 200 OK\r\nA: b:c \r\n no colon\r\n a :2\r\n") == ("HTTP/1.1 200 OK", {"a": "2"})
    d = spark.createDataFrame([(gzip.compress("héllo".encode()),), (b"\x1f\x8b\x08bad",), (None,)], "bytes binary")
    got = warc.described(d).collect()
    assert [r.text_preview for r in got] == ["héllo", None, None] and got[2].sha256 is None and got[1].n_bytes == 6


def test_backends():
    def ranged(name, start, end):
        return b"r" * (end - start + 1)

    def whole(name, start, end):
        raise OSError("none")

    assert fetch.by_strategy("range", ranged)("n", 0, 1) == fetch.by_strategy("auto", ranged, whole)("n", 0, 1) == b"rr"
    with pytest.raises(OSError):
        fetch.by_strategy("full", ranged, whole)("n", 0, 1)
    with pytest.raises(ValueError):
        fetch.by_strategy("auto", ranged)
    guarded = fetch.sized(ranged, {"a": 10, "b": 10**10}.get)
    assert guarded("a", 0, 9) == b"r" * 10
    for name, end in (("a", 10), ("b", 1), ("c", 1)):
        with pytest.raises(ValueError):
            guarded(name, 0, end)
    calls = []

    def gone(name, start, end):
        calls.append(name)
        raise OSError("status 404")

    with pytest.raises(OSError):
        fetch.patient(gone, 3, 0.0)("n", 0, 0)
    assert len(calls) == 1


def test_members_by_second_try(spark):
    """Members of a slice that fails or holds no records there are fetched by themselves; what fails again is told."""
    blob = b"".join(gzip.compress(b"WARC/1.0\r\n\r\n" + bytes([65 + i]) * 50, mtime=0).ljust(100, b"\0") for i in range(4))
    size = len(gzip.compress(b"WARC/1.0\r\n\r\n" + b"A" * 50, mtime=0))

    def backend(name, start, end):
        if name == "bad" and end - start > 120 or name == "gone":
            raise OSError("status 404")
        return (blob[start : end + 1] if name != "wrong" or end - start < 120 else b"?" * (end - start + 1))

    spans = spark.createDataFrame([(n, 100 * i, size) for n in ("good", "bad", "wrong", "gone") for i in range(4)], SPANS)
    got = fetch.fetch_members(spans, backend, 2)
    how = {n: {r.how for r in got.filter(F.col("w") == n).collect()} for n in ("good", "bad", "wrong", "gone")}
    assert how == {"good": {"slice"}, "bad": {"range"}, "wrong": {"range"}, "gone": {"failed"}}
    counts = {r.w: (r.n_ok, r.n_failed, r.n_second, r.n_bytes) for r in fetch.fetch_counts(got).collect()}
    assert counts == {"good": (4, 0, 0, 4 * size), "bad": (4, 0, 4, 4 * size), "wrong": (4, 0, 4, 4 * size), "gone": (0, 4, 0, 0)}


def test_zone_keys_reach(spark):
    """Keys meet zones under any agreement of their bounds, none and all included."""
    z = spark.createDataFrame([(1, "a", "z"), (2, "com,a", "com,b"), (3, "com,a", "com,a"), (4, None, None), (5, "b", "c"), (6, "", "zz")], "id int, min_key string, max_key string")
    k = spark.createDataFrame([("com,a",), ("com,aa",), ("c",), ("",), ("zz",), (None,)], "key string")
    want = z.crossJoin(k).filter("min_key <= key and key <= max_key")
    rows = lambda d: sorted((r.id, r.key) for r in d.collect())
    assert rows(index.zone_keys(z, k)) == rows(want) == rows(index.zone_keys(z, k, depth=9))


def test_retries():
    seen = []

    def flaky(name, start, end):
        seen.append(name)
        if len(seen) < 3:
            raise OSError("connection reset")
        return b"x"

    assert fetch.patient(flaky, 3, 0.0)("n", 0, 0) == b"x" and len(seen) == 3


def test_upsert_sorts_a_bounded_number_of_rows(spark):
    """Rows of equal keys are replaced, also where keys repeat or are null; all joins are on partitions of the given number."""
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v long")
    new = spark.createDataFrame([("a", 9), ("c", 8), ("c", 7), (None, 6)], "k string, v long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for n in (None, 5):
            got = index.upsert(old, new, ["k"], n)
            assert sorted(map(tuple, got.collect()), key=str) == sorted([("b", 3), (None, 4), ("a", 9), ("c", 8), ("c", 7), (None, 6)], key=str)
        from captrail.plans import registry

        d = "/root/testdata/sf0.001"
        for df, want in ((got, 5), (registry.QUERIES["upsert"](spark, d), index.parts(spark.read.parquet(f"{d}/orders.parquet")))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            dealt = re.findall(r"hashpartitioning\(.*?, (\d+)\), (\w+)", plan)
            assert dealt and set(dealt) == {(str(want), "REPARTITION_BY_NUM")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert index.parts(spark.range(1000), 10) == 100
