"""Pinned vectors of the URL functions."""

import pytest
from pyspark.sql import functions as F

from captrail.functions import urls, values

CASES = [
    (urls.normalize_domain, [("https://www.18f.gov/foo", "18f.gov"), ("WWW.Example.COM", "example.com"), ("http://a.b:80/x", "a.b:80"), ("http://a.b?x=1", "a.b?x=1"), ("\t a.b ", "a.b"), (None, "")]),
    (urls.host_to_rev, [("a.b.c", "c,b,a"), ("a..b.", "b,a"), ("", ""), (None, "")]),
    (urls.canonical_url, [("HTTP://WWW.A.com/P/?q=1#f", "a.com/P/?q=1"), ("a.com", "a.com"), ("http://a.com/x//", "a.com/x"), ("", ""), (None, "")]),
    (urls.url_to_domain, [("wv..gov", None), (".gov", None), ("a.gov.", None), ("nyc.gov", "nyc.gov"), ("https://u@www.A.gov:8080/x?y", "a.gov"), ("", None)]),
    (urls.extract_host, [("http://www.A.b:80/x", "a.b:80"), ("a.b/x", None), ("http:///x", None)]),
    (urls.domain_from_url, [("https://www.A.b:80/x", "www.a.b"), ("ftp://x", "")]),
    (urls.collection_year, [("CC-MAIN-2024-10", "2024"), ("foo", None)]),
    (urls.shard_number, [("cdx-00042.gz", 42), ("cdx-42.gz", None)]),
    (urls.shard_name, [("/x/cdx-00001.gz.sorted.parquet", "cdx-00001.gz"), ("cdx-00001.gz.parquet", "cdx-00001.gz")]),
    (urls.url_variants, [("https://a.com/x", [f"{s}://{h}a.com/x{e}" for s in ("https", "http") for h in ("", "www.") for e in ("", "/")]), ("", [])]),
    (urls.split_list, [(" a, ,b,", ["a", "b"])]),
    (urls.ancestors, [("c,b,a", ["c", "c,b", "c,b,a"])]),
    (urls.host_revs_for_domain, [("a.b", ["b,a", "b,a,www"]), ("", [])]),
    (values.lenient_int, [(" 12 ", 12), ("-", None), ("", None), ("1.5", None), ("-3", -3)]),
    (values.truncating_int, [("1.9", 1), ("x", None)]),
    (urls.transient_error, [("HTTP 429", True), ("connection reset by peer", True), ("404 not found", False)]),
]


@pytest.mark.parametrize("f,cases", CASES, ids=lambda x: getattr(x, "__name__", ""))
def test_vectors(spark, f, cases):
    got = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x string").select("i", f("x").alias("y")).collect()
    assert [r.y for r in sorted(got, key=lambda r: r.i)] == [y for _, y in cases]


def test_two_column_functions(spark):
    d = spark.createDataFrame([(None, "crawl-data/CC-MAIN-2024-10/segments/x"), ("", "x"), ("C", "y")], "c string, w string")
    assert [r[0] for r in d.select(urls.infer_collection("c", "w")).collect()] == ["CC-MAIN-2024-10", None, "C"]
    d = spark.createDataFrame([("a/warc/b", 200, "text/html"), ("a/crawldiagnostics/b", 404, "application/pdf")], "w string, s int, m string")
    assert [r[0] for r in d.select(urls.wayback_score("w", "s", "m")).collect()] == [7, -4]


def test_missing_columns(spark):
    d = spark.createDataFrame([("t",)], "timestamp string")
    assert d.select(values.first_column(d, ["ts", "timestamp"]), values.col_or_null(d, "url")).first().asDict() == {"ts": "t", "url": None}
    assert values.required_columns(d, ["a", "timestamp"]) == ["a"]
    assert d.select(values.gzip_magic(F.unhex(F.lit("1F8B0800")))).first()[0]
