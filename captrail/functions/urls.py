"""Column functions over URLs, hosts and collection names. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's str.strip() set among ASCII; trims are explicit so that tabs and line ends go too.
_SPACE = r"^[\s]+|[\s]+$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), _SPACE, "")


def _drop_www(col: Column) -> Column:
    return F.when(col.startswith("www."), F.substring(col, 5, 2_000_000_000)).otherwise(col)


def normalize_domain(col: Column | str) -> Column:
    """A bare host from a domain or URL; ports, queries and user info stay. Null gives ''."""
    c = F.regexp_replace(F.lower(strip(F.coalesce(_c(col), F.lit("")))), "^https?://", "")
    return _drop_www(F.substring_index(c, "/", 1))


def host_to_rev(col: Column | str) -> Column:
    """'a.b.c' to 'c,b,a'; empty parts go. Null gives ''."""
    return F.array_join(F.reverse(F.filter(F.split(F.lower(F.coalesce(_c(col), F.lit(""))), "[.]"), lambda p: p != "")), ",")


def host_to_rev_or_null(col: Column | str) -> Column:
    return F.nullif(host_to_rev(col), F.lit(""))


def extract_host(col: Column | str) -> Column:
    """The host of an absolute URL, lower case, without one leading 'www.'; the port stays; null if there is none."""
    u = strip(col)
    return F.nullif(_drop_www(F.lower(F.regexp_extract(u, r"^(?s).*?://([^/]*)", 1))), F.lit(""))


def domain_from_url(col: Column | str) -> Column:
    """The host without its port, lower case; 'www.' stays; '' without http(s)."""
    return F.lower(F.regexp_extract(_c(col), "https?://([^/:]+)", 1))


def url_to_domain(col: Column | str, reject_bad_dots: bool = True) -> Column:
    """The planner's domain: a scheme is assumed, port and user info go; null for hosts with misplaced dots."""
    s = strip(F.coalesce(_c(col), F.lit("")))
    full = F.when(s.contains("://"), s).otherwise(F.concat(F.lit("http://"), s))
    authority = F.regexp_extract(full, r"^[^:/?#]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", "")
    host = normalize_domain(F.when(host == "", s).otherwise(host))
    bad = host == ""
    if reject_bad_dots:
        bad = bad | host.rlike(r"^\.|\.$|\.\.")
    return F.when(~bad, host)


def _absolute(u: Column) -> Column:
    return F.when(u.rlike("(?i)^https?://"), u).otherwise(F.concat(F.lit("https://"), u))


def _netloc(u: Column) -> Column:
    return F.regexp_extract(u, r"^[^:/?#]+://([^/?#]*)", 1)


def _path(u: Column) -> Column:
    return F.regexp_extract(u, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)


def _query(u: Column) -> Column:
    """The query with its mark; '' if empty."""
    q = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    return F.when(q == "", "").otherwise(F.concat(F.lit("?"), q))


def canonical_url(col: Column | str) -> Column:
    """Host, path and query for matching: no scheme, fragment, 'www.' or trailing slashes; only the host is lower-cased."""
    u = strip(F.coalesce(_c(col), F.lit("")))
    a = _absolute(u)
    path = F.when(_path(a) == "", "/").otherwise(_path(a))
    return F.when(u == "", "").otherwise(F.regexp_replace(F.concat(_drop_www(F.lower(_netloc(a))), path, _query(a)), "/+$", ""))


def url_variants(col: Column | str) -> Column:
    """Up to eight spellings in order: scheme given and other, host with and without 'www.', path with and without slash.

    An absolute URL that is none of them comes first. Blank input gives no variants, input without a host itself."""
    u = strip(F.coalesce(_c(col), F.lit("")))
    a = _absolute(u)
    net, path, query = _netloc(a), _path(a), _query(a)
    scheme = F.lower(F.regexp_extract(a, "^([^:]+)://", 1))
    schemes = F.when(scheme == "http", F.array(F.lit("http"), F.lit("https"))).otherwise(F.array(F.lit("https"), F.lit("http")))
    hosts = F.array(net, F.when(F.lower(net).startswith("www."), F.substring(net, 5, 2_000_000_000)).otherwise(F.concat(F.lit("www."), net)))
    paths = F.array(path, F.when(path.endswith("/"), F.regexp_replace(path, "/+$", "")).otherwise(F.concat(path, F.lit("/"))))
    each = F.flatten(F.transform(schemes, lambda s: F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.replace(F.concat(s, F.lit("://"), h, p, query), F.lit("///"), F.lit("//")))))))
    each = F.array_distinct(each)
    each = F.when(u.rlike("(?i)^https?://") & ~F.array_contains(each, u), F.concat(F.array(u), each)).otherwise(each)
    return F.when(u == "", F.array().cast("array<string>")).when(net == "", F.array(u)).otherwise(each)


def host_revs_for_domain(col: Column | str) -> Column:
    """The keys of a domain and of its 'www.' form, sorted."""
    d = F.lower(strip(F.coalesce(_c(col), F.lit(""))))
    both = F.array_sort(F.array_distinct(F.array(host_to_rev(d), host_to_rev(F.concat(F.lit("www."), d)))))
    return F.when(d == "", F.array().cast("array<string>")).otherwise(both)


def host_revs_for_urls(domain: Column | str, requested: Column | str) -> Column:
    """host_revs_for_domain() with the keys of the hosts of an array of requested URLs, each with and without 'www.'."""
    host = lambda u: F.lower(F.regexp_replace(F.regexp_replace(_netloc(_absolute(strip(u))), "^.*@", ""), ":[0-9]*$", ""))
    other = lambda h: F.when(h.startswith("www."), F.substring(h, 5, 2_000_000_000)).otherwise(F.concat(F.lit("www."), h))
    hosts = F.filter(F.transform(F.coalesce(_c(requested), F.array().cast("array<string>")), host), lambda h: h != "")
    keys = F.flatten(F.transform(hosts, lambda h: F.array(host_to_rev(h), host_to_rev(other(h)))))
    return F.filter(F.array_sort(F.array_distinct(F.concat(host_revs_for_domain(domain), keys))), lambda k: k != "")


def collection_of_path(path: Column | str) -> Column:
    """The first folder of a path that is named CC-MAIN-..., else null."""
    return F.nullif(F.regexp_extract(_c(path), "(?:^|/)(CC-MAIN-[^/]*)/", 1), F.lit(""))


def year_of_path(path: Column | str) -> Column:
    """The year of the collection in a path, else a folder named by four digits or 'year=' and these, else null."""
    folder = F.nullif(F.regexp_extract(_c(path), "/(?:year=)?([0-9]{4})/", 1), F.lit(""))
    return F.coalesce(collection_year(collection_of_path(path)), folder)


def in_shard_part(col: Column | str, mod: int, rem: int) -> Column:
    """Whether a shard's number falls to part rem of mod; files without a number fall to none."""
    return F.coalesce(F.pmod(shard_number(col), F.lit(mod)) == rem, F.lit(False))


def ancestors(host_rev: Column | str) -> Column:
    """'c,b,a' to ['c', 'c,b', 'c,b,a']: the keys of all subtrees that hold a host."""
    p = F.split(_c(host_rev), ",")
    return F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: F.array_join(F.slice(p, 1, i), ","))


def collection_year(col: Column | str) -> Column:
    """The third dash-separated part if it is all digits, as text."""
    part = F.get(F.split(_c(col), "-"), 2)
    return F.when(part.rlike("^[0-9]+$"), part)


def collection_sort_key(col: Column | str) -> Column:
    """struct(year, week, name) of CC-MAIN-YYYY-WW; other names have year and week 0."""
    c, pattern = _c(col), "^CC-MAIN-([0-9]{4})-([0-9]{2})$"
    num = lambda g: F.when(c.rlike(pattern), F.regexp_extract(c, pattern, g).cast("int")).otherwise(0)
    return F.struct(num(1).alias("year"), num(2).alias("week"), c.alias("name"))


def shard_number(col: Column | str) -> Column:
    """The number of cdx-NNNNN.gz, else null."""
    return F.when(_c(col).rlike(r"^cdx-[0-9]{5}\.gz$"), F.regexp_extract(_c(col), r"^cdx-([0-9]{5})\.gz$", 1).cast("int"))


def shard_name(path: Column | str) -> Column:
    """The file name of a shard path without .parquet and .sorted."""
    return F.regexp_replace(F.regexp_extract(_c(path), "([^/]*)$", 1), r"(\.sorted)?\.parquet$", "")


def infer_collection(collection: Column | str, warc_filename: Column | str) -> Column:
    """The collection, or where it is null or empty the first CC-MAIN part of the archive's path; null if there is none."""
    return F.coalesce(F.nullif(_c(collection), F.lit("")), F.nullif(F.regexp_extract(_c(warc_filename), "(CC-MAIN-[^/]*)", 1), F.lit("")))


def warc_url(filename: Column | str, prefix: str) -> Column:
    """Absolute names pass; others are joined to the prefix with one slash."""
    f = _c(filename)
    return F.when(f.rlike("(?i)^https?://"), f).otherwise(F.concat(F.lit(prefix.rstrip("/") + "/"), F.regexp_replace(f, "^/+", "")))


def warc_cache_name(url: Column | str) -> Column:
    """sixteen hex digits of the URL's SHA-256, two underscores and its last part."""
    return F.concat(F.substring(F.sha2(_c(url).cast("binary"), 256), 1, 16), F.lit("__"), F.regexp_extract(_c(url), "([^/?]*)(\\?.*)?$", 1))


def split_list(col: Column | str) -> Column:
    """Comma-separated parts, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(_c(col), F.lit("")), ","), lambda x: strip(x)), lambda x: x != "")


def wayback_score(warc_filename: Column | str, status: Column | str, mime: Column | str) -> Column:
    """4 for archive files, -4 for crawl diagnostics, 2 for status 200, 1 for HTML."""
    f, m = _c(warc_filename), F.lower(F.coalesce(_c(mime), F.lit("")))
    one = lambda cond, n: F.when(cond, n).otherwise(0)
    return one(f.contains("/warc/"), 4) + one(f.contains("crawldiagnostics"), -4) + one(_c(status) == 200, 2) + one(m.startswith("text/html"), 1)


#: Texts of errors that are worth another try.
TRANSIENT_PATTERN = " 429| 502| 503| 504|too many requests|timeout|timed out|connection reset|temporarily unavailable"


def transient_error(col: Column | str) -> Column:
    """Whether an error text looks worth another try: rate limits, gateway errors, timeouts, dropped connections."""
    return F.lower(F.coalesce(_c(col), F.lit(""))).rlike(TRANSIENT_PATTERN)
