"""Secret scans judged by corpus-wide ownership frequency.

Each document is scanned for candidate credentials. A hash of each candidate's value is counted over the whole corpus by
distinct repositories and distinct owners. Widely copied values are examples, whether they are spread over many owners or,
by two owners or more, over many repositories; how many is many follows the corpus, by the logarithm of its owners and
repositories. What one owner holds is the owner's, in however many repositories. Values that are not spread and look random
are live-looking credentials. Generic tokens, too common to report by their shape alone, become findings only through that
judgement; findings of the base patterns are always kept.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, renamed, stored

#: The base patterns and the least lengths of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is its own leftmost match
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "generic")
#: Added by the method: unbroken tokens of 24 or more characters that may be keys of any vendor.
GENERIC = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}(?![A-Za-z0-9+/_=-])")


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def candidates(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) in order of start, then kind; offsets are code points, ends exclusive."""
    if not text:
        return []
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted((s, e) for _, s, e, _ in found)
    for m in GENERIC.finditer(text):
        v = m[0]
        if any(c.isdigit() for c in v) and any(c.islower() for c in v) and any(c.isupper() for c in v) and entropy(v) >= 3.5 and not any(s < m.end() and m.start() < e for s, e in base):
            found.append(("generic", m.start(), m.end(), v))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


SCANNED = pa.schema([
    ("doc_id", pa.int64()), ("th", pa.int64()), ("repo", pa.string()), ("owner", pa.string()),
    ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("bits", pa.float64())]))),
])
SCANNED_SQL = "doc_id long, th long, repo string, owner string, found array<struct<kind:string,start:long,end:long,value:string,bits:double>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for text in b.column("text"):
            found.append([{"kind": k, "start": s, "end": e, "value": hashlib.sha256(v.encode()).hexdigest(), "bits": entropy(v)} for k, s, e, v in candidates(text.as_py())])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), b.column("repo"), b.column("owner"), pa.array(found, SCANNED.field("found").type)], schema=SCANNED)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
         least_owners: int = 3, least_repos: int = 8, least_bits: float = 2.5) -> DataFrame:
    """One row per row of docs: doc_id, findings array<struct<kind,start,end,hash,n_repos,n_owners,verdict>>.

    verdict: 'example' if the value has as many owners as log2(1 + all owners), and least_owners at least, or two owners and
    as many repositories as log2(1 + all repositories), and least_repos at least; 'weak' if its entropy is under least_bits
    a character; else 'live'. A null owner counts as one owner, a null repository as one repository. Generic candidates
    stay only if live. Null and empty texts have no findings; repeated rows are scanned each; an empty table gives no
    rows. Values leave a task only as SHA-256; texts are never shuffled, findings meet their documents by row number."""
    d = _columns(docs, id_col, text_col, repo_col, owner_col)
    return _judged(d, *_spread(d, least_owners, least_repos), least_bits).select("doc_id", "findings")


def _columns(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    d = renamed(docs, doc_id=id_col, text=text_col, repo=repo_col, owner=owner_col)
    return d.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"), F.col("repo").cast("string"), F.col("owner").cast("string"))


def _spread(d: DataFrame, least_owners: int, least_repos: int) -> tuple[int, int]:
    """Owners and repositories from which on a value is widely copied; two numbers of the corpus reach the driver. They are
    counted exactly, since a verdict can hang on one owner more or less; a null counts as one."""
    owners, repos = (d.select(c).distinct().count() for c in ("owner", "repo"))
    return max(least_owners, math.ceil(math.log2(1 + owners))), max(least_repos, math.ceil(math.log2(1 + repos)))


def _judged(d: DataFrame, many_owners: int, many_repos: int, least_bits: float) -> DataFrame:
    """doc_id, th and findings of each row of d."""
    # The row number is fixed by writing it: the rows with candidates are told apart by it, whatever their ids.
    s = stored(d.mapInArrow(_scan, SCANNED_SQL).withColumn("row", F.monotonically_increasing_id()), "secrets-scan")
    each = s.filter(F.size("found") > 0).select("row", "repo", "owner", F.explode("found").alias("f")).select("row", "repo", "owner", "f.*")
    null = "\0"
    held = each.groupBy("value").agg(F.countDistinct(F.coalesce("repo", F.lit(null))).alias("n_repos"), F.countDistinct(F.coalesce("owner", F.lit(null))).alias("n_owners"))
    copied = (F.col("n_owners") >= many_owners) | ((F.col("n_owners") > 1) & (F.col("n_repos") >= many_repos))
    verdict = F.when(copied, "example").when(F.col("bits") < least_bits, "weak").otherwise("live")
    # Written, so that the join deals both sides anew and Spark can split the partition of a value that many rows hold.
    held = stored(held, "secrets-held")
    judged = each.join(held, "value").withColumn("verdict", verdict).filter((F.col("kind") != "generic") | (F.col("verdict") == "live"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("nth")
    per = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", order, "kind", "end", F.col("value").alias("hash"), "n_repos", "n_owners", "verdict"))).alias("findings"))
    return s.select("doc_id", "th", "row").join(per, "row", "left").select("doc_id", "th", F.coalesce("findings", F.array().cast(per.schema["findings"].dataType)).alias("findings"))


def digest(findings: DataFrame) -> DataFrame:
    """The contract's columns of what scan() returns."""
    f = F.col("findings")
    spans = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter(f, lambda x: x["kind"] != "generic")
    n = lambda kind: F.size(F.filter(f, lambda x: x["kind"] == kind)).cast("long")
    v = lambda verdict: F.size(F.filter(f, lambda x: x["verdict"] == verdict)).cast("long")
    return findings.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                           F.sha2(spans(base).cast("binary"), 256).alias("base_sha256"), spans(f).alias("spans"),
                           v("live").alias("n_live"), v("example").alias("n_example"))


def hidden(text: str, spans: list[dict]) -> str:
    """The text with each span, or each union of overlapping spans, replaced by [SECRET]."""
    out, at = [], 0
    for s, e in sorted((x["start"], x["end"]) for x in spans):
        if e > at:
            out += [text[at:s], "[SECRET]"] if s >= at else []
            at = e
    return "".join(out) + text[at:]


def _by_candidates(docs: DataFrame, text_col: str, wanted: bool) -> DataFrame:
    """The rows of docs whose texts hold candidates, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([bool(candidates(t.as_py())) == wanted for t in b.column(text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
             least_owners: int = 3, least_repos: int = 8, least_bits: float = 2.5) -> DataFrame:
    """docs with live-looking credentials replaced by [SECRET]; all rows stay, copied examples too.

    Texts without a candidate pass through as they are; only the others meet a shuffle. These are compared by id and text hash. What is live depends on the value alone, so rows of one id and text have the same spans:
    one of them speaks for all, and none is gathered. Null and empty texts stay; an empty table gives no rows; columns
    may have any names."""
    d = _columns(docs, id_col, text_col, repo_col, owner_col)
    text = F.col(f"`{text_col}`")
    live = F.filter("findings", lambda x: x["verdict"] == "live")
    hits = _judged(d, *_spread(d, least_owners, least_repos), least_bits).filter(F.size(live) > 0)
    i, th, spans = free(docs, "_id", "_th", "_spans")
    hits = hits.groupBy(F.col("doc_id").alias(i), F.col("th").alias(th)).agg(F.first(F.transform(live, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))).alias(spans))
    hits = stored(hits, "secrets-hits")
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(text) == F.col(th))
    mine = [F.col(f"`{c}`") for c in docs.columns]
    joined = _by_candidates(docs, text_col, True).join(hits, same, "left").select(*mine, spans)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns)
            marked = cols.pop()
            texts = [hidden(t, s) if t is not None and s else t for t, s in zip(cols[at].to_pylist(), marked.to_pylist(), strict=True)]
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return _by_candidates(docs, text_col, False).union(joined.mapInArrow(run, docs.schema))
