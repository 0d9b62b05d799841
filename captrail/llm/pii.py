"""Personal data, found through disguises whose offsets are preserved.

Plain identifiers (email, ip, card, phone) are found in the text as it stands. Three transducers then rewrite it: homoglyphs
and other look-alikes become ASCII, spelled digits become digits, and at/dot disguises become signs. Each records its edits as
(source start, source end, output start, output end). Identifiers of the rewritten text that touch an edit are mapped back through
the edits to the characters they came from and join the plain ones, which always stay.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import renamed

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. A match that ends a maximal run of its characters needs no way back, so all are possessive and
#: take linear time. Of an email, the part from @ on is matched; what stands before it is read backwards.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

#: Cyrillic and Greek letters that look like ASCII ones, and what they look like.
LOOK_ALIKE = ("АВЕКМНОРСТХаеорсухіїјѕԁԛԝҮһΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρ", "ABEKMHOPCTXaeopcyxiijsdqwYhABEZHIKMNOPTYXaovp")
#: Invisible characters and dashes.
INVISIBLE, DASHES = "\u00ad\u200b\u200c\u200d\u2060\ufeff", "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"
#: Digits by name, in four languages.
SPELLED = [
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
]
#: Names of the signs, and the domains in which bare words ("a at b dot com") are believed.
AT_WORDS, DOT_WORDS, PLUS_WORDS = ("at", "arroba", "chez", "ät"), ("dot", "punkt", "point", "punto"), ("plus", "más")
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "eu", "ch", "at", "us")

_VALUE = {w: str(k) for names in SPELLED for k, w in enumerate(names)}
_any = lambda words: "(?:" + "|".join(sorted(set(words), key=lambda w: (-len(w), w))) + ")"
_NAMED, _DOT = _any(_VALUE), _any(DOT_WORDS)
_ONE = rf"(?:(?:double|triple)\s{{1,3}})?{_NAMED}(?![^\W_])|[0-9](?![^\W_])"
_GAP = rf"(?:\s{{1,3}}{_DOT}\s{{1,3}}|[\s,;-]{{1,3}})"
#: The patterns below read lower-cased text. At least four digits in a row, some by name; a spelled plus may stand before them.
SPELLED_RUN = re.compile(rf"(?<![^\W_])(?:{_any(PLUS_WORDS)}\s{{1,3}})?(?:{_ONE})(?:{_GAP}(?:{_ONE})){{3,}}")
SPELLED_PART = re.compile(rf"(?P<plus>{_any(PLUS_WORDS)}\s{{1,3}})|(?:(?P<times>double|triple)\s{{1,3}})?(?P<name>{_NAMED})(?![^\W_])|(?P<digit>[0-9])|(?P<dot>\s{{1,3}}{_DOT}\s{{1,3}})|(?P<gap>[\s,;-]{{1,3}})")
#: Bracketed or escaped signs count anywhere, with the blanks around brackets. Bare words only as a whole address of up to eight labels a
#: side that ends in a known domain: so the pattern stays linear.
AT_SIGN, DOT_SIGN = re.compile(rf"[\[({{<]\s{{0,3}}(?:{_any(AT_WORDS)}|@)\s{{0,3}}[\])}}>]|&(?:#0{{0,4}}64|#x0{{0,4}}40|commat);"), re.compile(rf"[\[({{<]\s{{0,3}}(?:{_DOT}|\.)\s{{0,3}}[\])}}>]|&(?:#0{{0,4}}46|#x0{{0,4}}2e|period);")
BARE_DOT = re.compile(rf"(?<=[a-z0-9])\s{{1,3}}{_DOT}\s{{1,3}}(?=[a-z0-9])")
_NEXT = rf"(?:\s{{1,3}}{_DOT}\s{{1,3}}|\.)"
BARE = re.compile(rf"(?<![a-z0-9._%+-])[a-z0-9_%+-]++(?:{_NEXT}[a-z0-9_%+-]++){{0,7}}?(?P<at>\s{{1,3}}at\s{{1,3}}|@)[a-z0-9-]++(?P<rest>(?:{_NEXT}[a-z0-9-]++){{0,7}}?{_NEXT}{_any(DOMAINS)})(?![a-z0-9-])")
TOKEN = re.compile(r"[^\W_]+")

Edit = tuple[int, int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    end = 0
    if at < 0:
        return
    for m in AT_DOMAIN.finditer(text, at):
        s = m.start()
        while s > end and text[s - 1] in LOCAL:
            s -= 1
        if s < m.start():
            yield s, m.end()
            end = m.end()


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind; ends are exclusive."""
    found = [("email", s, e) for s, e in _emails(text)]
    if DIGITS.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start() <= 37:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(DIGITS.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


@lru_cache(maxsize=1)
def look_alikes() -> dict[str, str]:
    """Characters that stand for one ASCII character or for none, by compatibility, digit value or looks."""
    table = {}
    for code in (*range(0xA0, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1FBF0, 0x1FBFA)):
        c = chr(code)
        value = unicodedata.decimal(c, None)
        plain = str(value) if value is not None else unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and plain.isascii() and plain.isprintable():
            table[c] = plain
    table |= dict(zip(*LOOK_ALIKE, strict=True)) | dict.fromkeys(INVISIBLE, "") | dict.fromkeys(DASHES, "-")
    return table


def lowered(text: str) -> str:
    """The text in lower case, character for character: only one capital has a longer small form."""
    return text.replace("\u0130", "I").lower()


def rewritten(text: str, changes: Iterable[tuple[int, int, str]]) -> tuple[str, list[Edit]]:
    """The text with each (start, end, replacement) made, in order, and the edits."""
    out, edits, at, made = [], [], 0, 0
    for s, e, new in changes:
        out += [text[at:s], new]
        made += s - at
        edits.append((s, e, made, made + len(new)))
        made += len(new)
        at = e
    return "".join(out) + text[at:] if edits else text, edits


def homoglyphs(text: str) -> Iterator[tuple[int, int, str]]:
    if not text.isascii():
        held = look_alikes().keys() & set(text)
        if held:
            for m in re.finditer("[" + "".join(map(re.escape, sorted(held))) + "]", text):
                yield *m.span(), look_alikes()[m[0]]


def spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    """Named digits in runs of four or more; what separates them goes, named dots between them become dots."""
    low = lowered(text)
    if _VALUE.keys().isdisjoint(TOKEN.findall(low)):
        return
    for run in SPELLED_RUN.finditer(low):
        parts = list(SPELLED_PART.finditer(low, *run.span()))
        if not any(p["name"] for p in parts):
            continue
        for p in parts:
            if p["digit"] is None:
                times = {"double": 2, "triple": 3}.get(p["times"], 1)
                yield *p.span(), "+" if p["plus"] else _VALUE[p["name"]] * times if p["name"] else "." if p["dot"] else ""


def _with_blanks(text: str, m: re.Match) -> tuple[int, int]:
    """The span of a bracketed sign and up to three blanks on either side."""
    s, e = m.span()
    if m[0][0] != "&":
        s -= len(before := text[max(0, s - 3) : s]) - len(before.rstrip())
        e += len(after := text[e : e + 3]) - len(after.lstrip())
    return s, e


def signs(text: str) -> Iterator[tuple[int, int, str]]:
    """Bracketed and escaped signs, and the named ones of bare addresses."""
    low = lowered(text)
    found = [(*_with_blanks(low, m), new) for pattern, new in ((AT_SIGN, "@"), (DOT_SIGN, ".")) for m in pattern.finditer(low)]
    if any(w in low for w in DOT_WORDS) and BARE_DOT.search(low):
        for m in BARE.finditer(low):
            dots = [(*d.span(), ".") for d in BARE_DOT.finditer(low, m.start(), m.end())]
            if dots and (m["at"] == "@" or dots[-1][0] >= m.start("rest")):
                found += [(*m.span("at"), "@"), *dots]
    end = 0
    for s, e, new in sorted(found):
        if s >= end:
            yield s, e, new
            end = e


TRANSDUCERS = (homoglyphs, spelled_digits, signs)


def normalised(text: str) -> tuple[str, list[list[Edit]]]:
    """The text after all transducers, and the edits of each that made any."""
    traces = []
    for transducer in TRANSDUCERS:
        text, edits = rewritten(text, transducer(text))
        if edits:
            traces.append(edits)
    return text, traces


def _back(edits: list[Edit], place: int, end: bool) -> int:
    """The source character of an output character: its first one, or one past its last."""
    k = bisect_right(edits, place, key=lambda e: e[2]) - 1
    while k >= 0 and edits[k][2] == edits[k][3]:  # nothing came out of this edit
        if edits[k][2] < place:
            break
        k -= 1
    if k >= 0 and place < edits[k][3]:
        return edits[k][1 if end else 0]
    k = bisect_right(edits, place, key=lambda e: e[2]) - 1
    moved = edits[k][1] - edits[k][3] if k >= 0 else 0
    return place + moved + end


def source_span(traces: list[list[Edit]], start: int, end: int) -> tuple[int, int]:
    """The span of the first text that a span of the last one came from."""
    for edits in reversed(traces):
        start, end = _back(edits, start, False), _back(edits, end - 1, True)
    return start, end


def findings(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, added) by start, kind and end; offsets are code points of the text itself, ends exclusive."""
    if not text:
        return []
    base = identifiers(text)
    plain, traces = normalised(text)
    if not traces:
        return [(*f, False) for f in base]
    known = set(base)
    for kind, s, e in identifiers(plain):
        a, b = source_span(traces, s, e)
        if text[a:b] != plain[s:e] and (kind, a, b) not in known:
            known.add((kind, a, b))
    return sorted([(*f, f not in set(base)) for f in known], key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))
FOUND_SQL = "array<struct<kind:string,start:long,end:long,added:boolean>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [[{"kind": k, "start": s, "end": e, "added": a} for k, s, e, a in findings(t.as_py())] for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, FOUND)], names=["doc_id", "findings"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, findings array<struct<kind,start,end,added>>; added: found through a disguise only.

    Rows stand alone: no shuffle, and time is linear in the length of a text. Null and empty texts have no findings, a null id stays
    null, repeated rows are scanned each, an empty table gives no rows, other columns are not read. Findings of one start are
    in the order of KINDS, then by end. An added finding may reach over a base one of its kind (a letter of the name was disguised)."""
    d = renamed(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return d.mapInArrow(_scan, f"doc_id long, findings {FOUND_SQL}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of what scan() returns, and how many spans the method added."""
    f = F.col("findings")
    base = F.filter(f, lambda x: ~x["added"])
    spans = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    n = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(n, KINDS), F.sha2(spans(base).cast("binary"), 256).alias("base_sha256"), spans(f).alias("spans"), F.size(F.filter(f, lambda x: x["added"])).cast("long").alias("n_added"))


def masked_text(text: str | None) -> str | None:
    """The text with each finding, or each union of overlapping ones, replaced by the kind of the first, as [EMAIL]."""
    out, at, end = [], 0, 0
    for kind, s, e, _ in findings(text):
        if s >= end:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = end = max(end, e)
    return "".join(out) + text[at:] if out else text


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with personal data replaced; all rows and columns stay, null and empty texts as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns)
            cols[at] = pa.array([masked_text(t.as_py()) for t in cols[at]], cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
