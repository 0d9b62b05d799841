"""Personal data, divergence of sources, spelling variants: against plain versions, on odd rows and at their edges."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from captrail.llm import divergence, pii, queries, spelling
from captrail.llm.common import Tables

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_private(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = [c for c in m[0] if c in "0123456789"]
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and total % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return [(list(PATTERNS)[k], s, e) for s, k, e in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ 59()é@.1", max_size=60))
def test_base_patterns(text):
    assert pii.identifiers(text) == plain_private(text)
    found = pii.findings(text)
    assert [f[:3] for f in found if not f[3]] == plain_private(text)


def test_disguises():
    cases = {
        "write to john dot doe at example dot com now": [("email", "john dot doe at example dot com")], "a [at] b.org, x": [("email", "a [at] b.org")], "x(dot)y @ c {dot} de": [],
        "x(dot)y(at)c {dot} de!": [("email", "x(dot)y(at)c {dot} de")], "jоhn@exаmple.com": [("email", "jоhn@exаmple.com")], "＋４９ 171 2345679": [("phone", "＋４９ 171 2345679")],
        "plus four nine one seven one two three four five six seven ok": [("phone", "plus four nine one seven one two three four five six seven")], "plus vier neun, eins sieben eins, zwei drei vier fünf": [("phone", "plus vier neun, eins sieben eins, zwei drei vier fünf")],
        "one nine two dot one six eight dot zero dot one": [("ip", "one nine two dot one six eight dot zero dot one")], "mail: bob&#64;site&#46;net": [("email", "bob&#64;site&#46;net")],
        "4111‑1111‑1111‑1111": [("card", "4111‑1111‑1111‑1111")], "four triple one 1111 1111 1111": [], "Four triple one, one one one one - one one one one - double one double one": [("card", "Four triple one, one one one one - one one one one - double one double one")],
        "jo​hn@ex.com": [("email", "jo​hn@ex.com")], "İ bob at site dot de": [("email", "bob at site dot de")],
        # Clean prose stays alone.
        "look at that dot": [], "I am at example.com": [], "one two three four five six seven eight nine": [], "meet at noon (at the dot)": [], "un deux trois, c'est tout": [], "été à Noël — naïve": [],
    }
    for text, want in cases.items():
        assert [(k, text[s:e]) for k, s, e, added in pii.findings(text) if added] == want, text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.", min_size=0, max_size=25), st.data())
def test_offsets_come_back(text, data):
    """Spans of a rewritten text map to the characters that they came from, through two rewritings."""
    traces, now = [], text
    for _ in range(2):
        cuts = sorted(data.draw(st.lists(st.integers(0, len(now)), max_size=6)))
        changes = [(a, b, data.draw(st.sampled_from(["", "X", "YZ"]))) for a, b in zip(cuts[::2], cuts[1::2], strict=False) if a < b]
        new, edits = pii.rewritten(now, changes)
        owners, at = [], 0
        for s, e, put in changes:
            owners += [(i, i + 1) for i in range(at, s)] + [(s, e)] * len(put)
            at = e
        owners += [(i, i + 1) for i in range(at, len(now))]
        traces.append((edits, owners))
        now = new
    for s in range(len(now)):
        for e in range(s + 1, len(now) + 1):
            a, b = traces[1][1][s][0], traces[1][1][e - 1][1]
            if a < b:
                want = traces[0][1][a][0], traces[0][1][b - 1][1]
                assert pii.source_span([t for t, _ in traces], s, e) == want


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a.b-" * 80_000, "one " * 80_000, "a dot " * 60_000, "a at " * 60_000, "(" * 100_000, "1-" * 100_000, "a@" * 100_000):
        t = time.time()
        pii.findings(text)
        assert time.time() - t < 5


def test_private_on_odd_rows(spark, odd, documents):
    got = pii.digest(pii.scan(odd)).collect()
    assert len(got) == odd.count() and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id in (1, 2, 3))
    assert pii.scan(odd.limit(0)).count() == 0
    rows = [(1, "mail a@b.co or a [at] b [dot] co", "x"), (2, None, "y"), (3, "+1 (917) 555-2670 and 4111 1111 1111 1111", "z")]
    d = spark.createDataFrame(rows, "doc_id long, text string, findings string")
    assert [r.text for r in pii.masked(d).orderBy("doc_id").collect()] == ["mail [EMAIL] or [EMAIL]", None, "[PHONE] and [CARD]"]
    assert [r.spans for r in pii.digest(pii.scan(d)).orderBy("doc_id").collect()] == ["email:5:11,email:15:32", "", "phone:0:17,card:22:41"]
    whole = queries.QUERIES["op11_private"](spark, "/root/testdata/sf0.001").toPandas().set_index("doc_id")
    for r in documents.collect():
        want = plain_private(r.text)
        spans = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        mine = whole.loc[r.doc_id]
        assert [mine[f"n_{k}"] for k in PATTERNS] == [sum(w[0] == k for w in want) for k in PATTERNS]
        assert mine.base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and set(spans.split(",")) <= set(mine.spans.split(","))


# Divergence

def plain_audit(rows, least=30, top=50):
    """{(lang, source, part, item): (value, rank)} by dense sums."""
    use, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        ts = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups.add((lang, source))
        use[lang, source].update(ts)
        docs[lang].update(set(ts))
    out = {}
    share = lambda c, n, v: 1 + 10**9 * (c + 5) // (n + 5 * v)
    for lang in {g[0] for g in groups}:
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=lambda t: t.encode())
        sources = sorted((s for g, s in groups if g == lang), key=lambda s: s.encode())
        total = {s: sum(use[lang, s][t] for t in kept) for s in sources}
        whole = {t: sum(use[lang, s][t] for s in sources) for t in kept}
        p = {s: [share(use[lang, s][t], total[s], len(kept)) for t in kept] for s in sources}
        q = [share(whole[t], sum(whole.values()), len(kept)) for t in kept]
        for s in sources:
            found = {"pair": [(o, sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True))) for o in sources if o != s], "term": [(t, a - b) for t, a, b in zip(kept, p[s], q, strict=True) if use[lang, s][t] and a > b]}
            for part, items in found.items():
                for k, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))):
                    if part == "pair" or k < top:
                        out[lang, s, part, item] = (value, k + 1)
    return out


def test_divergence_on_odd_rows(spark):
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "straße", "ÉTÉ", "ж", "x1y", "zéta", "rare", "日本"]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randrange(0, 9))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S2", None, "", "é"])) for _ in range(300)]
    rows += [(None, "en", "silent"), ("12 34 !", "en", "silent"), (None, None, None), ("only here", "fr", "s1"), (None, "fr", "s2"), ("word " * 20_000, "en", "s1")] + [rows[0]] * 5
    d = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], "text string, lang string, source string, term string, n int, share int")
    for least, top in ((30, 50), (2, 3)):
        got = {(r.lang, r.source, r.part, r.item): (r.value, r.rank) for r in divergence.audit(d, least_docs=least, top=top).collect()}
        assert got == plain_audit(rows, least, top)
    assert divergence.audit(d.limit(0)).count() == 0
    null = spark.createDataFrame([(None, None, None), (None, None, "b")], "text string, lang string, source string")
    assert {tuple(r) for r in divergence.audit(null).collect()} == {("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)}


def test_sketch_never_underestimates(spark, documents):
    """A sketch of few cells lets more through, never less, and the results stay; flushes of few terms change nothing."""
    want = {tuple(r) for r in divergence.audit(documents).collect()}
    small = (divergence.LEAST_CELLS, divergence.MOST_CELLS, divergence.HELD)
    try:
        divergence.LEAST_CELLS, divergence.MOST_CELLS, divergence.HELD = 1 << 15, 1 << 15, 500
        assert {tuple(r) for r in divergence.audit(documents).collect()} == want
    finally:
        divergence.LEAST_CELLS, divergence.MOST_CELLS, divergence.HELD = small
    at = divergence.cells_of(b"en", [b"a", b"b", b"a"], 1 << 20)
    assert at.shape == (2, 3) and (at[:, 0] == at[:, 2]).all() and (at[1] >= 1 << 20).all() and (at < 1 << 21).all()


def test_shares_are_exact(spark):
    d = spark.createDataFrame([(3 * 10**17 + 7, 10**18 - 3, 10**9), (0, 0, 1), (0, 0, 0)], "c long, n long, v long")
    got = [r.p for r in d.select(divergence.share(d.c, d.n, d.v).alias("p")).collect()]
    assert got == [1 + 10**9 * (3 * 10**17 + 12) // (10**18 - 3 + 5 * 10**9), 1 + 10**9, None]


# Spelling

def plain_spelling(docs, factor=10, every=31):
    count = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                count[w] += 1
    words = {w: n for w, n in count.items() if n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    close = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(close[w]), words[form[w]] if form[w] else None)
    return out


def as_rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_on_odd_rows(spark, odd):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert as_rows(spelling.group_variants(odd)) == plain_spelling(docs)
    assert spelling.group_variants(odd.limit(0)).count() == 0
    # Chains of forms, runs of equal letters, letters beyond ASCII, ties of the largest count.
    words = {"aaaaaaaa": 3000, "aaaaaaa": 290, "aaaaaab": 25, "aaaaabb": 2, "straßenx": 40, "straßen": 400, "strasßen": 4, "épatantè": 2, "épatante": 20, "bbbbbbbc": 30, "bbbbbbbd": 30, "bbbbbbbe": 3, "lonely": 99, "solitaire": 2, "éÉÉÉÉÉÉ": 2, "once more": 1}
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(words.items())] + [(None, "Straßen STRAßEN"), (None, None)]
    d = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], "doc_id long, text string, word string, n int, id int")
    for every in (31, 3):
        got = as_rows(spelling.group_variants(d, every=every))
        assert got == plain_spelling(rows, every=every)
    plain = as_rows(spelling.group_variants(d, every=0))
    assert plain["aaaaabb"][:2] == ("aaaaaab", "aaaaaaaa") and plain["bbbbbbbe"][0] == "bbbbbbbc"


def test_near_words_by_all_pairs(spark):
    rng = random.Random(11)
    words = sorted({"".join(rng.choices("abé", k=rng.randrange(1, 7))) for _ in range(250)} | {"", "\U0001f600a", "a\U0001f600", "\U0001f600"})
    d = spark.createDataFrame([(i, w, 1) for i, w in enumerate(words)] + [(10**6, None, 1)], "id long, word string, n long").repartition(5)
    got = sorted(tuple(sorted((r.a_word, r.b_word))) for r in spelling.near_pairs(d).collect())

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    assert got == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if distance(a, b) == 1)


def test_long_words(spark):
    """A word of 200,000 letters has as many keys as letters, and its strings move once a pair."""
    long = "ab" * 100_000
    d = spark.createDataFrame([(1, long), (2, long), (3, long[:-1]), (4, long[:-1]), (5, "x" + long[1:]), (6, "x" + long[1:])], "doc_id long, text string")
    got = as_rows(spelling.group_variants(d, every=0))
    assert sorted(v[3] for v in got.values()) == [1, 1, 2]
    with pytest.raises(ValueError):
        spelling.group_variants(d, factor=1)


def test_hashes_collide_harmlessly(spark, monkeypatch):
    """Keys that collide only make candidates: with a base of 1 any anagram does, and the strings decide."""
    words = ["abcdefg", "gfedcba", "abcdefh", "bacdefg", "abcdef"]
    assert len({int(k) for _, keys, place in spelling.keys_of(words) for k, p in zip(keys, place, strict=True) if p == -1}) == 5
    monkeypatch.setattr(spelling, "BASE", 1)
    index, key, place = (np.concatenate(x) for x in zip(*spelling.keys_of(words), strict=True))
    order = np.lexsort((place, key))
    a, b, *_ = spelling.meetings(key[order], place[order], index[order])
    assert {(0, 2)} <= {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)} and len(a) > 3


@pytest.mark.parametrize("most,steps", [(20, 1), (10**9, 9)])
def test_roots_reach_the_end(spark, most, steps):
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(steps)], "word string, form string")
    ends = spelling.roots(chain, Tables(spark, "t"), most, 10).collect()
    assert {r.root for r in ends} == {f"w{steps}"} and len(ends) == steps
