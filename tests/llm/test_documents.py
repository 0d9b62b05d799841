"""Document operators against brute force, held-out rows and odd inputs."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from captrail.llm import components, language, minhash, mixing, quality, queries, secret_scan, suffixes, windows

from . import brute


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_near_duplicates(spark, sf, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op9_minhash"](spark, sf).collect()}
    assert got == brute.near(texts(documents))


def test_near_duplicates_of_one_base(spark):
    """A large group of near copies, each with a word put in, beside documents that share a common line only."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    docs = [(i, " ".join(base[: (k := int(rng.integers(1, 119)))] + [f"new{i}"] + base[k:])) for i in range(300)]
    line = " ".join(f"l{i}" for i in range(30))
    docs += [(1000 + i, " ".join(f"d{i}.{j}" for j in range(60)) + " " + line) for i in range(300)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.near(docs)


@pytest.mark.parametrize("shingle, percent, outside", [(3, 85, 64), (5, 80, 12)])
def test_near_duplicates_far_groups(spark, monkeypatch, shingle, percent, outside):
    """Groups about several bases: copies with few and with many words changed to words that others have too, cut copies of
    every length, and copies of two bases. No link that brute force finds is lost, none is added."""
    monkeypatch.setattr(minhash, "SHORT_OUTSIDE", outside)
    rng = np.random.default_rng(7)
    bases = [[f"b{k}.{i}" for i in range(n)] for k, n in enumerate((150, 60))]
    docs = []
    for k, base in enumerate(bases):
        for _ in range(90):
            w = list(base)
            for i in rng.choice(len(w), int(rng.integers(0, max(2, len(w) // 8))), replace=False):
                w[i] = f"v{int(rng.integers(0, 6))}"
            docs.append(w)
        docs += [base[: len(base) - cut] for cut in range(0, len(base) - 3, 2)]
        docs += [base + bases[k - 1][:n] for n in range(1, 40, 3)]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=shingle, percent=percent).collect()}
    assert got == brute.near(docs, shingle, percent)


def test_near_duplicates_odd(spark, odd):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert [by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [1, 2, 3, 4, 5, 6, 6, 8, 5]
    assert by[None].component_id == 6 and not by[None].kept and by[3].n_shingles == 0 and by[4].n_shingles == 1
    assert minhash.near_duplicates(odd.limit(0)).count() == 0
    assert sorted(r.doc_id for r in minhash.one_of_each(odd).collect()) == [1, 2, 3, 4, 5, 6, 8]


def test_one_of_each_without_ids(spark):
    """Rows without an id and rows of one id are compared by their texts like all others."""
    text = lambda name, n=200: " ".join(f"{name}{i}" for i in range(n))
    a, b, c, e = (text(x) for x in "abce")
    rows = [
        (1, a), (None, a), (None, a + " end"), (None, b), (None, b), (None, b + " end"), (None, c), (None, None), (None, ""),
        (5, c + " last"), (5, text("f")), (5, a + " more"), (6, e), (3, text("f") + " near"), (7, None), (7, None),
    ]
    rows += [(None, " ".join(w for j, w in enumerate(e.split()) if j != i)) for i in range(30)]
    got = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = [(r.doc_id, r.text) for r in got]
    # Of b and its near copy one stays, whichever is first by signature.
    assert len([t for i, t in kept if i is None and t in (b, b + " end")]) == 1
    rest = sorted((str(x) for x in kept if x[1] not in (b, b + " end")))
    assert rest == sorted(map(str, [(1, a), (None, None), (None, ""), (5, c + " last"), (6, e), (3, text("f") + " near"), (7, None)]))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70), (200, 200), (None, 3)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 70: 50, 100: 50}


def test_windows(spark, sf, documents):
    got = sorted(tuple(r) for r in queries.QUERIES["op5_windows"](spark, sf).collect())
    assert got == sorted(brute.substring(texts(documents)))


@pytest.mark.parametrize("hot", [1, 3, 256])
def test_windows_hot(spark, hot):
    """Every split between single windows and packed runs gives the same words."""
    passage = " ".join(f"p{i}" for i in range(50))
    docs = [(i, f"a{i} b{i} {passage} " + " ".join(f"c{i}.{j}" for j in range(i))) for i in range(12)] + [(50, "again " * 90), (51, passage), (51, passage)]
    got = windows.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), hot=hot).collect()
    assert sorted(map(tuple, got)) == sorted(brute.substring(docs))


def test_windows_odd(spark, odd):
    got = windows.remove_repeats(odd, keep_text=True).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted((str(x[0]), *x[1:]) for x in brute.substring(texts(odd)))
    assert windows.remove_repeats(odd.limit(0)).count() == 0


def spans(text, n):
    cover = np.zeros(n, bool)
    for s in filter(None, (text or "").split(",")):
        a, b = map(int, s.split(":"))
        cover[a:b] = True
    return cover


@pytest.mark.parametrize("hot", [1, 1024])
def test_suffixes(spark, documents, hot):
    docs = texts(documents)
    w, cover = brute.repeats(docs, 50)
    got = {r.doc_id: r for r in suffixes.repeated_passages(documents, hot=hot).collect()}
    for (i, _), x, c in zip(docs, w, cover, strict=True):
        assert (spans(got[i].spans if i in got else "", len(x)) == c).all()
        assert i not in got or got[i].n_repeated == c.sum()


@pytest.mark.parametrize("shared", [5, 12])
def test_suffixes_left_partners(spark, shared):
    """A line of 45 words in 200 documents; pairs of them also share words before it, and only these repeat 50 words."""
    rng = np.random.default_rng(shared)
    line = " ".join(f"l{i}" for i in range(45))
    own = lambda i, n: " ".join(f"r{x}" for x in rng.integers(0, 10**9, n))
    docs = [(i, f"{own(i, 30)} {' '.join(f's{i // 2}.{j}' if i < 120 else f't{i}.{j}' for j in range(shared))} {line} {own(i, 60)}") for i in range(200)]
    w, cover = brute.repeats(docs, 50)
    assert sum(c.any() for c in cover) == 120
    got = {r.doc_id: r for r in suffixes.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for (i, _), x, c in zip(docs, w, cover, strict=True):
        assert (spans(got[i].spans if i in got else "", len(x)) == c).all()


@pytest.mark.parametrize("hot", [8, 1024])
def test_suffixes_near_copies(spark, monkeypatch, hot):
    """Near copies of one text mark the words of all pairs; where their heads are hot, each place is one row, not one for each window."""
    rng = np.random.default_rng(6)
    base, docs = [f"b{i}" for i in range(400)], [(1000, " ".join(f"c{i}" for i in range(200)))]
    for i in range(60):
        w = list(base)
        for k in rng.integers(0, 400, i % 4):
            w[k] = f"x{i}.{k}"
        docs.append((i, " ".join(w[int(rng.integers(0, 30)) :] + [f"end{i}"])))
    w, cover = brute.repeats(docs, 50)
    stored, put = [], suffixes.Tables.put

    def counted(self, df, name):
        out = put(self, df, name)
        if name == "contexts":
            stored.append(out.filter("hot").count())
        return out

    monkeypatch.setattr(suffixes.Tables, "put", counted)
    got = {r.doc_id: r for r in suffixes.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string"), hot=hot).collect()}
    for (i, _), x, c in zip(docs, w, cover, strict=True):
        assert (spans(got[i].spans if i in got else "", len(x)) == c).all()
    windows = sum(len(x) - 49 for x in w)
    assert stored == [0] if hot == 1024 else 0 < stored[0] < windows / 5


def test_suffixes_group():
    """Places of one head in all pairs and by classes mark the same words, with short and empty contexts among them."""
    rng = np.random.default_rng(5)
    head = [b"h%d" % i for i in range(25)]
    tail = lambda n: [b"ab"[k : k + 1] + b"\1" * int(rng.integers(0, 2)) for k in rng.integers(0, 2, n)]
    stems = [(tail(25), tail(25)) for _ in range(6)]
    rows = []
    for i in range(300):
        right, left = (stems[k][j] for j, k in enumerate(rng.integers(0, 6, 2)))
        cut, more = rng.integers(0, 26, 2), rng.integers(0, 26, 2)
        rows.append((head + (right[: cut[0]] + tail(more[0]))[:25], (left[: cut[1]] + tail(more[1]))[:25], i, 0, 1000))

    def covered(found):
        return {(doc, j) for doc, _, first, last in found for j in range(first, last)}

    assert covered(suffixes._group(rows, 50, 25, 8)) == covered(suffixes._group(rows, 50, 25, 1000)) != set()


def test_suffixes_odd(spark, odd):
    got = {r.doc_id: r.n_repeated for r in suffixes.repeated_passages(odd).collect()}
    assert got == {5: 60_000, 9: 60_000}
    assert suffixes.repeated_passages(odd.limit(0)).count() == 0


def test_secrets(spark, sf, documents):
    got = {r.doc_id: ((r.n_assign, r.n_access, r.n_hex), r.base_sha256) for r in queries.QUERIES["op7_secrets"](spark, sf).collect()}
    assert got == {i: brute.secrets(t) for i, t in texts(documents)}


def test_secret_ownership(spark):
    """A key that many owners hold is an example, one of a single owner is live; generic tokens stay only if live."""
    key, own, token = "password=hunter2hunter2", "api_KEY: 'Zx81kQ0pLm77aB'", "tr4Ns8Qw2Lm5Vb7Xc9Zd1Fg3Hj"
    rows = [(i, f"é {key}", f"s{i}") for i in range(5)] + [(10, f"{own} x", "s1"), (11, f"see {token} here", "s1"), (12, "SECRET=short token==abcdefgh", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: [(f.kind, f.start, f.end, f.verdict) for f in r.findings] for r in secret_scan.scan(d).collect()}
    assert got[0] == [("assign", 2, 25, "example")] and got[10] == [("assign", 0, 24, "live")] and got[11] == [("generic", 4, 30, "live")]
    assert got[12] == [("assign", 13, 28, "weak")] or got[12][0][:2] == ("assign", 13)
    red = {r.doc_id: r.text for r in secret_scan.redacted(d).collect()}
    assert red[0] == f"é {key}" and red[10] == "[SECRET]' x" and red[11] == "see [SECRET] here"


def test_secret_verdicts(spark):
    """Owners decide over one value, repositories over another; one owner's many repositories leave a value live, and a value
    of little entropy is weak. Spans are those of plain patterns and counts."""
    many, repos, mine, weak = "password=Aq7Lm2Xz9Kd4", "token: Pz8Rt6Yw3Qn1", "secret=Hj5Vb8Nc2Mx7", "password=aaaaaaaaaaaa"
    generic, spread = "tr4Ns8Qw2Lm5Vb7Xc9Zd1Fg3Hj", "Kp3Wd8Zb5Xn1Qs6Vt2Lm9Rg4Yc"
    rows = [(f"{many} é", f"o{i}") for i in range(6)] + [(repos, f"o{i % 2}") for i in range(9)] + [(mine, "o3") for _ in range(20)] + [(weak, "o1")]
    rows += [(f"see {generic} here {weak}", "o9"), *[(f"and {spread}", f"o{i}") for i in range(6)], ("AKIA" + "B7" * 6 + " " + "0123456789abcdef" * 2, None)]
    docs = [(i, t, s) for i, (t, s) in enumerate(rows)]
    got = {r.doc_id: [(f.kind, f.start, f.end, f.verdict, f.n_owners, f.n_repos) for f in r.findings] for r in secret_scan.scan(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    of = lambda text: {f[3:] for i, t, _ in docs if text in t for f in got[i] if t[f[1] : f[2]].endswith(text[-12:])}
    assert of(many) == {("example", 6, 6)} and of(repos) == {("example", 2, 9)} and of(mine) == {("live", 1, 20)}
    assert of(weak) == {("weak", 2, 2)} and of(generic) == {("live", 1, 1)} and of(spread) == set()
    patterns = {"assign": brute.ASSIGN, "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}", "generic": generic}
    for i, t, _ in docs:
        want = sorted((m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, t))
        assert [f[1:3] for f in got[i]] == want


def test_redacted_by_own_text(spark):
    """Rows without an id and rows of one id lose the secrets of their own texts only."""
    own, clean = "password=Zx81kQ0pLm77aB then more", "a clean text that is long enough to be cut"
    rows = [(None, own), (None, clean), (None, own), (None, None), (7, clean), (7, "token: q9W8e7R6t5Y4"), (8, "short")]
    d = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = sorted((str(r.doc_id), str(r.text)) for r in secret_scan.redacted(d).collect())
    hidden = {own: "[SECRET] then more", "token: q9W8e7R6t5Y4": "[SECRET]"}
    assert got == sorted((str(i), str(hidden.get(t, t))) for i, t in rows)


def test_secrets_odd(spark, odd):
    assert secret_scan.scan(odd).count() == odd.count()
    assert secret_scan.digest(secret_scan.scan(odd.limit(0))).count() == 0
    assert secret_scan.redacted(odd).columns == odd.columns


def test_quality(spark, sf, documents):
    d = queries.QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out").collect()
    good = [r.score for r in d if r.quality == 1]
    bad = [r.score for r in d if r.quality == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r.predicted == r.quality for r in d]) > 0.95


def test_quality_identity():
    """The linear-time score equals the sum over all pairs."""
    m = {"w0": 0.1, "w": np.random.default_rng(1).normal(0, 0.1, quality.N), "v": np.random.default_rng(2).normal(0, 0.1, (quality.N, quality.RANK))}
    ids, x = quality.features("a b c a", 7)
    z = m["w0"] + m["w"][ids] @ x + sum(m["v"][ids[i]] @ m["v"][ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i))
    assert abs(quality.score_one(m, ids, x) - 1 / (1 + np.exp(-z))) < 1e-12


def plain_quality(model, text, n_chars):
    """The score of a whole text from the model alone: features one by one, and all pairs of them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    w, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size, many = max(1, len(w)), max(1, len(raw)), max(1, len(lines))
    log = lambda x, top: min(1.0, math.log(1 + max(0, x)) / top)
    among = lambda chars: sum(raw.count(c) for c in {bytes([x]) for x in chars})
    most = lambda xs: max((xs.count(x) for x in set(xs)), default=0)
    stats = {
        "words": log(len(w), 11.0), "word_length": min(1.0, sum(len(x) for x in w) / n / 24), "distinct": len(set(w)) / n, "top_word": most(w) / n, "top_line": most(lines) / many,
        "upper": among(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size, "digits": among(b"0123456789") / size, "marks": min(1.0, 4 * among(b"|#*$%&@!~^=<>{}[]\\_") / size),
        "punctuated": min(1.0, (raw.count(b".") + raw.count(b",")) / n), "lines": log(len(lines), 8.0), "line_words": min(1.0, n / many / 64),
        "odd_ends": sum(x[-1:] in (b"!", b"#", b"*", b"$", b"%", b"&", b"@", b"|", b"~", b"^") for x in w) / n, "repeats": sum(a == b for a, b in zip(w, w[1:], strict=False)) / n,
        "n_chars": 0.0 if n_chars is None else log(n_chars, 13.0), "short_lines": sum(len(x) < 40 for x in lines) / many,
    }
    at = [(quality.WORDS + i * quality.STEPS + min(quality.STEPS - 1, int(stats[k] * quality.STEPS)), 0.5) for i, k in enumerate(quality.STATS)]
    tf = {x: math.log(1 + w.count(x)) for x in set(w)}
    norm = math.sqrt(sum(t * t for t in tf.values())) or 1.0
    at += [(zlib.crc32(x) % quality.WORDS, t / norm) for x, t in tf.items()]
    z = model["w0"] + sum(model["w"][i] * x for i, x in at)
    z += sum(float(model["v"][i] @ model["v"][j]) * x * y for a, (i, x) in enumerate(at) for j, y in at[:a])
    return 1 / (1 + math.exp(-min(35.0, max(-35.0, z))))


def test_quality_in_plain_python(spark, documents, odd, sf):
    model = quality.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    some = documents.filter("length(text) < 900").select("doc_id", "text", "n_chars").orderBy("doc_id").limit(40).union(odd.filter("doc_id in (1, 2, 3, 4, 6)").select("doc_id", "text", "n_chars"))
    rows = some.withColumn("k", F.monotonically_increasing_id().cast("long")).cache()
    got = {r.doc_id: r.score for r in quality.score(rows, model, id_col="k").collect()}
    for r in rows.collect():
        assert abs(got[r.k] - plain_quality(model, r.text, r.n_chars)) < 1e-9


def test_quality_odd(spark, odd):
    labels = spark.createDataFrame([(5, 1), (8, 0), (None, 1), (4, None)], "doc_id long, quality int")
    got = quality.score(odd, quality.fit(odd, labels, fold=None)).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score(odd.limit(0), quality.fit(odd, labels.limit(0))).count() == 0


def test_language(spark, documents):
    got = queries.QUERIES["op4_language"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_language_mixture(spark, documents):
    """A document of two languages keeps both, one of one language only that."""
    m = language.fit(documents)
    by = {lang: documents.filter((F.col("lang") == lang) & (F.length("text") > 2000)).first().text[:2000] for lang in ("en", "de")}
    d = spark.createDataFrame([(1, by["en"]), (2, by["en"] + " " + by["de"])], "doc_id long, text string")
    got = {r.doc_id: r for r in language.predict(d, m).collect()}
    assert got[1].n_langs == 1 and got[1].lang_pred == "en" and got[1].score == 1.0
    assert set(got[2].mixture) >= {"en", "de"} and 0.3 < got[2].mixture["en"] < 0.7


def test_language_odd(spark, documents, odd):
    m = language.fit(documents)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(odd, m).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[6][0] in m["langs"]
    none = language.predict(odd, language.fit(odd.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"} and language.predict(odd.limit(0), m).count() == 0
    assert {r.doc_id for r in language.kept_languages(odd, m).collect()} <= {4, 5, 6, 7, 8, 9, None}


def shares(sizes, repeats=3):
    """Targets by resharing the excess round by round."""
    names = sorted((k for k in sizes if k is not None)) + [None] * (None in sizes)
    weight = {k: i % 3 + 1 for i, k in enumerate(names)}
    cap, full, left = {k: repeats * sizes[k] for k in names}, set(), float(sum(sizes.values()))
    while True:
        open_ = [k for k in names if k not in full]
        level = (left - sum(cap[k] for k in full)) / max(1, sum(weight[k] for k in open_))
        over = {k for k in open_ if weight[k] * level > cap[k]}
        if not over:
            return {k: float(cap[k]) if k in full else weight[k] * level for k in names}
        full |= over


def check_mix(rows):
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    want = shares(sizes)
    for k in sizes:
        assert abs(target[k] - want[k]) < 1e-6 * max(1, want[k]) and all(r.source_size == sizes[k] for r in rows if r.source == k)
        assert abs(taken[k] - want[k]) <= 200
    return taken


def test_mix(spark, sf, documents):
    rows = queries.QUERIES["op8_mixing"](spark, sf).collect()
    assert {(r.doc_id, r.size) for r in rows} == {(i, len(brute.words(t))) for i, t in texts(documents)}
    check_mix(rows)
    assert sorted(map(str, rows)) == sorted(map(str, queries.QUERIES["op8_mixing"](spark, sf).collect()))


def test_mix_small_sources(spark, odd):
    rows = [(i, "w " * (5 + i % 7), s) for i, s in enumerate(["a"] * 400 + ["b"] * 3 + ["c"] * 5 + [None] * 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(mixing.mix(d, min_block=1).collect())
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(odd.limit(0)).count() == 0
    assert mixing.mix(odd.filter("doc_id < 3")).agg(F.sum("taken")).first()[0] == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


@pytest.mark.parametrize("params", [{}, {"max_slots": 16}, {"min_block": 8, "max_slots": 1000}])
def test_mix_keeps_rare_sources(spark, params):
    """Sources of a millionth of all words get their words, however many words the others have."""
    rows = [(i, "w " * 500_000, "ab"[i % 2]) for i in range(10)] + [(10, "w " * 5, "c"), (11, "w " * 400, "d"), (12, "w", "e"), (13, "w " * 30, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = check_mix(mixing.mix(d, **params).collect())
    assert all(taken[s] > 0 for s in taken)
    assert {r.source for r in mixing.mixed_documents(d, **params).select("source").distinct().collect()} == set(taken)


def test_slots_stay_apart(spark):
    """Phases of slots beyond 1e11 are as many as slots and as even as ever; arcs of a millionth get their millionth."""
    n, far = 400_000, 260_000_000_000
    slots = mixing.slot_phases(spark, far, n, 65_536)
    assert slots.select("phase").distinct().count() == n
    assert slots.filter(f"slot = {far}").first().phase == (far + 1) * mixing.GOLDEN % mixing.CIRCLE
    cuts = [0, 10**-6, 0.3, 0.3 + 10**-6, 0.30001, 1.0]
    marks = spark.createDataFrame([(f"s{k}", True, int(a * mixing.CIRCLE), int(b * mixing.CIRCLE)) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))] + [("none", True, 5, 5)], "source string, known boolean, lo long, hi long")
    got = mixing.schedule(marks, slots).groupBy("source").agg(F.count("*").alias("n"), F.min("rank").alias("a"), F.max("rank").alias("b")).collect()
    assert all(r.a == 0 and r.b == r.n - 1 for r in got)
    for r in got:
        k = int(r.source[1:])
        assert abs(r.n - n * (cuts[k + 1] - cuts[k])) <= 2


def test_many_sources_share_a_stretch(spark):
    """Thousands of tiny sources beside a large one: each slot falls to the arc that holds its phase."""
    arcs = sorted({0, *(10**9 * k**2 for k in range(1, 3000)), mixing.CIRCLE})
    marks = spark.createDataFrame([(f"s{k}", True, a, b) for k, (a, b) in enumerate(zip(arcs, arcs[1:], strict=False))], "source string, known boolean, lo long, hi long")
    got = mixing.schedule(marks, mixing.slot_phases(spark, 0, 3000, 1000)).collect()
    assert len(got) == 3000
    for r in got:
        k, phase = int(r.source[1:]), (r.slot + 1) * mixing.GOLDEN % mixing.CIRCLE
        assert arcs[k] <= phase < arcs[k + 1]


def test_mixed_order_is_the_mix(spark, documents):
    """The pieces of the schedule are whole blocks, in the order of each source's stream, and add up to what is taken."""
    m = {(r.doc_id): r for r in mixing.mix(documents).collect()}
    pieces = mixing.mixed_order(documents).collect()
    taken, per_slot = {}, {}
    for p in pieces:
        taken[p.doc_id] = taken.get(p.doc_id, 0) + p.words
        per_slot[p.slot] = per_slot.get(p.slot, 0) + p.words
        assert 0 <= p.at and p.at + p.words <= m[p.doc_id].size
    assert taken == {i: r.taken for i, r in m.items() if r.taken}
    assert sum(n == 64 for n in per_slot.values()) >= 0.98 * len(per_slot) and max(per_slot.values()) <= 64
    for s in {p.source for p in pieces}:
        mine = sorted((p.slot, p.lap * m[p.doc_id].source_size + m[p.doc_id].start + p.at) for p in pieces if p.source == s)
        assert [x for _, x in mine] == sorted(x for _, x in mine)


def test_mix_is_native(spark, documents):
    plan = mixing.mix(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("limits", [(16, 64, 1024), (3, 4, 8)])
def test_alike_but_not_linked(spark, monkeypatch, limits):
    """A group whose members differ in five of 120 words, each by one of six: with small limits lists take pivot after pivot, and
    links stay those of all pairs."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(260):
        w = [f"b{i}" for i in range(120)]
        for i in rng.choice(40, 5, replace=False):
            w[i] = f"n{rng.integers(6)}x{i}"
        rows.append((k, " ".join(w)))
    rows += [(260 + k, rows[k][1].replace("b119", f"z{k}")) for k in range(0, 40, 3)]
    for name, value in zip(("SHORT", "SHORT_OUTSIDE", "LONGEST"), limits, strict=True):
        monkeypatch.setattr(minhash, name, value)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near(rows)
