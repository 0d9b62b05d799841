"""The stages on a small table, each against a plain version of what it must keep."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from captrail.llm import language, mixing, secret_scan, sentencepiece

from . import brute

STAGE = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def planted(documents, spark):
    """documents with groups of copies, secrets of one owner and of many, and letterless texts."""
    rng = np.random.default_rng(11)
    word = lambda n: [f"word{x}" for x in rng.integers(0, 4000, n)]
    more, k = [], 100_000
    for g in range(4):
        base = word(80 + 40 * g)
        for _ in range(12):
            w = list(base)
            for i in rng.choice(len(w), int(rng.integers(0, 5)), replace=False):
                w[i] = f"new{int(rng.integers(0, 9))}"
            more.append((k := k + 1, " ".join(w), "en", f"s{k % 5}"))
    key, shared = "api_key = 'Zx81kQ0pLm77aBcD'", "token: q9W8e7R6t5Y4u3I2"
    more += [(k := k + 1, " ".join(word(30)) + f" {key} end", "en", "s1") for _ in range(3)]
    more += [(k := k + 1, " ".join(word(30)) + f" {shared} end", "en", f"o{i}") for i in range(9)]
    more += [(k := k + 1, t, None, "s2") for t in ("12 34 !!", "", None)]
    add = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in more], COLUMNS)
    return documents.unionByName(add.select(documents.columns)).cache()


def test_language_stage(spark, sf, planted):
    planted = planted.filter("text is null or length(text) < 500")
    got = rows(STAGE["language_id"](spark, planted, sf))
    model = language.calibrated(planted, language.fit(planted))

    def stays(text):
        at, n, words = language.ngrams(text)
        if not len(at):
            return False
        p = plain_mixture(at, n, words, model["logp"])
        flat = sum(c * np.log(sum(p[j] * np.exp(float(model["logp"][j, a])) for j in range(len(p)))) for a, c in zip(at, n, strict=True)) / n.sum()
        return flat > max(-15 * np.log(2), model["least"] - 1 - 8 / np.sqrt(n.sum()))

    assert sorted(map(str, got)) == sorted(str(x) for x in rows(planted) if stays(x[1]))


def test_language_stage_is_calibrated(spark, sf, documents):
    """Letters from nowhere and languages that nobody taught go; documents in two or three of the learned ones stay, and so do clean ones."""
    rng = np.random.default_rng(5)
    gibberish = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(n)) for n in (60, 200, 900)]
    foreign = ["Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek. " * k for k in (2, 9)]
    by = {r.lang: r.text for r in documents.filter("length(text) > 1500 and lang is not null").collect()}
    mixed = [" ".join(by[x][:1500] for x in pair) for pair in (("en", "de"), ("fr", "es"), ("en", "fr", "de"))]
    add = [(10**6 + k, t, None, "s", len(t)) for k, t in enumerate(gibberish + foreign + mixed)]
    got = {i for i, _ in rows(STAGE["language_id"](spark, documents.unionByName(spark.createDataFrame(add, COLUMNS)), sf))}
    assert {i - 10**6 for i in got if i >= 10**6} == {5, 6, 7}
    lettered = {r.doc_id for r in documents.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert {i for i in got if i < 10**6} == lettered


def test_language_model_learns_from_all_rows(spark):
    """Of 20,000 rows the n-grams of all outside the fold are counted, and a language that few rows have is learned; the threshold is
    of all rows in the fold."""
    d = spark.range(20_000).selectExpr("id doc_id", "concat('wort ', chr(cast(97 + id % 26 as int)), ' sagt', if(id % 7 = 0, ' viel', '')) text",
                                       "case when id in (17, 8211, 12001) then 'xx' when id % 2 = 0 then 'de' else 'nl' end lang")
    fold = "pmod(crc32(cast(cast(doc_id as string) as binary)), 4)"
    counts = {}
    for r in d.filter(f"{fold} <> 2").collect():
        at, n, _ = language.ngrams(r.text)
        counts.setdefault(r.lang, np.full(1 << language.BITS, 0.5))[at] += n
    model = language.fit(d)
    assert model["langs"] == sorted(counts) == ["de", "nl", "xx"]
    for k, x in enumerate(model["langs"]):
        assert np.allclose(model["logp"][k], np.log(counts[x] / counts[x].sum()), atol=1e-5)
    known = [language.ngrams(r.text) for r in d.filter(f"{fold} = 2").collect()]
    each = [language.likelihood(at, n, language.proportions(at, n, words, model["logp"]), model["logp"]) + 8 / np.sqrt(n.sum()) for at, n, words in known]
    assert len(each) > 4000 and np.isclose(language.calibrated(d, model)["least"], np.quantile(each, 0.001), rtol=1e-9)


def test_language_threshold_is_of_all_rows(spark):
    rng = np.random.default_rng(8)
    for x in (rng.normal(0, 1, 9000), np.repeat([1.0, 2.0, 3.5], 2000), rng.normal(0, 1, 700).round(1), np.append(rng.normal(0, 1, 4000), [-1e9, 1e9]), [4.5]):
        values = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(5)
        for part in (0.0, 0.001, 0.4, 1.0):
            assert np.isclose(language.quantile(values, part), np.quantile(x, part), rtol=1e-12, atol=0)
    assert language.quantile(values.limit(0), 0.001) is None


def test_run_is_the_chain(spark, sf):
    """The rows of run() are those of the stages one after the other, each on what the one before kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).toPandas().to_dict("records"), stage(spark, docs, sf).schema)
    got = corpus_pipeline.run(spark, sf)
    assert got.schema == docs.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))


def plain_mixture(at, n, words, logp, rounds=25):
    """EM and the choice of languages in plain Python."""
    like = [[float(np.exp(float(logp[j, a]))) for a in at] for j in range(len(logp))]
    total, scale = float(sum(n)), max(words, 1) / float(sum(n))

    def em(keep):
        p = {j: 1 / len(keep) for j in keep}
        for _ in range(rounds if len(keep) > 1 else 0):
            new = dict.fromkeys(keep, 0.0)
            for i, c in enumerate(n):
                mix = sum(p[j] * like[j][i] for j in keep)
                for j in keep:
                    new[j] += c * p[j] * like[j][i] / mix / total
            done = max(abs(new[j] - p[j]) for j in keep) < 1e-3
            p = new
            if done:
                break
        return p, scale * sum(c * np.log(sum(p[j] * like[j][i] for j in keep)) for i, c in enumerate(n))

    p, best = em(list(range(len(logp))))
    while len(p) > 1:
        q, fewer = em([j for j in p if j != min(p, key=p.get)])
        if fewer + 0.5 * np.log(max(words, 2)) < best:
            break
        p, best = q, fewer
    return [p.get(j, 0.0) / sum(p.values()) for j in range(len(logp))]


def test_mixture_in_plain_python(documents):
    """The vectorised EM finds the proportions of the plain one, also for texts of two languages."""
    model = language.fit(documents)
    texts = [r.text[:400] for r in documents.filter("length(text) > 300 and lang is not null").orderBy("doc_id").limit(12).collect()]
    for a, b in zip(texts, texts[1:], strict=False):
        at, n, words = language.ngrams(a + " " + b)
        assert np.allclose(language.proportions(at, n, words, model["logp"]), plain_mixture(at, n, words, model["logp"]), atol=1e-3)


def test_near_duplicate_stage(spark, sf, planted):
    got = STAGE["near_duplicates"](spark, planted, sf)
    assert got.columns == planted.columns
    near = brute.near(rows(planted), 5, 80)
    assert sorted(rows(got), key=str) == sorted(((i, t) for i, t in rows(planted) if near[i][1] == i), key=str)


def test_secret_stage(spark, sf, planted):
    got = STAGE["secrets"](spark, planted, sf)
    docs = [(r.doc_id, r.text, r.source) for r in planted.collect()]
    owners, repos, found = defaultdict(set), defaultdict(set), {}
    for i, t, s in docs:
        found[i] = [(f[1], f[2], f[3]) for f in plain_candidates(t)]
        for _, _, v in found[i]:
            owners[v].add(s), repos[v].add(i)
    all_owners, all_repos = len({s for _, _, s in docs if s is not None}), len(docs)
    copied = lambda v: len(owners[v]) >= max(3, np.log2(1 + all_owners)) or len(owners[v]) > 1 and len(repos[v]) >= max(8, np.log2(1 + all_repos))
    want, hidden = [], 0
    for i, t, _ in docs:
        cut = [False] * len(t or "")
        for s, e, v in found[i]:
            if not copied(v) and secret_scan.entropy(v) >= 2.5:
                cut[s:e] = [True] * (e - s)
        out = re.sub("\0+", "[SECRET]", "".join("\0" if c else x for x, c in zip(t or "", cut, strict=True)))
        hidden += any(cut)
        want.append((i, None if t is None else out, None if t is None else len(out)))
    assert hidden >= 3 and any("q9W8e7R6t5Y4u3I2" in (t or "") for _, t, _ in want)
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in got.collect()), key=str) == sorted(want, key=str)


def plain_candidates(text):
    """Base findings by the contract's own patterns, and long unbroken mixed tokens apart from them."""
    t = text or ""
    out = [("assign", m.start(), m.end(), m[2]) for m in re.finditer(brute.ASSIGN, t) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    base = list(out)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", t):
        v = m[0]
        mixed = re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v)
        if len(v) >= 24 and mixed and secret_scan.entropy(v) >= 3.5 and all(e <= m.start() or m.end() <= s for _, s, e, _ in base):
            out.append(("generic", m.start(), m.end(), v))
    return out


def test_mixing_stage(spark, sf, planted):
    """A plain schedule: slots by golden-ratio points, each source's documents in shuffled order, whole documents."""
    got = rows(STAGE["mixing"](spark, planted, sf))
    target = {r.source: (r.lo, r.hi, r.target) for r in mixing.targets(mixing.sizes(planted)).collect()}
    docs = [(r.doc_id, r.text, r.source, len(brute.words(r.text))) for r in planted.collect()]
    total, n = sum(d[3] for d in docs), len(docs)
    slots = defaultdict(int)
    for i in range(-(-total // 64)):
        x = (i + 1) * mixing.GOLDEN % mixing.CIRCLE
        for s, (lo, hi, _) in target.items():
            slots[s] += lo <= x < hi
    want = []
    for s, (_, _, goal) in target.items():
        md5 = lambda i: hashlib.md5(f"mix{i}".encode()).hexdigest()
        mine = sorted((int(md5(i)[:8], 16) % max(1, -(-n // 2048)), md5(i), i, size, t) for i, t, src, size in docs if src == s)
        reach, at, size_of = slots[s] * 64 if slots[s] else min(64, int(np.ceil(goal))), 0, sum(m[3] for m in mine)
        for _, _, i, size, t in mine:
            taken = sum(max(0, min(size, reach - at - lap * size_of)) for lap in range(3))
            want += [(i, t)] * (int(np.ceil(taken / size)) if size else 0)
            at += size
    assert sorted(got, key=str) == sorted(want, key=str)


def test_mixing_stage_without_ids(spark, sf):
    """Rows without ids, and rows of equal text, have laps of their own: the words that the stage emits follow the mix."""
    d = spark.createDataFrame([(None, f"{'w ' * 99}{i // 2}", None, "a", 9) for i in range(400)] + [(k, "x " * 100, None, s, 9) for k, s in enumerate("bc" * 20)], COLUMNS)
    m = mixing.mix(d).collect()
    want = {s: sum(-(-r.taken // r.size) * r.size for r in m if r.source == s) for s in "abc"}
    got = defaultdict(int)
    for r in STAGE["mixing"](spark, d, sf).collect():
        got[r.source] += len(r.text.split())
    assert got == want and abs(got["a"] - next(r.target for r in m if r.source == "a")) <= 200


def test_token_stage(spark, sf, planted):
    """Texts come back from their ids, and no segmentation of a text scores higher, by a dynamic programme over all pieces."""
    model = sentencepiece.load()
    score, text_of = {x: v for _, x, v in model["pieces"]}, {i: x for i, x, _ in model["pieces"]}
    some = planted.filter("length(text) < 3000 or text is null")
    text = dict(rows(some))
    got = STAGE["tokens"](spark, some, sf).collect()
    assert len(got) == some.count() and all(r.round_trip and len(r.ids) == r.n_tokens for r in got)
    plain = [r for r in got if text[r.doc_id] and len(text[r.doc_id]) < 500 and all(i in text_of for i in r.ids)][:40]
    assert len(plain) > 20
    for r in plain:
        marked = sentencepiece.MARK + text[r.doc_id].replace(" ", sentencepiece.MARK)
        best = [0.0] + [-np.inf] * len(marked)
        for e in range(1, len(marked) + 1):
            best[e] = max((best[b] + score[marked[b:e]] for b in range(max(0, e - 40), e) if marked[b:e] in score), default=-np.inf)
        assert "".join(text_of[i] for i in r.ids) == marked and abs(sum(score[text_of[i]] for i in r.ids) - best[-1]) < 1e-4


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_odd(spark, odd):
    """Every stage on odd rows, on none, and on columns named like internal ones."""
    clash = odd.selectExpr("*", "1 as _spans", "2 as _lap", "3 as _laps", "4 as _copies", "5 as _nth", "6 as _source", "7 as _th")
    docs = clash
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        kept = out.collect()
        none = stage(spark, docs.limit(0), "")
        assert none.count() == 0
        if name != "tokens":
            assert out.columns == none.columns == clash.columns
            assert {r.doc_id for r in kept} <= {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "language_id":
            assert not {1, 2, 3} & {r.doc_id for r in kept}
        if name == "secrets":
            assert len(kept) == docs.count()
        docs = out
