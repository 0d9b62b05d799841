"""Language identification by multilingual mixture inference.

Each language has a smoothed distribution over hashed character n-grams of one, two and three letters. A document's
n-grams are taken as draws from a mixture of the languages; expectation-maximisation estimates the proportions. Languages
leave the set one by one, the smallest proportion first, as long as the penalised likelihood (log-likelihood less half
the number of languages times the log of the number of words) rises. The largest proportion names the document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, crc_fold, renamed

#: Bits of the n-gram hash.
BITS = 15


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _hashed(text: str | None) -> tuple[np.ndarray, int]:
    """(the hash of each n-gram, words): lower-case letters, all else one blank between words."""
    if not text:
        return np.zeros(0, np.uint32), 0
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return np.zeros(0, np.uint32), 0
    c = np.where(is_letter, codes, 0).astype(np.uint32)
    c = np.concatenate(([np.uint32(0)], c, [np.uint32(0)]))
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    c = c[keep]
    words = int(((c[1:] != 0) & (c[:-1] == 0)).sum())
    one = c * np.uint32(2654435761)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(2246822519) + one[1:] + np.uint32(1)
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(3266489917) + one[2:] + np.uint32(2)
    return np.concatenate((one[c != 0], two, three)) >> np.uint32(32 - BITS), words


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashed n-grams, counts, words) of a text."""
    h, words = _hashed(text)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0), 0
    counts = np.bincount(h, minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at].astype(np.float64), words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    held: dict[str, list[np.ndarray]] = defaultdict(list)

    def add(lang: str) -> None:
        totals[lang] = totals.get(lang, 0) + np.bincount(np.concatenate(held.pop(lang)), minlength=1 << BITS)

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
            held[lang].append(_hashed(text.as_py())[0])
            if len(held[lang]) == 64:
                add(lang)
    for lang in list(held):
        add(lang)
    for lang, t in totals.items():
        at = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(t[at].astype(np.int64))], names=["lang", "gram", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fold: tuple[int, int] | None = (4, 2)) -> dict:
    """The model: languages and the log-probability of each n-gram in each.

    Learns from all rows with a language and a text outside the held-out fold. Only counts by language and n-gram reach the
    driver: languages times 2^BITS at most."""
    d = renamed(docs, doc_id=id_col, text=text_col, lang=lang_col).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if fold:
        d = d.filter(crc_fold("doc_id", fold[0]) != fold[1])
    rows = d.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    table = np.full((len(names), 1 << BITS), 0.5)
    place = {x: i for i, x in enumerate(names)}
    np.add.at(table, ([place[x] for x in rows.column("lang").to_pylist()], rows.column("gram").to_numpy()), rows.column("n").to_numpy())
    return {"langs": names, "logp": np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)}


def proportions(at: np.ndarray, n: np.ndarray, words: int, logp: np.ndarray, rounds: int = 25) -> np.ndarray:
    """The languages' proportions, summing to 1; languages outside the chosen set have 0."""
    k = logp.shape[0]
    ll = logp[:, at]
    top = ll.max(axis=0)
    like = np.exp(ll - top)
    total = n.sum()
    # n-grams overlap, so a word counts as one draw: likelihoods are scaled to the number of words.
    scale = max(words, 1) / total

    def em(keep: np.ndarray) -> tuple[np.ndarray, float]:
        part, p = like[keep], np.full(len(keep), 1 / len(keep))
        if len(keep) == 1:
            return p, float(n @ (np.log(part[0] + 1e-300) + top)) * scale
        for _ in range(rounds):
            mix = p @ part
            new = p * (part @ (n / mix)) / total
            done = np.abs(new - p).max() < 1e-3
            p = new
            if done:
                break
        return p, float(n @ (np.log(p @ part) + top)) * scale

    keep = np.arange(k)
    p, fit_ll = em(keep)
    penalty = 0.5 * np.log(max(words, 2))
    while len(keep) > 1:
        fewer = np.delete(keep, p.argmin())
        q, ll_fewer = em(fewer)
        if ll_fewer + penalty < fit_ll:
            break
        keep, p, fit_ll = fewer, q, ll_fewer
    out = np.zeros(k)
    out[keep] = p / p.sum()
    return out


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score (its proportion), n_langs, mixture map<string,double>.

    Null or empty text, or text without a letter: 'und', score 0, no languages. Ties go to the first language by name.
    With a model of no languages all is 'und'. The model has a fixed size and travels with the task."""
    langs, logp = model["langs"], model["logp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score, count, mixes = [], [], [], []
            for text in b.column("text"):
                at, n, words = ngrams(text.as_py())
                if not len(at) or not langs:
                    pred.append("und"), score.append(0.0), count.append(0), mixes.append([])
                    continue
                p = proportions(at, n, words, logp)
                best = int(p.argmax())
                pred.append(langs[best]), score.append(min(1.0, float(p[best]))), count.append(int((p > 0).sum()))
                mixes.append([(x, float(v)) for x, v in zip(langs, p, strict=True) if v > 0])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(count, pa.int32()), pa.array(mixes, pa.map_(pa.string(), pa.float64()))],
                                             names=["doc_id", "lang_pred", "score", "n_langs", "mixture"])

    d = renamed(docs, doc_id=id_col, text=text_col)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, n_langs int, mixture map<string,double>")


def likelihood(at: np.ndarray, n: np.ndarray, p: np.ndarray, logp: np.ndarray) -> float:
    """The mean log-likelihood of a document's n-grams in the mixture p."""
    ll = logp[:, at].astype(np.float64)
    top = ll.max(axis=0)
    return float(n @ (np.log(p @ np.exp(ll - top) + 1e-300) + top)) / float(n.sum())


#: The mean log-likelihood of n-grams that come from nowhere: each of the hashes is as likely. No document has to be better explained
#: than by CHANCE less than the worst of the known ones, and by SPREAD / sqrt(n-grams) less, as short documents scatter.
FLAT = -BITS * float(np.log(2))
CHANCE, SPREAD, WORST = 1.0, 8.0, 0.001


#: Bins that a quantile is looked for in at a time.
BINS = 1024


def quantile(values: DataFrame, part: float) -> float | None:
    """That quantile of all numbers in column v, between neighbours by their distance; None without rows. The bins of a range are
    counted, then those of the bin that holds the wanted rank, so no more than BINS numbers reach the driver at once."""
    n = values.count()
    if not n:
        return None
    place = part * (n - 1)
    rank = k = int(place)
    inside = values
    while n > BINS:
        low, high = inside.agg(F.min("v"), F.max("v")).first()
        if low == high:
            break
        number = F.least(F.floor((F.col("v") - low) * (BINS / (high - low))), F.lit(BINS - 1))
        for at, n in sorted(inside.groupBy(number.alias("bin")).count().collect()):
            if k < n:
                break
            k -= n
        inside = inside.filter(number == at)
    low = low if n > BINS else sorted(x for (x,) in inside.collect())[k]
    upto, above = values.agg(F.count_if(F.col("v") <= low), F.min(F.when(F.col("v") > low, F.col("v")))).first()
    after = low if upto > rank + 1 or above is None else above
    return low + (after - low) * (place - rank)


def calibrated(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fold: tuple[int, int] = (4, 2)) -> dict:
    """The model with `least`, the mean log-likelihood that all but WORST of known documents reach: of all rows with a language that
    the model knows, in the fold that it has not learned from. Without such rows it is FLAT. One number of each is stored."""
    d = renamed(docs, doc_id=id_col, text=text_col, lang=lang_col).filter(F.col("lang").isin(model["langs"]) & F.col("text").isNotNull() & (crc_fold("doc_id", fold[0]) == fold[1])).select("text")
    logp = model["logp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for text in b.column("text"):
                at, n, words = ngrams(text.as_py())
                if len(at):
                    found.append(likelihood(at, n, proportions(at, n, words, logp), logp) + SPREAD / float(np.sqrt(n.sum())))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64())], names=["v"])

    tables = Tables(docs.sparkSession, "calibration")
    least = quantile(tables.put(d.mapInArrow(run, "v double"), "values"), WORST)
    tables.drop_all()
    return model | {"least": FLAT if least is None else least}


def explained(model: dict, at: np.ndarray, n: np.ndarray, words: int) -> bool:
    """Whether a mixture of the learned languages explains a document about as well as it does known ones, and better than chance."""
    if not len(at) or not model["langs"]:
        return False
    least = max(FLAT, model.get("least", FLAT) - CHANCE - SPREAD / float(np.sqrt(n.sum())))
    return likelihood(at, n, proportions(at, n, words, model["logp"]), model["logp"]) > least


def kept_languages(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """docs without the rows that have no language: null, empty or letterless text, or text that no mixture of the learned
    languages explains, by the model's calibration. A document in several languages stays.

    Repeated rows have the same verdict; an empty table gives no rows; with a model of no languages none is left. The
    verdict is taken in the same pass over the rows, so nothing is joined or shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([explained(model, *ngrams(t.as_py())) for t in b.column(text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
