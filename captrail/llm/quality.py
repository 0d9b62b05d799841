"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): the pairwise interactions of
all features cost one pass over a document's features (sum-of-squares identity).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, hash_share, renamed

#: Buckets of hashed words; each statistic takes one of STEPS features by its value.
WORDS, STEPS, RANK = 1 << 14, 12, 8
STATS = ("words", "word_length", "distinct", "top_word", "top_line", "upper", "digits", "marks", "punctuated", "lines", "line_words", "odd_ends", "repeats", "n_chars", "short_lines")
N = WORDS + len(STATS) * STEPS
_UPPER, _DIGIT, _MARK = (bytes(c for c in range(256) if c not in drop) for drop in (set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), set(b"0123456789"), set(b"|#*$%&@!~^=<>{}[]\\_")))


def statistics(text: str | None, n_chars: int | None) -> tuple[list[float], Counter]:
    """The structure statistics, each from 0 to 1, and the word counts (bytes) of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    counts = Counter(words)
    n, size = max(len(words), 1), max(len(raw), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    many = max(len(lines), 1)
    ends = sum(1 for w in words if w[-1:] in b"!#*$%&@|~^" and w[-1:])
    logs = lambda x, top: min(1.0, np.log1p(max(x, 0)) / top)
    follow = sum(map(bytes.__eq__, words, words[1:])) / n
    return [
        logs(len(words), 11.0), min(1.0, sum(map(len, words)) / n / 24), len(counts) / n, max(counts.values(), default=0) / n,
        max(Counter(lines).values(), default=0) / many, len(raw.translate(None, _UPPER)) / size, len(raw.translate(None, _DIGIT)) / size,
        min(1.0, 4 * len(raw.translate(None, _MARK)) / size), min(1.0, (raw.count(b".") + raw.count(b",")) / n), logs(len(lines), 8.0),
        min(1.0, n / many / 64), ends / n, follow, logs(n_chars if n_chars is not None else -1, 13.0) if n_chars is not None else 0.0,
        sum(len(x) < 40 for x in lines) / many,
    ], counts


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): the statistics' steps, and the words by their hash with norm 1 in all."""
    stats, counts = statistics(text, n_chars)
    steps = [WORDS + i * STEPS + min(STEPS - 1, int(v * STEPS)) for i, v in enumerate(stats)]
    ids = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) & (WORDS - 1)
    tf = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    if len(ids):
        tf /= np.sqrt((tf * tf).sum())
    return np.concatenate((np.array(steps, np.int64), ids)), np.concatenate((np.full(len(steps), 0.5), tf))


def score_one(model: dict, ids: np.ndarray, x: np.ndarray) -> float:
    v = model["v"][ids] * x[:, None]
    s = v.sum(axis=0)
    z = model["w0"] + float(model["w"][ids] @ x) + 0.5 * float(s @ s - (v * v).sum())
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        both = [features(t.as_py(), c) for t, c in zip(b.column("text"), b.column("n_chars").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([i.astype(np.int32) for i, _ in both], pa.list_(pa.int32())), pa.array([x.astype(np.float32) for _, x in both], pa.list_(pa.float32()))],
                                         names=["doc_id", "y", "ids", "x"])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.15, ridge: float = 2e-5, batch: int = 32, seed: int = 1) -> dict:
    """AdaGrad over mini-batches of (label, ids, values)."""
    rng = np.random.default_rng(seed)
    model = {"w0": 0.0, "w": np.zeros(N), "v": rng.normal(0, 0.02, (N, RANK))}
    gw, gv, g0 = np.full(N, 1e-2), np.full((N, RANK), 1e-2), 1e-2
    for _ in range(epochs if len({y for y, _, _ in rows}) > 1 else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = [rows[i] for i in order[at : at + batch]]
            ids, x = np.concatenate([r[1] for r in part]), np.concatenate([r[2] for r in part]).astype(np.float64)
            starts = np.cumsum([0, *[len(r[1]) for r in part[:-1]]])
            y = np.array([r[0] for r in part], np.float64)
            vx = model["v"][ids] * x[:, None]
            s = np.add.reduceat(vx, starts)
            z = model["w0"] + np.add.reduceat(model["w"][ids] * x, starts) + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), starts))
            err = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) / len(part)
            of = np.repeat(np.arange(len(part)), [len(r[1]) for r in part])
            e = (err[of] * x)[:, None]
            uniq, inv = np.unique(ids, return_inverse=True)
            dw = np.bincount(inv, e[:, 0], len(uniq)) + ridge * model["w"][uniq]
            dv = np.zeros((len(uniq), RANK))
            np.add.at(dv, inv, e * (s[of] - vx))
            dv += ridge * model["v"][uniq]
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            g0 += err.sum() ** 2
            model["w"][uniq] -= rate * dw / np.sqrt(gw[uniq])
            model["v"][uniq] -= 0.3 * rate * dv / np.sqrt(gv[uniq])
            model["w0"] -= rate * err.sum() / np.sqrt(g0)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", label_col: str = "quality",
        fold: tuple[int, int] | None = (3, 1), max_rows: int = 6_000) -> dict:
    """Learns from about max_rows labelled rows (the bound of the sample, chosen by a hash of the id) outside the held-out fold.

    Rows with a null label or id are left out; an id with several labels counts once with the largest. Spark makes the
    features; the sample's sparse features, bounded by max_rows and the text lengths, are fitted on the driver."""
    y = renamed(labels, doc_id=id_col, y=label_col).dropna()
    if fold:
        y = y.filter(crc_fold("doc_id", fold[0]) != fold[1])
    y = y.filter(hash_share("doc_id", min(1.0, max_rows / max(y.count(), 1)))).groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    d = renamed(docs, doc_id=id_col, text=text_col, n_chars=chars_col).select("doc_id", "text", F.col("n_chars").cast("long"))
    dtype = d.schema["doc_id"].dataType.simpleString()
    rows = d.join(F.broadcast(y), "doc_id").mapInArrow(_featured, f"doc_id {dtype}, y int, ids array<int>, x array<float>").toArrow().sort_by("doc_id")
    return train([(t, np.array(i, np.int64), np.array(x)) for t, i, x in zip(rows.column("y").to_pylist(), (c.values.to_numpy() for c in rows.column("ids")), (c.values.to_numpy() for c in rows.column("x")), strict=True)])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """One row per row of docs: doc_id, score (0 to 1, 1 is good). Null text counts as empty; each row is scored by its whole text.

    A model fitted without both labels gives 0.5 to all. The model has a fixed size and travels with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [score_one(model, *features(t.as_py(), c)) for t, c in zip(b.column("text"), b.column("n_chars").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got, pa.float64())], names=["doc_id", "score"])

    d = renamed(docs, doc_id=id_col, text=text_col, n_chars=chars_col).select("doc_id", "text", F.col("n_chars").cast("long"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")
