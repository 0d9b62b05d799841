"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

For each end position the automaton's output links list every piece that ends there; each relaxes the best score of its
end from the best score of its start. Characters that no piece covers fall back to byte pieces (or the unknown piece).
The result is the segmentation of the highest total piece score, as the library computes for unigram models.

No piece holds a blank mark after another character, so a text is cut before each run of blanks (and at characters that
no piece holds) and the parts are segmented alone. The distinct parts of a batch advance through the automaton together,
one character at a time, as arrays; parts with rare characters go one by one. Text round-trips exactly: it is not
normalised, and a literal U+2581 in a text is spelled in byte pieces, so that it stays apart from a blank.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import renamed

#: The blank mark, and the default model of the box.
MARK = "\u2581"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Log-score of one byte piece, under that of every piece: bytes are the last resort.
BYTE_COST = 10.0
#: Characters with a column in the dense transition table: the blank mark and the most used ones of the pieces.
COLUMNS = 320
#: Parts that advance together, and the longest that do.
TOGETHER, LONGEST = 8192, 48
#: Texts whose parts are held at once: a worker keeps most of the memory that it ever needed.
SLICE = 250


def load(path: str = MODEL) -> dict:
    """The pieces of a model file, read on the driver: {"pieces", "scores", "bytes", "unk"}; the table is bounded by the file."""
    import sentencepiece as sp

    p = sp.SentencePieceProcessor(model_file=path)
    kinds = [(i, p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size())]
    bytes_of = {int(x[3:5], 16): i for i, x, _ in kinds if p.is_byte(i)}
    normal = [(i, x, s) for i, x, s in kinds if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
    return {"pieces": normal, "bytes": [bytes_of.get(b, -1) for b in range(256)], "unk": p.unk_id()}


class Automaton:
    """Aho-Corasick over the pieces: transitions, output links and the pieces that end in each state."""

    def __init__(self, pieces: list[tuple[int, str, float]]):
        children: list[dict[str, int]] = [{}]
        self.piece, self.size, self.score = [-1], [0], [0.0]
        for i, x, score in pieces:
            at = 0
            for ch in x:
                nxt = children[at].get(ch)
                if nxt is None:
                    nxt = children[at][ch] = len(children)
                    children.append({})
                    self.piece.append(-1), self.size.append(0), self.score.append(0.0)
                at = nxt
            self.piece[at], self.size[at], self.score[at] = i, len(x), score
        self.children = children
        self.fail, self.link = [0] * len(children), [0] * len(children)
        self.order = []
        todo = deque([0])
        while todo:
            at = todo.popleft()
            self.order.append(at)
            for ch, nxt in children[at].items():
                f = self.fail[at] if at else 0
                while at and f and ch not in children[f]:
                    f = self.fail[f]
                self.fail[nxt] = children[f].get(ch, 0) if at else 0
                # The nearest shorter piece that ends here too.
                self.link[nxt] = self.fail[nxt] if self.piece[self.fail[nxt]] >= 0 else self.link[self.fail[nxt]]
                todo.append(nxt)

    def step(self, state: int, ch: str) -> int:
        while state and ch not in self.children[state]:
            state = self.fail[state]
        return self.children[state].get(ch, 0)

    def first(self, state: int) -> int:
        """The state of the longest piece that ends here, 0 if none does."""
        return state if self.piece[state] >= 0 else self.link[state]

    def table(self, columns: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(transitions by (row, column), the row of each state); column 0 is any other character and leads to the root.

        A state that no piece goes on from moves as its fail state does and shares that one's row."""
        t = np.zeros((1 + sum(map(bool, self.children[1:])), len(columns) + 1), np.int32)
        row, used = np.zeros(len(self.children), np.int32), 0
        place = {ch: k + 1 for k, ch in enumerate(columns)}
        for at in self.order:
            row[at] = row[self.fail[at]]
            if at and self.children[at]:
                used += 1
                t[used] = t[row[at]]
                row[at] = used
            for ch, nxt in self.children[at].items():
                k = place.get(ch)
                if k:
                    t[row[at], k] = nxt
        return t, row


class Coder:
    """Encodes and decodes with the pieces of load()."""

    def __init__(self, model: dict):
        pieces = model["pieces"]
        self.unk, self.bytes = model["unk"], model["bytes"]
        self.byte_of = {i: b for b, i in enumerate(self.bytes) if i >= 0}
        self.fallback = min((s for _, _, s in pieces), default=0.0) - BYTE_COST
        self.auto = Automaton(pieces)
        used: dict[str, int] = defaultdict(int)
        for _, x, _ in pieces:
            for ch in x:
                used[ch] += 1
        columns = sorted(used, key=lambda ch: (ch != MARK, -used[ch], ch))[:COLUMNS]
        self.column = np.zeros(0x110000, np.int16)
        self.column[[ord(ch) for ch in columns]] = np.arange(1, len(columns) + 1)
        self.table, self.row = self.auto.table(columns)
        self.first = np.array([self.auto.first(s) for s in range(len(self.auto.piece))], np.int32)
        self.link, self.piece = np.array(self.auto.link, np.int32), np.array(self.auto.piece, np.int32)
        self.size, self.score = np.array(self.auto.size, np.int32), np.array(self.auto.score)
        # Parts begin at runs of blanks; what no piece holds stands alone; a literal mark always does.
        alone = MARK + "".join(ch for ch in "\n\t\r" if ch not in used)
        self.alone = set(alone)
        self.cut = re.compile(f" *[^ {alone}]+| +|[{alone}]") if not any(MARK in x.lstrip(MARK) for _, x, _ in pieces) else re.compile(f"[^{alone}]+|[{alone}]")
        n = max([i for i, _, _ in pieces] + list(self.byte_of), default=0) + 1
        raw = [b"\xef\xbf\xbd"] * n
        for i, x, _ in pieces:
            raw[i] = x.replace(MARK, " ").encode()
        for i, b in self.byte_of.items():
            raw[i] = bytes([b])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_at = np.concatenate(([0], np.cumsum(self.raw_size)[:-1]))

    def spelled(self, text: str) -> list[int]:
        """The byte pieces of a text; the unknown piece where the model has none."""
        return [self.bytes[b] if self.bytes[b] >= 0 else self.unk for b in text.encode("utf-8", "surrogatepass")]

    def segment(self, part: str) -> list[int]:
        """The ids of the best segmentation of one part, character by character."""
        if part in self.alone:
            return self.spelled(part)
        s = part.replace(" ", MARK)
        best, back, state, auto = [0.0], [(0, -1)], 0, self.auto
        for end, ch in enumerate(s, 1):
            score, origin = best[end - 1] + self.fallback * len(part[end - 1].encode("utf-8", "surrogatepass")), (end - 1, -1)
            state = auto.step(state, ch)
            u = auto.first(state)
            while u:
                got = best[end - auto.size[u]] + auto.score[u]
                if got > score:
                    score, origin = got, (end - auto.size[u], auto.piece[u])
                u = auto.link[u]
            best.append(score), back.append(origin)
        out, at = [], len(s)
        while at:
            start, i = back[at]
            out += [i] if i >= 0 else self.spelled(part[start:at])[::-1]
            at = start
        return out[::-1]

    def segment_all(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts, first id of each part and the end): parts of usual characters advance together."""
        out: list = [None] * len(parts)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        order = np.argsort(-sizes, kind="stable")
        order = order[np.searchsorted(-sizes[order], -LONGEST) :]
        alone = np.fromiter((p in self.alone for p in parts), bool, len(parts))
        for k in np.flatnonzero((sizes > LONGEST) | alone).tolist():
            out[k] = self.segment(parts[k])
        order = order[~alone[order]]
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            self._together(parts, some, sizes[some], out)
        lens = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.concatenate([np.asarray(x, np.int32) for x in out]) if out else np.zeros(0, np.int32)
        return flat, np.concatenate(([0], np.cumsum(lens)))

    def _together(self, parts: list[str], some: np.ndarray, sizes: np.ndarray, out: list) -> None:
        """Viterbi over parts of falling size, one character of all of them at a time."""
        n, longest = len(some), int(sizes[0])
        text = "".join([parts[k] for k in some.tolist()]).replace(" ", MARK)
        codes = self.column[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        best, origin, piece = np.zeros((longest + 1, n)), np.zeros((longest + 1, n), np.int16), np.full((longest + 1, n), -1, np.int32)
        state, odd = np.zeros(n, np.int32), np.zeros(n, bool)
        live = np.searchsorted(-sizes, -np.arange(longest + 1), side="right")  # parts of at least so many characters
        for end in range(1, longest + 1):
            m = live[end]
            c = codes[starts[:m] + end - 1]
            odd[:m] |= c == 0
            state[:m] = self.table[self.row[state[:m]], c]
            score, who = best[end - 1, :m] + self.fallback, np.arange(m)
            u = self.first[state[:m]]
            while True:
                more = u > 0
                if not more.all():
                    who, u = who[more], u[more]
                if not len(u):
                    break
                got = best[end - self.size[u], who] + self.score[u]
                better = got > score[who]
                w, v = who[better], u[better]
                score[w], origin[end, w], piece[end, w] = got[better], self.size[v], self.piece[v]
                u = self.link[u]
            best[end, :m] = score
        at, ids, whose = sizes.copy(), [], []
        left = np.arange(n)
        while len(left):
            i = piece[at[left], left]
            odd[left[i < 0]] = True
            left = left[i >= 0]
            i = i[i >= 0]
            ids.append(i), whose.append(left)
            at[left] -= origin[at[left], left]
            left = left[at[left] > 0]
        # Ids were found from the end: a stable sort by part of the reversed rounds puts them in order.
        whose, ids = np.concatenate(whose[::-1]), np.concatenate(ids[::-1])
        by = np.argsort(whose, kind="stable")
        ends = np.searchsorted(whose[by], np.arange(n + 1))
        ids = ids[by]
        for k, p in enumerate(some.tolist()):
            out[p] = self.segment(parts[p]) if odd[k] else ids[ends[k] : ends[k + 1]]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each whole text; null and empty texts have none. The model puts a blank before a text."""
        # Numbered by a counter, not by the table's own length: a table that refers to itself stays in a worker after its batch.
        seen: defaultdict[str, int] = defaultdict(count().__next__)
        number = seen.__getitem__
        each = [np.fromiter(map(number, self.cut.findall(" " + t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        flat, ends = self.segment_all(list(seen))
        return [gathered(flat, ends[:-1], ends[1:] - ends[:-1], x) for x in each]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text: marks of pieces are blanks, runs of byte pieces are UTF-8, the first blank is dropped."""
        ids = np.asarray(ids, np.int64)
        return gathered(self.raw, self.raw_at, self.raw_size, ids).tobytes()[1:].decode("utf-8", "surrogatepass") if len(ids) else ""


def gathered(flat: np.ndarray, at: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The pieces flat[at[i] : at[i] + size[i]] for each i of which, one after the other."""
    n = size[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(at[which] - (ends - n), n)]


@lru_cache(maxsize=2)
def _coder(key: str) -> list:
    return []


def coder(model: dict, key: str) -> Coder:
    """One coder a worker and model."""
    held = _coder(key)
    if not held:
        held.append(Coder(model))
    return held[0]


def _key(model: dict) -> str:
    return hashlib.sha256(repr((model["pieces"], model["bytes"], model["unk"])).encode()).hexdigest()


def encode(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, n_bytes (byte pieces), ids_sha256 (of the ids as little-endian 32-bit
    integers), round_trip, and ids if wanted.

    round_trip: decoding the ids gives the text again; it is true for null and empty texts, which have no tokens. False
    only if the model has no byte pieces and a character is unknown. Repeated rows and ids are encoded each."""
    spark, key = docs.sparkSession, _key(model)
    held = spark.sparkContext.broadcast(model)  # bounded by the model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(held.value, key)
        is_byte = np.zeros(len(c.raw_size) + 1, bool)
        is_byte[list(c.byte_of)] = True
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                texts = part.column("text").to_pylist()
                ids = c.encode_all(texts)
                cols = [
                    part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([c.decode(x) == (t or "") for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                ]
                names = ["doc_id", "n_tokens", "n_bytes", "ids_sha256", "round_trip"]
                if keep_ids:
                    cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    d = renamed(docs, doc_id=id_col, text=text_col)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_bytes long, ids_sha256 string, round_trip boolean" + ", ids array<int>" * keep_ids)


def decode(tokens: DataFrame, model: dict, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of tokens: doc_id, text. Null ids give a null text, no ids an empty one."""
    spark, key = tokens.sparkSession, _key(model)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(held.value, key)
        for b in batches:
            texts = [None if x.as_py() is None else c.decode(x.as_py()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    t = renamed(tokens, doc_id=id_col, ids=ids_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, text string")
