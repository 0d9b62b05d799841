"""The piece coder against the library and by exact round trips."""

import gc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from captrail.llm import sentencepiece as own


@pytest.fixture(scope="module")
def model():
    return own.load()


@pytest.fixture(scope="module")
def coder(model):
    return own.Coder(model)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁abctheing\0é"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_round_trip(coder, text):
    assert coder.decode(coder.encode(text)) == text


def test_together_as_alone(coder, documents):
    rows = [r.text for r in documents.select("text").limit(40).collect()]
    for t, ids in zip(rows, coder.encode_all(rows), strict=True):
        assert [i for p in coder.cut.findall(" " + t) for i in coder.segment(p)] == ids.tolist()


def test_best_score(coder, model):
    """No segmentation into pieces scores higher, by a plain dynamic programme over all pieces."""
    score = {x: s for _, x, s in model["pieces"]}
    text_of = {i: x for i, x, _ in model["pieces"]}
    for word in ("thblethan", "the", "einheitung", "ciónmente"):
        s = own.MARK + word
        best = [0.0] + [-np.inf] * len(s)
        for e in range(1, len(s) + 1):
            best[e] = max((best[b] + score[s[b:e]] for b in range(e) if s[b:e] in score), default=-np.inf)
        ids = coder.encode(word)
        assert "".join(text_of[i] for i in ids) == s and abs(sum(score[text_of[i]] for i in ids) - best[-1]) < 1e-6


def test_as_the_library(coder, model, tmp_path):
    """The library's own unigram segmentation of the same pieces scores no higher."""
    import sentencepiece as sp

    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = pb.ModelProto()
    m.ParseFromString(open(own.MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    (tmp_path / "u.model").write_bytes(m.SerializeToString())
    lib = sp.SentencePieceProcessor(model_file=str(tmp_path / "u.model"))
    score = {i: s for i, _, s in model["pieces"]}
    for t in ("the quick brown fox", "einheit und freiheit", "la ciónmente"):
        assert sum(score[i] for i in lib.encode(t)) <= sum(score[i] for i in coder.encode(t))


def test_frames(spark, odd, model):
    got = own.encode(odd, model)
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.round_trip for r in rows)
    texts = sorted(str((r.doc_id, r.text)) for r in own.decode(got, model).collect())
    assert texts == sorted(str((r.doc_id, r.text or "")) for r in odd.select("doc_id", "text").collect())
    assert own.encode(odd.limit(0), model).count() == 0


def coder_of_marks():
    return own.Coder(own.load())


def test_without_bytes():
    c = own.Coder({"pieces": [(1, own.MARK + "a", -1.0), (2, "b", -1.0)], "bytes": [-1] * 256, "unk": 0})
    assert coder_of_marks().decode(coder_of_marks().encode("\u2581 x\u2581")) == "\u2581 x\u2581"
    assert c.encode("ab") == [1, 2] and c.encode("ac") == [1, 0] and own.Coder({"pieces": [], "bytes": [-1] * 256, "unk": 0}).encode("x") == [0, 0]


def test_batches_leave_nothing_behind(coder):
    """What a batch needed goes with it, without waiting for the collector of cycles, which seldom runs beside the pieces."""
    gc.collect()
    coder.encode_all(["some words of a text", None, "", "other words"])
    assert gc.collect() == 0


def test_rows_of_the_table(coder):
    """A row of transitions for the root and each state that a piece goes on from; all states move as the automaton steps."""
    auto = coder.auto
    assert len(coder.table) <= 1 + sum(map(bool, auto.children))
    small = own.Automaton([(1, "ab", 0.0), (2, "abc", 0.0), (3, "bca", 0.0), (4, "c", 0.0)])
    table, row = small.table(["a", "b", "c"])
    assert [[int(table[row[at], k]) for k in range(4)] for at in range(len(row))] == [[0, *(small.step(at, ch) for ch in "abc")] for at in range(len(row))]
    assert len(table) == 5 and len(row) == 8
