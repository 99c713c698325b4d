"""SentencePiece operators against the library."""

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from clickguard.llm import pieces
from clickguard.llm.queries import MODEL

ODD = ["", " ", "  two  spaces ", "line\n\nbreaks\ttabs", "emoji 😀 中文字符 ﬁ é", "<s> </s> <unk> <0x41>", "\0a",
       "x" * 700, "ab" * 400, "def f(x):\n    return  x+1", "a" * 40 + " " + "中" * 50]


def texts(n=300):
    r = random.Random(1)
    letters = "etaoin shrdlu \nABC.,19中x"
    return ODD + ["".join(r.choice(letters) for _ in range(r.randrange(1, 90))) for _ in range(n)]


def test_bpe_equals_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    codec = pieces.Codec(pieces.Vocabulary(MODEL))
    many = texts()
    ids, n = codec.encode(many)
    for _ in range(2):  # remembered words give the same
        cut = np.r_[0, np.cumsum(n)]
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == sp.encode(many)
        assert codec.decode(ids, n) == many
        ids, n = codec.encode(many)


def test_caches_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 10)
    monkeypatch.setattr(pieces, "CACHED_PAIRS", 10)
    monkeypatch.setattr(pieces, "STEP_CELLS", 64)
    codec, sp = pieces.Codec(pieces.Vocabulary(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t in texts(60):
        assert codec.encode([t])[0].tolist() == sp.encode(t)


def model_file(path, kind, norm=True, byte_fallback=False):
    """A small model by hand."""
    m = pb.ModelProto()
    m.trainer_spec.model_type = kind
    m.trainer_spec.byte_fallback = byte_fallback
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.remove_extra_whitespaces = not norm
    for piece, t in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        m.pieces.add(piece=piece, score=0, type=t)
    words = ["▁the", "the", "▁th", "he", "in", "ing", "▁a", "an", "and", "▁and", "th", "▁▁", "nd", "er", "▁in"]
    for i, w in enumerate(words):
        m.pieces.add(piece=w, score=-1.0 - 0.37 * i if kind == pieces.UNIGRAM else -i)
    for i, c in enumerate("▁abcdeghinrt"):
        m.pieces.add(piece=c, score=-7.0 - 0.11 * i if kind == pieces.UNIGRAM else -100 - i)
    path.write_bytes(m.SerializeToString())
    return str(path)


@pytest.mark.parametrize("kind", [pieces.UNIGRAM, pieces.BPE])
def test_small_models_equal_library(tmp_path, kind):
    path = model_file(tmp_path / "m.model", kind)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    codec = pieces.Codec(pieces.Vocabulary(path))
    r = random.Random(2)
    many = ["the and in", "", "  thing", "zzz the z zz"] + [
        "".join(r.choice("the andi ngerz") for _ in range(r.randrange(1, 40))) for _ in range(400)]
    ids, n = codec.encode(many)
    cut = np.r_[0, np.cumsum(n)]
    got = [ids[a:b].tolist() for a, b in zip(cut, cut[1:])]
    assert got == sp.encode(many)
    assert codec.decode(ids, n) == sp.decode(got)


def test_unsupported_models_raise(tmp_path):
    with pytest.raises(ValueError):
        pieces.Vocabulary(model_file(tmp_path / "m.model", pieces.UNIGRAM, norm=False))


def test_tables(spark):
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "no id"), (1, "Hello world"), (4, "é😀 " * 30_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, id int, n_tokens int")
    got = pieces.encode(docs, MODEL, check=True)
    out = got.collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for (i, t), r in zip(rows, out):
        assert r.doc_id == i
        assert r.token_ids == (None if t is None else sp.encode(t))
        assert r.n_tokens == (None if t is None else len(r.token_ids)) and r.round_trip in (None, True)
    assert [tuple(r) for r in pieces.decode(got, MODEL).collect()] == rows
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
    assert pieces.decode(got.limit(0), MODEL).count() == 0
