"""SentencePiece: the library's encoding, the plain agenda, exact round trips."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import pieces

TEXTS = ["", "Hello  world", " lead", "trail ", "\n\n a\tb", "日本語テキスト 🎉 é\x00\x1c", "x" * 300, "a▁b ▁", "aaaa" * 40 + " " + "日本" * 40,
         None, "The quick brown fox. " * 50]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model()


def test_no_dropout_is_the_library(model):
    from sentencepiece import SentencePieceProcessor

    sp, own = SentencePieceProcessor(model_proto=model), pieces.Pieces(model)
    got = own.encode_batch(pa.array(TEXTS), np.arange(len(TEXTS))).to_pylist()
    for t, ids in zip(TEXTS, got, strict=True):
        if t is None:
            assert ids is None
        elif pieces.SPACE not in t:
            assert ids == sp.encode(t) == own.encode(t)


def test_batch_is_the_agenda(model):
    own = pieces.Pieces(model, 0.3, 8)
    keys = np.arange(len(TEXTS)) * 7919
    got = own.encode_batch(pa.array(TEXTS), keys)
    assert [x for x in got.to_pylist()] == [None if t is None else own.encode(t, k) for t, k in zip(TEXTS, keys.tolist(), strict=True)]
    assert own.decode_batch(got).to_pylist() == TEXTS


_MODEL = []


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=40), st.integers(0, 2**40), st.sampled_from([0.0, 0.1, 0.7, 0.999]))
def test_round_trip(text, key, dropout):
    if not _MODEL:
        _MODEL.append(pieces.read_model())
    own = pieces.Pieces(_MODEL[0], dropout, 4)
    ids = own.encode_batch(pa.array([text.encode("utf-8", "ignore").decode()]), np.array([key]))
    assert own.decode_batch(ids).to_pylist() == [text.encode("utf-8", "ignore").decode()]


def test_frame(spark, model):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "null id", "c"), (1, "Hello  world", "c"), (50, "w " * 30000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    enc = pieces.encode(docs, model)
    again = {(r.doc_id, tuple(r.ids or ())) for r in enc.collect()}
    out = pieces.decode(enc, model).collect()
    assert sorted(str((r.doc_id, r.text)) for r in out) == sorted(str(r[:2]) for r in rows)
    assert {(r.doc_id, tuple(r.ids or ())) for r in out} == again and len(out) == len(rows)
    assert all(r.n_ids == (len(r.ids) if r.ids is not None else None) for r in out)
    varied = pieces.encode(docs, model, seed=12).collect()
    assert {(r.doc_id, tuple(r.ids or ())) for r in varied} != again
    assert pieces.encode(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []
