"""Dropout is drawn for every occurrence of a word and every copy of a document."""

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as P
from starmart.llm.pieces import Encoder, PieceModel

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PIECES)


def test_every_occurrence_draws_its_own(model):
    n, word = 3000, "understandable"
    encoder = Encoder(model, 0.3, 5)
    texts = [" ".join([word] * n), word]
    flat, count = encoder.encode(texts, np.array([9, 10], np.uint64))
    assert flat.size == count.sum()
    turns = np.random.default_rng(0).integers(0, 1 << 62, n).astype(np.uint64)
    pieces, sizes = encoder.encode_words(["\u2581" + word] * n, turns)
    split = {tuple(p.tolist()) for p in np.split(pieces, np.cumsum(sizes)[:-1])}
    got, words, held = set(), 0, []
    for i in flat[:count[0]].tolist():
        piece = model.bytes[i]
        if piece.startswith(b" ") and held:
            got.add(tuple(held))
            held = []
        words += piece.startswith(b" ")
        held.append(i)
    assert words == n and len(split) > 8 and len(got) > 8


def test_shared_words_equal_single_ones(model):
    """What is taken from the pass without dropout is what its own agenda gives."""
    text = "the understandable " * 50 + "x" * 200 + " " + "ab" * 90
    for dropout in (0.05, 0.4, 1.0):
        encoder = Encoder(model, dropout, 3)
        whole = encoder.encode([text], np.array([4], np.uint64))[0].tolist()
        encoder._varied = lambda wanted, turns, log: np.arange(len(wanted))
        assert encoder.encode([text], np.array([4], np.uint64))[0].tolist() == whole


def test_copies_of_a_document_get_other_pieces(spark):
    text = " ".join(["understandable complications everywhere"] * 60)
    docs = spark.createDataFrame([(1, text)] * 3, "doc_id long, text string")
    assert len({tuple(r["pieces"]) for r in P.pieces(spark, docs, "").collect()}) == 3
