from __future__ import annotations

import random

import pytest

from plinth.llm.piece_bpe import Encoder, PieceModel, decode, encode, read_model
from plinth.llm.queries import tokenizer_path

PROTO = read_model(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=PROTO)


def both(texts):
    model = PieceModel(PROTO)
    ids, counts = Encoder(model).encode(texts)
    cut, out = 0, []
    for n in counts.tolist():
        out.append(ids[cut : cut + n].tolist())
        cut += n
    return out, model.decode(ids, counts)


def test_as_the_library(library):
    rng = random.Random(2)
    parts = ["a", "b", "th", "er", " ", "  ", "\n", "=", "-", "日", "é", "1", ".", "😀", "▁", "\t", "the", "ing", "\0"]
    texts = ["", " ", "\n", "=" * 3000, "ab" * 3000, " " * 1000 + "x", " " * 15 + "日", " " * 31, "▁▁a", "aaaa  ===== ,,,, ------ "]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    ids, back = both(texts)
    assert ids == library.encode(texts)
    assert back == [library.decode(i) for i in ids]


def test_decodes_any_ids(library):
    import numpy as np

    rng, model = random.Random(3), PieceModel(PROTO)
    for _ in range(300):
        ids = [rng.randrange(32000) for _ in range(20)]
        assert model.decode(np.array(ids), np.array([20])) == [library.decode(ids)]


def test_table(awkward, nothing, rows, library):
    told = decode(encode(awkward, PROTO), PROTO)
    got = sorted(((r["text"], r["ids"], r["decoded"], r["id"]) for r in told.collect()), key=repr)
    want = sorted(((r[1], library.encode(r[1] or ""), library.decode(library.encode(r[1] or "")), r[7]) for r in rows), key=repr)
    assert got == want
    assert decode(encode(nothing, PROTO), PROTO).count() == 0
