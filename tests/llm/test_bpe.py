import random

import pytest
import tiktoken

from newsalpha.llm.bpe import encode, encoder, public_tokenizer

from .conftest import ROWS

SIGNS = "ab é'stredl \n\t\x85\xa0\x1c\x1d0123½²ªº.,:=你好אá​　😀_-İſ "


@pytest.fixture(scope="module")
def coder():
    return encoder(*public_tokenizer())


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizer()[1], mergeable_ranks=coder.words.ranks, special_tokens={})


def ids_of(coder, texts):
    return [[int(i) for e in entries for i in e[0].split(",")] for entries in coder.entries(texts)]


def test_ids_are_those_of_the_reference_encoder(coder, reference):
    rng = random.Random(1)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(c for c in text if ord(c) < 0x250) for text in texts]
    assert ids_of(coder, texts) == [reference.encode_ordinary(text) for text in texts]


def test_many_and_single_pieces_merge_alike(coder, reference):
    rng = random.Random(2)
    pieces = ["".join(rng.choice("thereandouingéü") for _ in range(rng.randint(1, 40))).encode() for _ in range(3000)]
    together = coder.words.encode(pieces)
    assert together == [coder.words.encode([piece])[0] for piece in pieces]
    assert together == [reference.encode_ordinary(piece.decode()) for piece in pieces]


def test_long_piece(coder, reference):
    text = "a" * 20_000 + "thereandüon" * 2_000
    assert ids_of(coder, [text]) == [reference.encode_ordinary(text)]


def test_round_trip_of_odd_rows(odd, empty, reference):
    rows = encode(odd, *public_tokenizer(), keep=["doc_id"]).collect()
    texts = {r[0]: r[1] or "" for r in ROWS}
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.ids == reference.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode()
    assert encode(empty, *public_tokenizer()).collect() == []
