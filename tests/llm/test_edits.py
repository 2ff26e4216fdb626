import random

from pyspark.sql import functions as F

from newsalpha.llm.bpe import encoder, public_tokenizer
from newsalpha.llm.edits import CountTree, count_edited, sample_edits, settle

from .conftest import ROWS
from .test_bpe import SIGNS


def test_trees_equal_a_whole_count():
    rng, coder = random.Random(5), encoder(*public_tokenizer())

    def drawn(most):
        return "".join(rng.choice(SIGNS + "dmv   ") for _ in range(rng.randint(0, most)))

    for _ in range(3000):
        text = drawn(rng.choice([0, 3, 20, 60]))
        edits = [{"start": rng.randint(-2, 70), "end": rng.randint(0, 70), "text": drawn(6)} for _ in range(rng.randint(0, 4))]
        tree, new = CountTree(text, coder), text
        for start, end, some in settle(edits, len(text)):
            tree.edit(start, end, some)
            new = new[:start] + some + new[end:]
        pieces = coder.splitter.split(new)
        known = coder.learn(set(pieces))
        assert tree.text == new and tree.pieces() == [(len(p), known[p][1]) for p in pieces]
        assert tree.count == len(pieces)
        assert tree.total == sum(known[p][1] for p in pieces) and tree.chars[1] == len(new)


def test_an_edit_recounts_little():
    coder = encoder(*public_tokenizer())
    tree = CountTree("some words and more of them " * 4000, coder)
    assert 0 < tree.edit(50_000, 50_003, "other") < 12


def test_odd_rows(odd, empty):
    coder = encoder(*public_tokenizer())
    texts = {r[0]: r[1] or "" for r in ROWS}
    rows = count_edited(odd.withColumn("own", sample_edits()), F.col("own"), *public_tokenizer(), keep=["doc_id", "own"]).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        new = texts[r.doc_id]
        for start, end, some in settle([e.asDict() for e in r.own or []], len(new)):
            new = new[:start] + some + new[end:]
        assert r.n_tokens == sum(e[1] for e in next(coder.entries([new])))
        assert sum(r.piece_chars) == len(new) and sum(r.piece_tokens) == r.n_tokens
    assert count_edited(empty, sample_edits(), *public_tokenizer()).collect() == []


def test_null_edits(frame):
    docs = frame([(1, "some text", None), (2, "some text", [None, (None, None, None), (5, None, "x")])],
                 "doc_id long, text string, e array<struct<start: int, end: int, text: string>>")
    rows = count_edited(docs, F.col("e"), *public_tokenizer()).orderBy("doc_id").collect()
    assert [r.n_edits for r in rows] == [0, 2] and sum(rows[1].piece_chars) == 10
