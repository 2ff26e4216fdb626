import re

import pytest

import corpus_pipeline
from newsalpha.llm.bpe import encoder, public_tokenizer
from newsalpha.llm.common import prepare

from .conftest import ROWS, SAME, SCHEMA

LEAK = "which river flows through the old town of the two towers. It is the small one."
ENGLISH = [f"the {a} of the {b} went to the house and saw that the {c} was there with them in the morning" for a, b, c in
           [("king", "north", "fire"), ("ship", "west", "light"), ("wind", "east", "door"), ("man", "city", "water")]]
GERMAN = [f"der {a} ist nicht mit dem {b} und die {c} auch eine von den alten in der nacht" for a, b, c in
          [("koch", "mann", "frau"), ("wald", "hund", "katze"), ("tag", "weg", "stadt"), ("stein", "berg", "blume")]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    near = " ".join(f"word{i} and" for i in range(60))
    rows = [(100 + i, text, "en", "s", len(text)) for i, text in enumerate(ENGLISH)] + [(200 + i, text, "de", "s", len(text)) for i, text in enumerate(GERMAN)]
    rows += [
        (300, ENGLISH[0], "en", "t", 1),
        (301, "a new first line of this text here\n" + GERMAN[1].upper() + "\n\nand the last line is new too", "en", "t", 1),
        (302, "before it the words\n" + LEAK + "\nand after it more words", "en", "t", 1),
        (303, near, "en", "t", 1), (304, near.replace("word7 ", "other "), "en", "t", 1),
        (305, "12345 !!", "en", "t", 1), (306, None, "en", "t", 1),
    ]
    prepare(spark).createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, LEAK), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def test_stages_and_their_decisions(spark, folder):
    path, rows = folder
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, path)
        if name != "byte_bpe":
            assert made.columns == docs.columns and made.dtypes == docs.dtypes
        docs = spark.createDataFrame(made.collect(), made.schema)
        seen.append({r.doc_id: r for r in docs.collect()})
    every = {r[0] for r in rows}
    languages, lines, near, clean, ids = seen
    assert set(languages) == every - {305, 306}
    assert set(lines) == set(languages)
    assert lines[300].text == "" and lines[300].n_chars == 0
    assert lines[301].text == "a new first line of this text here\n\nand the last line is new too"
    assert lines[301].n_chars == len(lines[301].text) and lines[304].text == ""
    assert set(near) == set(lines) and set(clean) == set(near) - {302}
    coder = encoder(*public_tokenizer())
    for i, row in ids.items():
        assert row.n_tokens == sum(e[1] for e in next(coder.entries([clean[i].text])))


def test_run_gives_the_last_stage(spark, folder):
    found = corpus_pipeline.run(spark, folder[0])
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert found.count() == len(folder[1]) - 3


def test_near_duplicates_go_but_one(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*words[:50], f"x{i}", *words[50:]]), "en", "s", 1) for i in range(5)] + [(9, "quite another text of six words", "en", "s", 1)]
    docs = prepare(spark).createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [0, 9]


def test_odd_rows_and_an_empty_table(spark, odd, empty, folder):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder[0])
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns[0] == "doc_id"
    kept = corpus_pipeline.language_id(spark, odd, folder[0]).collect()
    assert {r.doc_id for r in kept} <= {r[0] for r in ROWS} - {1, 2, 3, 9}
    assert {r.lang_pred for r in kept} <= {"own lang_pred"} and {r.row for r in kept} <= {"own row"}
    cleaned = corpus_pipeline.line_dedup(spark, odd, folder[0]).collect()
    assert sum(len(re.findall(SAME, r.text or "")) for r in cleaned) == 1
