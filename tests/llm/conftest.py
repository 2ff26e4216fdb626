import pytest

from newsalpha.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns with the names of columns that operators add or use.
CLASHES = (
    "shard", "slot", "size", "row", "doc", "version", "first", "line", "tokens", "kept", "component_id", "n_shingles", "signature",
    "node", "leaks", "found", "lang_pred", "score", "spans", "n_lines", "n_removed", "n_tokens", "ids", "edits", "path", "host",
)
SAME = "one text that stands here more than once in the table"
ROWS = [
    (None, "a text without an id, of some words", "en", "s", 1),
    (1, None, None, None, None),
    (2, "", "en", None, 0),
    (3, " \n\t\r\n ", None, "s", 6),
    (4, "word " * 40_000 + "end", "en", "s", 200_003),
    (5, "x" * 70_000, "de", "s", 70_000),
    (6, SAME, "en", "s", 53),
    (7, SAME, "en", "s", 53),
    (7, SAME, "en", "s", 53),
    (8, "ein Satz für alle\nein Satz für alle\n\n" + SAME, "de", "t", 10),
    (9, "12 + 34 = 46 !?", "fr", "t", 15),
    (10, "\x00 odd ﻿ signs   here 😀 שלום 你好", "es", "t", 5),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""
    from pyspark.sql import functions as F

    docs = prepare(spark).createDataFrame(ROWS, SCHEMA)
    return docs.withColumns({name: F.lit(f"own {name}") for name in CLASHES}).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return prepare(spark).createDataFrame([], SCHEMA)
