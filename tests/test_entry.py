"""The entry points work without the corpus operators, and hide no other failure."""

import sys

import pytest

import __spark_entry__ as entry
from newsalpha.catalog import ORACLES, QUERIES


def test_without_the_corpus_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)


def test_a_broken_import_is_not_hidden(monkeypatch):
    class Broken:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline":
                raise ModuleNotFoundError("no such library", name="some_library")

    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Broken(), *sys.meta_path])
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
