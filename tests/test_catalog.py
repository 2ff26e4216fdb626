"""Every registered query against its check SQL, on the smallest tables."""

import datetime
import math
from pathlib import Path

import pytest

from newsalpha.catalog import ORACLES, QUERIES
from newsalpha.fixtures import BASE_TABLES

duckdb = pytest.importorskip("duckdb")
FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")

@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def in_order(columns, rows):
    by_name = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(row[i]) for i in by_name] for row in rows), key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_check(spark, engine, name):
    found = QUERIES[name](spark, str(FOLDER))
    expected = engine.sql(ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert in_order(found.columns, found.collect()) == in_order(expected.columns, expected.fetchall())


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # These have no exact SQL answer at full width; each has an entry of one feature, or of its weights, that has.
    assert set(QUERIES) - set(ORACLES) == {"train_logistic", "predict_proba", "train_ridge", "rolling_oos"}
    assert {"tfidf_weights", "tfidf_svd_directions", *(f"{q}_one_feature" for q in ("train_logistic", "predict_proba", "train_ridge", "rolling_oos"))} <= set(ORACLES)


def test_flagship_query(spark):
    from __spark_entry__ import entry

    assert entry(spark).columns == ["gsector", "sector_name", "date", "n_headlines", "sentiment", "synthetic_ret", "etf_ret"]
