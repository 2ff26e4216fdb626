from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from newsalpha.operators import labels

DAILY = "permno bigint, date date, ret double"


def days(issuer, returns):
    start = date(2020, 1, 1)
    return [(issuer, start + timedelta(days=i), r) for i, r in enumerate(returns)]


def test_window_of_two_issuers(frame):
    # The returns and windows of the method's own example.
    daily = frame(days(1, [0.01] * 5) + days(2, [0.02, -0.01, 0.03, 0.0, -0.02]), DAILY)
    found = {(r.permno, r.date.day): r.ret_window for r in labels.compute_return_window(daily).collect()}
    assert {k for k in found if k[0] == 1} == {(1, 2), (1, 3), (1, 4)}
    assert found[1, 3] == pytest.approx(1.01**3 - 1)
    assert found[2, 2] == pytest.approx(1.02 * 0.99 * 1.03 - 1)
    assert found[2, 3] == pytest.approx(0.99 * 1.03 * 1.0 - 1)
    assert found[2, 4] == pytest.approx(1.03 * 1.0 * 0.98 - 1)


def test_null_return_blocks_every_window_it_lies_in(frame):
    daily = frame(days(1, [0.01, 0.01, None, 0.01, 0.01, 0.01]), DAILY)
    assert [r.date.day for r in labels.compute_return_window(daily).collect()] == [5]


def test_window_counts_rows_not_calendar_days(frame):
    daily = frame([(1, date(2020, 1, 3), 0.1), (1, date(2020, 1, 6), 0.2), (1, date(2020, 3, 2), 0.3)], DAILY)
    row = labels.compute_return_window(daily).collect()[0]
    assert row.date == date(2020, 1, 6)
    assert row.ret_window == pytest.approx(1.1 * 1.2 * 1.3 - 1)


def test_forward_returns(frame):
    rows = labels.forward_returns(frame(days(1, [0.5, 0.1, 0.2, 0.3]), DAILY), (1, 3)).orderBy("date").collect()
    assert rows[0].fwd_1 == pytest.approx(0.1)
    assert rows[0].fwd_3 == pytest.approx(1.1 * 1.2 * 1.3 - 1)
    assert rows[1].fwd_3 is None and rows[3].fwd_1 is None


def test_label(frame):
    # The returns and labels of the method's own example.
    df = frame([(0.05,), (-0.03,), (0.0,), (0.001,), (-0.001,), (None,)], "ret_window double")
    assert [r.label for r in labels.assign_binary_label(df).collect()] == [1, 0, 0, 1, 0, None]


def test_labeled_dataset_keeps_headlines_with_a_window_only(frame):
    daily = frame(days(1, [0.01, -0.02, 0.03]), DAILY).withColumn("market_cap", F.lit(5.0))
    clean = frame(
        [(7, 1, date(2020, 1, 2), "a"), (8, 1, date(2020, 1, 1), "b"), (9, 2, date(2020, 1, 2), "c")],
        "rp_story_id bigint, permno bigint, article_date date, headline string",
    )
    rows = labels.build_labeled_dataset(clean, daily).collect()
    assert [(r.rp_story_id, r.market_cap, r.label) for r in rows] == [(7, 5.0, 1)]
    assert labels.universe_semi(daily, clean).count() == 3
