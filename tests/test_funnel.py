from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsalpha.functions import dates
from newsalpha.operators import funnel, sessions

NEWS = "rp_story_id bigint, timestamp_utc timestamp_ntz, permno bigint, headline string"


def calendar(frame, *days):
    return frame([(date.fromisoformat(d),) for d in days], "trading_date date")


def test_eastern_time_follows_daylight_saving(frame):
    df = frame([(datetime(2023, 7, 3, 13, 15),), (datetime(2024, 1, 3, 13, 15),)], "ts timestamp_ntz")
    rows = df.select(dates.utc_to_eastern(F.col("ts")).alias("t"), dates.in_opening_window(dates.utc_to_eastern(F.col("ts"))).alias("w")).collect()
    assert [r.t for r in rows] == [datetime(2023, 7, 3, 9, 15), datetime(2024, 1, 3, 8, 15)]
    assert [r.w for r in rows] == [True, False]


@pytest.mark.parametrize("minute, moved", [(0, True), (29, True), (30, False)])
def test_opening_window_bounds(frame, minute, moved):
    news = frame([(1, datetime(2024, 1, 3, 14, minute, 59), 5, "x")], NEWS)
    shifted = sessions.shift_opening_window(news, calendar(frame, "2024-01-02", "2024-01-03", "2024-01-08"))
    assert shifted.first().article_date == (date(2024, 1, 8) if moved else date(2024, 1, 3))


def test_next_trading_day_edges(frame):
    days = frame([(date(2023, 12, 1),), (date(2024, 1, 2),), (date(2024, 1, 5),), (date(2024, 1, 8),), (date(2024, 2, 1),)], "d date")
    cal = calendar(frame, "2024-01-02", "2024-01-05", "2024-01-08")
    found = {r.d: r.n for r in sessions.next_trading_day(days, cal, "d", "n").collect()}
    assert found == {
        date(2023, 12, 1): date(2024, 1, 2),
        date(2024, 1, 2): date(2024, 1, 5),
        date(2024, 1, 5): date(2024, 1, 8),
        date(2024, 1, 8): date(2024, 1, 8),
        date(2024, 2, 1): date(2024, 2, 1),
    }


def small_news(frame):
    noon = lambda d, m=0: datetime(2024, 1, d, 17, m)
    return frame(
        [
            (1, noon(3), 10, "a headline"),
            (2, noon(3, 5), 10, "a headline"),  # later copy
            (3, noon(3), 10, "two firms"),
            (3, noon(3), 11, "two firms"),
            (4, noon(3), 12, "no return"),
            (5, noon(3), 10, "  abc  "),  # short once trimmed
            (6, noon(3), 10, None),
            (7, noon(3), 10, "known and unknown"),
            (7, noon(3), None, "known and unknown"),
        ],
        NEWS,
    )


def test_funnel_rows_and_counts_agree(frame):
    daily = frame([(10, date(2024, 1, 3), 0.1), (12, date(2024, 1, 3), None)], "permno bigint, date date, ret double")
    clean, counts = funnel.filtering_funnel(small_news(frame), daily, calendar(frame, "2024-01-03", "2024-01-04"))
    assert sorted(r.rp_story_id for r in clean.collect()) == [1, 7]
    assert [r.n for r in counts.orderBy("stage").collect()] == [9, 6, 5, 3, 2]


def test_funnel_with_one_hot_issuer_day_and_many_copies(spark, frame):
    """A third of all rows are copies of one headline; the result is that of brute force."""
    n = 3000
    rows = spark.range(n).select(
        F.col("id").alias("rp_story_id"),
        (F.lit("2024-01-03 17:00:00").cast("timestamp") + F.make_interval(secs=F.col("id") % 3600)).cast("timestamp_ntz").alias("timestamp_utc"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).cast("bigint").alias("permno"),
        F.when(F.col("id") % 3 == 0, "the same words").otherwise(F.concat(F.lit("headline "), F.col("id") % 100)).alias("headline"),
    )
    daily = spark.range(60).select(F.col("id").alias("permno"), F.lit(date(2024, 1, 3)).alias("date"), F.lit(0.1).alias("ret"))
    clean, counts = funnel.filtering_funnel(rows, daily, calendar(frame, "2024-01-03", "2024-01-04"))
    expected = {(1 if i % 3 == 0 else i % 50 + 2, "the same words" if i % 3 == 0 else f"headline {i % 100}") for i in range(n)}
    found = clean.collect()
    assert {(r.permno, r.headline) for r in found} == expected and len(found) == len(expected)
    assert [r.n for r in counts.orderBy("stage").collect()] == [n, n, n, n, len(expected)]
    copy = next(r for r in found if r.permno == 1)
    assert copy.rp_story_id == 0


def test_rows_and_counts_come_from_one_run(spark, frame, tmp_path):
    """Neither of the two plans reads the news, and rows that fail carry nothing."""
    small_news(frame).write.parquet(str(tmp_path / "news"))
    daily = frame([(10, date(2024, 1, 3), 0.1), (12, date(2024, 1, 3), None)], "permno bigint, date date, ret double")
    clean, counts = funnel.filtering_funnel(spark.read.parquet(str(tmp_path / "news")), daily, calendar(frame, "2024-01-03", "2024-01-04"))
    assert not any(str(tmp_path) in f for df in (clean, counts) for f in df.inputFiles())
    assert clean.columns == ["permno", "article_date", "rp_story_id", "timestamp_utc", "headline"]
    written = spark.read.parquet(*clean.inputFiles())
    assert sorted(r.headline for r in written.collect() if r.headline) == ["a headline", "a headline", "known and unknown"]
    assert [r.n for r in counts.orderBy("stage").collect()] == [9, 6, 5, 3, 2]


def test_copies_are_cut_before_the_shuffle(frame):
    news = small_news(frame).withColumn("article_date", F.to_date("timestamp_utc"))
    plan = funnel.dedup_headlines(news)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_funnel_table(frame):
    counts = frame([("0_raw", 200), ("1_single_entity", 100), ("2_has_return", 90)], "stage string, n bigint")
    rows = funnel.funnel_table(counts).orderBy("stage").collect()
    assert [(r.pct_of_raw, r.dropped, r.pct_dropped) for r in rows] == [(100.0, None, None), (50.0, 100, 50.0), (45.0, 10, 10.0)]
