from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from newsalpha.functions import dates, text
from newsalpha.operators import filters, linking, macro, quantiles, ranking, reshape, sampling, statistics
from newsalpha.plans.text_report import headline_length_report
from newsalpha.schemas import conform
from newsalpha.session import shared_folder, stage
from newsalpha.sources import readers, writers


def test_business_days_match_pandas(frame):
    start = date(2024, 2, 20)
    df = frame([(start + timedelta(i),) for i in range(30)], "d date")
    for n in (-10, -5, -1, 1, 4, 5, 6, 10):
        rows = df.select("d", dates.add_business_days(F.col("d"), n).alias("m")).collect()
        assert [r.m for r in rows] == [(pd.Timestamp(r.d) + pd.offsets.BDay(n)).date() for r in rows], n


def test_company_names(frame):
    names = ["Apple Inc.", "AT&T Corp", "The Gap, Inc.", "LIMITED INC", "Johnson & Johnson", "O'Reilly Holdings", "Incorporated Co"]
    df = frame([(i, n, "T") for i, n in enumerate(names)], "permno int, comnam string, ticker string")
    found = [r.n for r in df.select(text.normalize_company_name(F.col("comnam")).alias("n")).collect()]
    assert found == ["apple", "at t", "the gap", "", "johnson johnson", "o reilly", "incorporated"]
    assert sorted(r.comnam_norm for r in linking.names_lookup(df).collect()) == ["apple", "incorporated", "johnson johnson", "o reilly", "the gap"]


def test_trim_covers_all_white_space(frame):
    df = frame([(" \t abcd \n",), ("abcde",), (None,), ("  é　äöüß ",)], "headline string")
    assert [r.headline for r in filters.filter_headline_length(df).collect()] == ["abcde", "  é　äöüß "]


def test_words_and_characters(frame):
    df = frame([("",), ("  one\ttwo three ",), ("日本 語",)], "t string")
    rows = statistics.char_word_counts(df, "t").collect()
    assert [(r.characters, r.words) for r in rows] == [(0, 0), (16, 3), (4, 2)]


def test_scraped_filter_takes_zoned_clock_and_both_ends(spark, frame):
    rows = [(i, datetime(2024, 1, 1, h), "x", "US", "COMP", 90) for i, h in enumerate((0, 5, 10, 11))]
    df = frame(rows, "id int, timestamp_utc timestamp, headline string, country_code string, entity_type string, relevance int")
    kept = filters.filter_scraped(df, "2024-01-01 00:00:00", "2024-01-01 10:00:00")
    assert [r.id for r in kept.collect()] == [0, 1, 2]


def test_daily_layouts(frame):
    new = frame([(1, date(2020, 1, 2), 0.1, -5.0, 2.0, None)], "permno int, dlycaldt date, dlyret double, dlyprc double, dlyshrout double, ret double")
    assert readers.normalize_daily(new).columns == ["permno", "date", "ret", "prc", "shrout"]
    row = filters.daily_market_cap(readers.normalize_daily(new)).first()
    assert (row.shrout, row.market_cap, row.ret) == (2000.0, 10000.0, 0.1)


def test_single_firm_keeps_years_apart(frame):
    rows = [(y, 1, 1, e, "COMP", "US", 95) for y, e in ((2001, 10), (2002, 10), (2002, 11))]
    df = frame(rows, "year int, provider_id int, provider_story_id int, rp_entity_id int, entity_type string, country_code string, relevance int")
    assert [r.year for r in linking.single_firm_join(df, "year").collect()] == [2001]
    assert linking.single_firm_join(df).count() == 0


def test_crosswalk(frame):
    dse = frame([(1, "12345678"), (2, "12345678"), (3, None)], "permno bigint, ncusip string")
    names = frame([(7, "US12345678X"), (7, "US12345678Y"), (8, "US12345678"), (9, None)], "rp_entity_id bigint, isin string")
    pairs = linking.build_crosswalk(dse, names)
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 7), (2, 7)]
    news = frame([(7, "a"), (8, "b")], "rp_entity_id bigint, headline string")
    assert [(r.rp_entity_id, r.permno) for r in linking.attach_permno(news, pairs).collect()] == [(7, 1)]


def test_forward_fill_and_steps(frame):
    days = [date(2021, 3, 16) + timedelta(i) for i in range(3)]
    df = frame(
        [("OBFR", days[0], None), ("OBFR", days[1], 1.0), ("OBFR", days[2], None), ("GDP", days[0], 5.0), ("GDP", days[1], None), ("TREAST", days[0], 4000.0)],
        "series_id string, date date, value double",
    )
    filled = {(r.series_id, r.date): r.value for r in macro.forward_fill(macro.unit_scale(df)).collect()}
    assert [filled["OBFR", d] for d in days] == [None, 1.0, 1.0]
    assert filled["GDP", days[1]] is None and filled["TREAST", days[0]] == 4.0
    steps = macro.step_series(frame([(d,) for d in [date(2013, 9, 21), *days]], "date date")).orderBy("date").collect()
    assert [s.counterparty_limit for s in steps] == [None, 30.0, 80.0, 80.0]
    assert all(s.aggregate_limit is None for s in steps)


def test_monthly_market_of_missing_returns_is_null(frame):
    df = frame([(date(2020, 1, 1), None), (date(2020, 2, 3), 0.1), (date(2020, 2, 4), -0.1)], "date date, vwretd double")
    rows = macro.monthly_market(df).orderBy("date").collect()
    assert rows[0].market_return is None
    logs = np.log([1.1, 0.9])
    assert rows[1].market_return == pytest.approx(100 * logs.sum())
    assert rows[1].market_volatility == pytest.approx(100 * logs.std(ddof=1))


def test_quantiles_of_several_columns_are_exact(spark):
    values = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.rand(1)).alias("x"), F.when(F.col("id") < 7, F.col("id")).alias("few"),
        F.lit(None).cast("double").alias("none"),
    )
    values = stage(values, "values").repartition(6)
    x = np.array([r.x for r in values.collect()])
    points = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    found = quantiles.exact_quantiles(values, ["x", "few", "none"], points)
    assert np.allclose(found["x"], np.quantile(x, points), rtol=1e-12)
    assert np.allclose(found["few"], np.quantile(np.arange(7), points)) and found["none"] == [None] * len(points)


def test_quantiles_are_counted_cell_by_cell(spark):
    """With few cells and no value read early: equal values, all magnitudes, both signs, infinities and neighbours in one cell."""
    values = [0.0] * 200 + [float(i) for i in range(-50, 50)] + [7.0] * 20 + [1 + i * 2.0**-52 for i in range(40)]
    values += [s * 10.0**e for e in range(-320, 308, 13) for s in (1, -1)] + [1.7e308, -1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    points = [0.0, 0.01, 0.25, 0.5, 0.6, 0.75, 0.8, 0.99, 1.0]
    for cells, few in ((4, 0), (1024, 0), (1024, 10_000)):
        found = quantiles.exact_quantiles(df, ["x"], points, cells, few)["x"]
        assert np.allclose(found, np.quantile(values, points), rtol=1e-15, atol=0)
    odd = spark.createDataFrame([(v,) for v in [float("inf"), float("-inf"), float("nan"), 1.0, 2.0]], "x double")
    found = quantiles.exact_quantiles(odd, ["x"], [0.0, 0.25, 0.5, 0.75], few=0)["x"]
    assert found == [float("-inf"), 1.0, 2.0, float("inf")]


def test_nothing_is_sorted_or_dealt_out_by_range_for_quantiles(spark, monkeypatch):
    """A pass moves one row per cell and task."""
    moved, collect = [], type(spark.range(0)).collect

    def watched(df):
        moved.append((df._jdf.queryExecution().executedPlan().toString(), len(rows := collect(df))))
        return rows

    monkeypatch.setattr(type(spark.range(0)), "collect", watched)
    quantiles.exact_quantiles(spark.range(50_000).select((F.col("id") % 1000).cast("double").alias("x")), ["x"], [0.3, 0.9], few=100)
    assert len(moved) <= 3 and all("rangepartitioning" not in plan and n <= 2 * quantiles.CELLS for plan, n in moved)


def test_the_nth_draw_is_found_by_its_digits(spark):
    df = spark.range(5000).select(sampling.draw(["id"], 3).alias("draw"))
    every = sorted(r.draw for r in df.collect())
    for n in (1, 2, 777, 5000):
        for digits, few in ((1, 0), (3, 0), (3, 10_000)):
            assert sampling.nth_draw(df, n, digits, few) == (every[n - 1], n - 1, 1)
    assert sampling.nth_draw(df, 5001) is None and sampling.nth_draw(df.limit(0), 1) is None


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(20_000)
    one = {r.id for r in sampling.sample_n(df, 300, ["id"]).collect()}
    two = {r.id for r in sampling.sample_n(df.repartition(7), 300, ["id"]).collect()}
    assert len(one) == 300 and one == two
    assert {r.id for r in sampling.sample_n(df, 300, ["id"], seed=1).collect()} != one
    assert sampling.sample_n(df.limit(10), 300, ["id"]).count() == 10


def test_sample_with_a_hot_key_still_has_n_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    assert sampling.sample_n(df, 200, ["k", "id"]).count() == 200
    assert sampling.sample_n(df, 200, ["k"]).count() == 200


def test_length_report_uses_the_tokenizer(spark, frame):
    from newsalpha.operators.embedding import tokenizer_udf

    df = frame([(i, "a" * i) for i in range(1, 11)] + [(11, None)], "rp_story_id int, headline string")
    count = tokenizer_udf(lambda texts: [2 * len(t) for t in texts])
    rows = headline_length_report(df, ["rp_story_id"], measures={"double": count(F.col("headline")), "characters": F.length("headline")})
    found = {r.measure: r for r in rows.collect()}
    assert found["double"].p50 == 11.0 and found["characters"].p25 == pytest.approx(3.3) and found["double"].n == 10


def test_histogram_density_integrates_to_one(frame):
    rng = np.random.default_rng(0)
    rows = [(float(v), int(v > 0)) for v in rng.normal(size=2000)]
    bins = statistics.return_histogram(frame(rows, "ret_window double, label int")).toPandas()
    for _, part in bins.groupby("label"):
        width = part["bin_start"].diff().dropna().div(part["bin"].diff().dropna()).iloc[0]
        assert (part["density"] * width).sum() == pytest.approx(1.0)
    assert bins["bin"].max() == 79 and bins["n"].sum() == 1960


def test_staged_tables_have_few_files_and_go_with_the_session(spark):
    rows = stage(spark.range(1000).select("id", (F.col("id") % 4).alias("year")).repartition(16), "many", ("year",))
    assert len(rows.inputFiles()) <= 8
    path = spark._jvm.org.apache.hadoop.fs.Path(rows.inputFiles()[0]).getParent().getParent()
    assert path.getFileSystem(spark._jsc.hadoopConfiguration()).cancelDeleteOnExit(path)


def test_model_comparison_keeps_shared_stories(frame):
    a = frame([(1, [1.0]), (2, [2.0])], "rp_story_id int, embedding array<float>")
    b = frame([(2, [3.0]), (4, [4.0])], "rp_story_id int, embedding array<float>")
    rows = reshape.compare_models_for_story({"one": a, "two": b}, 2).collect()
    assert sorted((r.rp_story_id, r.embedding[0]) for r in rows) == [("ONE_2", 2.0), ("TWO_2", 3.0)]
    assert reshape.compare_models_for_story({"one": a, "two": b}, 1).count() == 0


def test_written_table_reads_back_with_pruned_years(spark, frame, tmp_path):
    df = frame([(i, 2000 + i % 3) for i in range(30)], "id int, year int")
    path = str(tmp_path / "t")
    writers.write_dataset(df, path, ("year",), ("id",))
    read = spark.read.parquet(path).where("year = 2001")
    assert read.count() == 10
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert writers.stored_or_none(spark, str(tmp_path / "missing")) is None


def test_report_and_csv_round_trip(spark, frame, tmp_path):
    df = frame([("0_raw", 5)], "stage string, n bigint")
    writers.write_report(df, str(tmp_path / "r"))
    assert [tuple(r) for r in writers.read_report(spark, str(tmp_path / "r"), "stage string, n bigint").collect()] == [("0_raw", 5)]
    writers.write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).first().n == "5"


def test_schema_check(frame):
    df = frame([("XLE", "2020-01-01", float("nan"))], "ticker string, date string, adj_close double")
    row = conform(df, "fund_prices").first()
    assert row.date == date(2020, 1, 1) and row.adj_close is None
    with pytest.raises(ValueError, match="adj_close"):
        conform(df.drop("adj_close"), "fund_prices")


class StubSession:
    """Just the settings of a session."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_exact_ntile_equals_the_window(spark):
    """Groups of odd sizes; in the largest a third of the rows have one score."""
    rows = stage(spark.range(4000).select(
        F.col("id").alias("permno"),
        F.when(F.col("id") < 3500, 1).when(F.col("id") < 3993, 2).otherwise(F.col("id") % 2 + 3).alias("date"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.round(F.rand(7), 3)).alias("score"),
    ), "scores").repartition(5)
    by_score = Window.partitionBy("date").orderBy("score", "permno")
    expected = {r.permno: r.b for r in rows.withColumn("b", F.ntile(5).over(by_score)).collect()}
    found = ranking.exact_ntile(rows, "date", "score", "permno", 5, "b")
    assert found.columns == ["permno", "date", "score", "b"] and found.count() == 4000
    assert {r.permno: r.b for r in found.collect()} == expected
    split = ranking.exact_ntile(rows, "date", "score", "permno", 5, "b", sorted_=400)
    assert split.count() == 4000 and {r.permno: r.b for r in split.collect()} == expected


def test_daily_rows_must_be_unique(frame, spark, tmp_path):
    rows = [(1, date(2020, 1, 2), 0.1), (1, date(2020, 1, 3), 0.1)]
    for name, extra in (("good", []), ("bad", rows[:1])):
        frame(rows + extra, "permno bigint, date date, ret double").write.parquet(str(tmp_path / name))
    assert readers.read_daily(spark, str(tmp_path / "good")).count() == 2
    with pytest.raises(ValueError, match="2 times"):
        readers.read_daily(spark, str(tmp_path / "bad"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(StubSession("s3a://shared/checkpoints", "yarn")) == "s3a://shared/checkpoints"
    assert shared_folder(StubSession(None, "local[4]"))
    with pytest.raises(ValueError):
        shared_folder(StubSession(None, "yarn"))
    staged = stage(spark.range(5), "ids")
    assert staged.count() == 5 and f"{shared_folder(spark)}/ids-" in staged.inputFiles()[0]


def test_describe_and_profile(frame):
    df = frame([(1.0, 1), (2.0, 1), (None, 2), (4.0, 3)], "x double, k int")
    row = statistics.describe_numeric(df, ["x"]).first()
    assert (row.n, row.n_null, row.q50, row.low, row.high) == (3, 1, 2.0, 1.0, 4.0)
    counts = {r.series: r.non_null_count for r in statistics.non_null_counts(df).collect()}
    assert counts == {"x": 3, "k": 4}
