"""Queries over aggregates, windows, order and shape."""

from pyspark.sql import functions as F

from newsalpha.catalog.base import CLEAN, LABELED, PANEL, query, rounded
from newsalpha.catalog.joins import built_panel, clean, labeled
from newsalpha.constants import COUNTERPARTY_LIMIT_STEPS, SECTOR_FUNDS
from newsalpha.operators import macro, panel, reshape, sampling, statistics
from newsalpha.operators.evaluation import accuracy_by_year as yearly_accuracy
from newsalpha.operators.embedding import token_counts as count_tokens
from newsalpha.plans.text_report import headline_length_report

PER_DAY = """per_day AS (
  SELECT article_date, count(*) AS n_articles, count(DISTINCT permno) AS n_stocks FROM clean GROUP BY article_date)"""


@query(f"""WITH {CLEAN}, {PER_DAY}
SELECT count(*) AS n_days, round(avg(n_articles), 6) AS avg_articles, round(avg(n_stocks), 6) AS avg_stocks FROM per_day""")
def daily_coverage(t):
    return rounded(statistics.daily_coverage(clean(t)))


@query(f"""WITH {CLEAN}, {PER_DAY}
SELECT 'date_start' AS statistic, CAST(min(article_date) AS VARCHAR) AS value FROM clean
UNION ALL SELECT 'date_end', CAST(max(article_date) AS VARCHAR) FROM clean
UNION ALL SELECT 'articles', CAST(count(*) AS VARCHAR) FROM clean
UNION ALL SELECT 'stories', CAST(count(DISTINCT rp_story_id) AS VARCHAR) FROM clean
UNION ALL SELECT 'issuers', CAST(count(DISTINCT permno) AS VARCHAR) FROM clean
UNION ALL SELECT 'days', CAST(count(*) AS VARCHAR) FROM per_day
UNION ALL SELECT 'articles_per_day', CAST(round(avg(n_articles), 6) AS VARCHAR) FROM per_day
UNION ALL SELECT 'issuers_per_day', CAST(round(avg(n_stocks), 6) AS VARCHAR) FROM per_day""")
def dataset_summary(t):
    return statistics.dataset_summary(clean(t))


@query("""
SELECT CAST(date_trunc('month', article_date) AS DATE) AS month, count(*) AS n FROM fx_labeled GROUP BY 1""")
def monthly_volume(t):
    return statistics.monthly_volume(t("fx_labeled"))


@query("""
SELECT count(*) AS n, round(avg(label), 6) AS share_positive, min(article_date) AS first_date, max(article_date) AS last_date
FROM fx_labeled""")
def label_share(t):
    return rounded(statistics.label_share(t("fx_labeled")))


TOKENS = r"len(regexp_extract_all(text, '([\p{L}\p{N}]+|[^\p{L}\p{N}\s])'))"
WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))"
LENGTHS = f"""lengths AS (
  SELECT 'characters' AS measure, length(text) AS len FROM texts
  UNION ALL SELECT 'words', {WORDS} FROM texts
  UNION ALL SELECT 'tokens', {TOKENS} FROM texts)
SELECT measure, round(quantile_cont(len, 0.01), 1) AS p1, round(quantile_cont(len, 0.25), 1) AS p25,
  round(quantile_cont(len, 0.5), 1) AS p50, round(quantile_cont(len, 0.75), 1) AS p75, round(quantile_cont(len, 0.99), 1) AS p99,
  round(avg(len), 1) AS mean, count(*) AS n
FROM lengths GROUP BY measure"""


@query(f"WITH texts AS (SELECT text FROM {{documents}} WHERE text IS NOT NULL), {LENGTHS}")
def text_length_stats(t):
    return statistics.text_length_stats(t("documents"), "text")


@query(f"""WITH texts AS (
  SELECT text FROM {{documents}} WHERE text IS NOT NULL ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100000), {LENGTHS}""")
def text_stats_report(t):
    """The sampled report: 100,000 texts by seed 42, all of them where there are fewer."""
    return headline_length_report(t("documents"), ["doc_id"], "text")


@query(f"SELECT doc_id, CAST({TOKENS} AS INT) AS tokens FROM {{documents}}")
def token_counts(t):
    return count_tokens(t("documents"), "text").select("doc_id", "tokens")


@query("SELECT ticker, count(*) AS n FROM fx_etf GROUP BY ticker")
def rows_per_group(t):
    return statistics.rows_per_group(t("fx_etf"), "ticker")


@query("""
SELECT 'permno' AS series, count(permno) AS non_null_count FROM fx_headlines
UNION ALL SELECT 'headline', count(headline) FROM fx_headlines
UNION ALL SELECT 'relevance', count(relevance) FROM fx_headlines
UNION ALL SELECT 'rp_story_id', count(rp_story_id) FROM fx_headlines""")
def non_null_counts(t):
    return statistics.non_null_counts(t("fx_headlines").select("permno", "headline", "relevance", "rp_story_id"))


@query("""
SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns, min(date) AS first_date, max(date) AS last_date,
  count(DISTINCT permno) AS n_keys FROM fx_daily""")
def profile_table(t):
    return statistics.profile_table(t("fx_daily"), "date", "permno")


def described(column):
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, count(*) - count({column}) AS n_null,
  round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS sd, round(min({column}), 6) AS low, round(max({column}), 6) AS high,
  round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50, round(quantile_cont({column}, 0.75), 6) AS q75
FROM fx_daily"""


@query(" UNION ALL ".join(map(described, ["ret", "prc", "shrout"])))
def describe_numeric(t):
    return rounded(statistics.describe_numeric(t("fx_daily"), ["ret", "prc", "shrout"]))


@query(f"""WITH {LABELED},
bounds AS (SELECT quantile_cont(ret_window, 0.01) AS lo, quantile_cont(ret_window, 0.99) AS hi FROM labeled),
kept AS (SELECT label, ret_window FROM labeled, bounds WHERE ret_window BETWEEN lo AND hi),
ranges AS (SELECT label, min(ret_window) AS a, (max(ret_window) - min(ret_window)) / 80 AS w, count(*) AS m FROM kept GROUP BY label)
SELECT CAST(label AS INT) AS label, CAST(bin AS INT) AS bin, round(a + bin * w, 6) AS bin_start, n, round(n / (m * w), 6) AS density
FROM (SELECT k.label, a, w, m, least(floor((ret_window - a) / w), 79) AS bin, count(*) AS n
      FROM kept k JOIN ranges r ON r.label = k.label GROUP BY ALL) x""")
def return_histogram(t):
    return rounded(statistics.return_histogram(labeled(t))).withColumn("label", F.col("label").cast("int"))


@query("""
SELECT CAST(date_trunc('month', date) AS DATE) AS date, round(sum(ln(1 + vwretd)) * 100, 6) AS market_return,
  round(stddev_samp(ln(1 + vwretd)) * 100, 6) AS market_volatility FROM fx_index GROUP BY 1""")
def monthly_market(t):
    return rounded(macro.monthly_market(t("fx_index")))


@query("""
SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS date, round(sum(r) * 100, 6) AS market_return,
  round(stddev_samp(r) * 100, 6) AS market_volatility
FROM (SELECT ticker, date, ln(adj_close / lag(adj_close) OVER (PARTITION BY ticker ORDER BY date)) AS r FROM fx_etf) x
WHERE r IS NOT NULL GROUP BY 1, 2""")
def monthly_market_from_price(t):
    return rounded(macro.monthly_market_from_price(t("fx_etf")))


@query("""
SELECT series_id, date, CASE WHEN series_id IN ('OBFR', 'TREAST', 'WALCL')
  THEN last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date ROWS UNBOUNDED PRECEDING) ELSE value END AS value
FROM fx_macro""")
def forward_fill(t):
    return macro.forward_fill(t("fx_macro"))


STEPS = ", ".join(f"(DATE '{int(day[:4]) - 16}{day[4:]}', {value})" for day, value in COUNTERPARTY_LIMIT_STEPS)


@query(f"""WITH steps(day, value) AS (VALUES {STEPS})
SELECT i.date, (SELECT CAST(value AS DOUBLE) FROM steps s WHERE s.day <= i.date ORDER BY s.day DESC LIMIT 1) AS counterparty_limit
FROM fx_index i""")
def step_series(t):
    """The policy steps moved back 16 years, so that they fall into the dates at hand."""
    moved = [(f"{int(day[:4]) - 16}{day[4:]}", value) for day, value in COUNTERPARTY_LIMIT_STEPS]
    return macro.step_series(t("fx_index").select("date"), {"counterparty_limit": moved})


LAGGED = f"""{PANEL},
lagged AS (SELECT *, lag(sentiment) OVER (PARTITION BY gsector ORDER BY date) AS sentiment_lag FROM panel)"""


@query(f"WITH {LAGGED} SELECT gsector, date, round(sentiment, 6) AS sentiment, round(sentiment_lag, 6) AS sentiment_lag FROM lagged")
def lagged_sentiment(t):
    rows = panel.lagged_sentiment(built_panel(t))
    return rounded(rows.select("gsector", "date", "sentiment", "sentiment_lag"))


PAIRS = f"""{LAGGED},
pairs AS (
  SELECT gsector, sector_name, date, 'synthetic_ret' AS return_series, 'same-day' AS lag, sentiment AS score, synthetic_ret AS ret FROM lagged
  UNION ALL SELECT gsector, sector_name, date, 'synthetic_ret', '1d-lag', sentiment_lag, synthetic_ret FROM lagged
  UNION ALL SELECT gsector, sector_name, date, 'etf_ret', 'same-day', sentiment, etf_ret FROM lagged
  UNION ALL SELECT gsector, sector_name, date, 'etf_ret', '1d-lag', sentiment_lag, etf_ret FROM lagged),
complete AS (SELECT * FROM pairs WHERE score IS NOT NULL AND ret IS NOT NULL)"""


@query(f"""WITH {PAIRS}
SELECT gsector, sector_name, date, return_series, lag, round(score, 6) AS score, round(ret, 6) AS ret FROM pairs""")
def stack_return_pairs(t):
    return rounded(panel.stack_return_pairs(built_panel(t)))


@query("""
SELECT permno, date, ret, rank() OVER (PARTITION BY permno ORDER BY ret)
  + (count(*) OVER (PARTITION BY permno, ret) - 1) / 2.0::DOUBLE AS ret_rank
FROM fx_daily WHERE ret IS NOT NULL""")
def average_ranks(t):
    rows = t("fx_daily").where(F.col("ret").isNotNull()).select("permno", "date", "ret")
    return panel.average_ranks(rows, ["permno"], "ret", "ret_rank")


def correlations_sql(min_pairs):
    return f"""WITH {PAIRS},
ranked AS (
  SELECT *, rank() OVER (PARTITION BY gsector, return_series, lag ORDER BY score)
      + (count(*) OVER (PARTITION BY gsector, return_series, lag, score) - 1) / 2.0 AS score_rank,
    rank() OVER (PARTITION BY gsector, return_series, lag ORDER BY ret)
      + (count(*) OVER (PARTITION BY gsector, return_series, lag, ret) - 1) / 2.0 AS ret_rank
  FROM complete),
cells AS (SELECT DISTINCT gsector, sector_name, return_series, lag FROM pairs),
found AS (
  SELECT gsector, return_series, lag, count(*) AS n,
    CASE WHEN count(*) >= {min_pairs} THEN corr(score, ret) END AS pearson,
    CASE WHEN count(*) >= {min_pairs} THEN corr(score_rank, ret_rank) END AS spearman
  FROM ranked GROUP BY gsector, return_series, lag)
SELECT c.gsector, c.sector_name, c.return_series, c.lag, coalesce(f.n, 0) AS n,
  round(f.pearson, 6) AS pearson, round(f.spearman, 6) AS spearman
FROM cells c LEFT JOIN found f ON f.gsector = c.gsector AND f.return_series = c.return_series AND f.lag = c.lag"""


@query(correlations_sql(10))
def sector_correlations(t):
    """With 10 pairs as the minimum, because the month at hand has fewer than 30 days."""
    return rounded(panel.sector_correlations(built_panel(t), min_pairs=10))


@query(correlations_sql(30))
def sector_correlations_default(t):
    """With the usual minimum of 30 pairs: counts only for a single month."""
    return rounded(panel.sector_correlations(built_panel(t)))


@query(f"""WITH {PANEL}, z AS (
  SELECT gsector, date, sentiment, synthetic_ret, etf_ret,
    avg(sentiment) OVER w AS m1, stddev_samp(sentiment) OVER w AS s1, avg(synthetic_ret) OVER w AS m2, stddev_samp(synthetic_ret) OVER w AS s2,
    avg(etf_ret) OVER w AS m3, stddev_samp(etf_ret) OVER w AS s3
  FROM panel WINDOW w AS (PARTITION BY gsector))
SELECT gsector, date, round(coalesce((sentiment - m1) / nullif(s1, 0), sentiment * 0), 6) AS sentiment_z,
  round(coalesce((synthetic_ret - m2) / nullif(s2, 0), synthetic_ret * 0), 6) AS synthetic_ret_z,
  round(coalesce((etf_ret - m3) / nullif(s3, 0), etf_ret * 0), 6) AS etf_ret_z FROM z""")
def zscore_by_sector(t):
    scores = panel.zscore_by_sector(built_panel(t), ["sentiment", "synthetic_ret", "etf_ret"])
    return rounded(scores.select("gsector", "date", "sentiment_z", "synthetic_ret_z", "etf_ret_z"))


@query(f"""WITH {LABELED} SELECT article_date, permno, rp_story_id, headline FROM labeled ORDER BY article_date, permno, rp_story_id""")
def ordered_output(t):
    rows = labeled(t).select("article_date", "permno", "rp_story_id", "headline")
    return sampling.ordered_output(rows, "article_date", "permno", "rp_story_id")


@query("SELECT permno, date, ret FROM fx_daily ORDER BY date, permno LIMIT 5")
def head_rows(t):
    return sampling.head_rows(t("fx_daily").select("permno", "date", "ret"), ["date", "permno"], 5)


@query("""SELECT event_id, event_type, user_id FROM {events} ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id LIMIT 500""")
def sample_n(t):
    return sampling.sample_n(t("events"), 500, ["event_id"]).select("event_id", "event_type", "user_id")


@query("""
WITH splits AS (
  SELECT rp_story_id, article_date, CASE WHEN year(article_date) <= 1997 THEN 'train' WHEN year(article_date) = 1998 THEN 'val' ELSE 'test' END AS split
  FROM fx_labeled),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || CAST(rp_story_id AS VARCHAR)), rp_story_id) AS r FROM splits)
SELECT rp_story_id, article_date, split FROM drawn
WHERE split = 'test' OR (split = 'train' AND r <= 1000) OR (split = 'val' AND r <= 500)""")
def sample_per_split(t):
    year = F.year("article_date")
    split = F.when(year <= 1997, "train").when(year == 1998, "val").otherwise("test")
    rows = t("fx_labeled").select("rp_story_id", "article_date", split.alias("split"))
    return sampling.cap_splits(rows, {"train": 1000, "val": 500, "test": None}, ["rp_story_id"])


@query("""
SELECT user_id AS permno, CAST(ts AS DATE) AS day FROM {events} UNION ALL SELECT o_custkey, CAST(o_orderdate AS DATE) FROM {orders}""")
def union_parts(t):
    a = t("events").select(F.col("user_id").alias("permno"), F.to_date("ts").alias("day"))
    b = t("orders").select(F.col("o_custkey").alias("permno"), F.to_date("o_orderdate").alias("day"))
    return reshape.union_parts(a, b)


@query("SELECT DISTINCT permno, headline FROM fx_headlines")
def distinct_rows(t):
    return reshape.distinct_rows(t("fx_headlines"), "permno", "headline")


@query("SELECT rp_story_id FROM fx_headlines INTERSECT SELECT rp_story_id FROM fx_predictions")
def common_ids(t):
    return reshape.common_ids(t("fx_headlines"), t("fx_predictions"))


@query("""
WITH a AS (SELECT vec_id AS id, embedding AS v FROM {embeddings} WHERE label >= 3),
b AS (SELECT vec_id AS id, list_transform(embedding, lambda x: -x) AS v FROM {embeddings} WHERE label <= 6),
shared AS (SELECT id FROM a INTERSECT SELECT id FROM b),
named AS (
  SELECT 'ONE_' || CAST(id AS VARCHAR) AS rp_story_id, v FROM a WHERE id IN (SELECT id FROM shared)
  UNION ALL SELECT 'TWO_' || CAST(id AS VARCHAR), v FROM b WHERE id IN (SELECT id FROM shared))
SELECT rp_story_id, CAST(generate_subscripts(v, 1) - 1 AS INT) AS pos, round(unnest(v)::DOUBLE, 6) AS value FROM named""")
def compare_models_for_story(t):
    """Every story that both models have, all entries of the vectors."""
    rows = reshape.compare_models(two_models(t))
    return rows.select("rp_story_id", F.posexplode("embedding").alias("pos", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 6)
    )


def two_models(t):
    vectors = t("embeddings").withColumnRenamed("vec_id", "rp_story_id")
    return {
        "one": vectors.where(F.col("label") >= 3).select("rp_story_id", "embedding"),
        "two": vectors.where(F.col("label") <= 6).select("rp_story_id", F.transform("embedding", lambda x: -x).alias("embedding")),
    }


@query("""
WITH shared AS (SELECT min(vec_id) AS id FROM {embeddings} WHERE label BETWEEN 3 AND 6),
vectors AS (SELECT vec_id, embedding AS v FROM {embeddings} WHERE vec_id = (SELECT id FROM shared)),
named AS (
  SELECT 'ONE_' || CAST(vec_id AS VARCHAR) AS rp_story_id, v FROM vectors
  UNION ALL SELECT 'TWO_' || CAST(vec_id AS VARCHAR), list_transform(v, lambda x: -x) FROM vectors)
SELECT rp_story_id, CAST(generate_subscripts(v, 1) - 1 AS INT) AS pos, round(unnest(v)::DOUBLE, 6) AS value FROM named""")
def compare_one_story(t):
    """The first story that both models have."""
    story = t("embeddings").where(F.col("label").between(3, 6)).agg(F.min("vec_id")).first()[0]
    rows = reshape.compare_models_for_story(two_models(t), story)
    return rows.select("rp_story_id", F.posexplode("embedding").alias("pos", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 6)
    )


@query("SELECT ticker, date, adj_close FROM fx_etf")
def wide_to_long_prices(t):
    tickers = list(SECTOR_FUNDS.values())
    wide = reshape.long_to_wide_prices(t("fx_etf"), tickers)
    return reshape.wide_to_long_prices(wide, tickers)


PREDICTED = """predicted AS (
  SELECT m.model, CAST(year(l.article_date) AS INT) AS oos_year, l.label,
    ((l.rp_story_id * m.k) % 101) / CAST(100 AS DOUBLE) AS p_up
  FROM fx_labeled l JOIN (VALUES ('one', 37), ('two', 53)) m(model, k) ON TRUE)"""


def predicted(t):
    """Two scores derived from the story id, next to the given labels."""
    story = F.col("rp_story_id")
    models = F.array(
        F.struct(F.lit("one").alias("model"), (((story * 37) % 101) / 100.0).alias("p_up")),
        F.struct(F.lit("two").alias("model"), (((story * 53) % 101) / 100.0).alias("p_up")),
    )
    return t("fx_labeled").select(F.year("article_date").alias("oos_year"), "label", F.inline(models))


@query(f"""WITH {PREDICTED}
SELECT model, oos_year, round(avg(CASE WHEN (p_up >= 0.5) = (label = 1) THEN 1 ELSE 0 END), 6) AS accuracy FROM predicted GROUP BY 1, 2""")
def accuracy_by_year(t):
    return rounded(yearly_accuracy(predicted(t)))


@query(f"""WITH {PREDICTED},
yearly AS (SELECT model, oos_year, avg(CASE WHEN (p_up >= 0.5) = (label = 1) THEN 1 ELSE 0 END) * 100 AS acc FROM predicted GROUP BY 1, 2)
SELECT CAST(oos_year AS VARCHAR) AS year, round(max(CASE WHEN model = 'one' THEN acc END), 6) AS one,
  round(max(CASE WHEN model = 'two' THEN acc END), 6) AS two FROM yearly GROUP BY 1
UNION ALL
SELECT 'Average', round(avg(CASE WHEN model = 'one' THEN acc END), 6), round(avg(CASE WHEN model = 'two' THEN acc END), 6) FROM yearly""")
def accuracy_pivot(t):
    return rounded(reshape.accuracy_pivot(yearly_accuracy(predicted(t)), ["one", "two"]))


@query(f"""WITH {PANEL}
SELECT gsector, sector_name, count(*) AS n, min(date) AS first_date, max(date) AS last_date, round(avg(sentiment), 6) AS mean_sentiment
FROM panel GROUP BY gsector, sector_name""")
def partition_by_sector(t):
    return rounded(reshape.partition_by_sector(built_panel(t)))
