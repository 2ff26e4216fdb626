"""Sector-day sentiment and returns."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.functions.numbers import correlation, ratio, weighted_mean
from newsalpha.operators.sectors import sector_fund, sector_name, sector_on_daily

MIN_PAIRS = 30


def sentiment_score(df: DataFrame) -> DataFrame:
    return df.withColumn("sentiment_score", F.col("p_up") - 0.5)


def join_predictions(headlines: DataFrame, predictions: DataFrame) -> DataFrame:
    """Scored headlines; those without a prediction go."""
    scored = headlines.join(predictions.select("rp_story_id", "p_up"), "rp_story_id")
    return sentiment_score(scored).select(
        "rp_story_id", "permno", "article_date", "market_cap", "gsector", "sentiment_score"
    )


def weighted(df: DataFrame) -> DataFrame:
    """Rows with a positive market value."""
    return df.where(F.col("market_cap") > 0)


def aggregate_sentiment(scored: DataFrame) -> DataFrame:
    """Value-weighted score and headline count per sector and day."""
    return (
        weighted(scored)
        .groupBy("gsector", F.col("article_date").alias("date"))
        .agg(
            weighted_mean(F.col("sentiment_score"), F.col("market_cap")).alias("sentiment"),
            F.count("*").alias("n_headlines"),
        )
    )


def synthetic_sector_returns(daily: DataFrame, spells: DataFrame) -> DataFrame:
    """Value-weighted return per sector and day over the universe of that day."""
    priced = weighted(daily.where(F.col("ret").isNotNull())).select("permno", "date", "ret", "market_cap")
    return (
        sector_on_daily(priced, spells)
        .groupBy("gsector", "date")
        .agg(weighted_mean(F.col("ret"), F.col("market_cap")).alias("synthetic_ret"))
    )


def panel_join(sentiment: DataFrame, returns: DataFrame) -> DataFrame:
    return sentiment.join(returns, ["gsector", "date"])


def etf_returns(prices: DataFrame) -> DataFrame:
    """Simple daily return per fund; the first day has none."""
    previous = F.lag("adj_close").over(Window.partitionBy("ticker").orderBy("date"))
    return prices.select(
        "ticker", "date", "adj_close", (ratio(F.col("adj_close"), previous) - 1).alias("ret")
    )


def attach_etf_returns(panel: DataFrame, funds: DataFrame) -> DataFrame:
    """Add the return of the sector's fund; null where it has none that day."""
    funds = funds.select("ticker", "date", F.col("ret").alias("etf_ret"))
    return (
        panel.withColumn("ticker", sector_fund(F.col("gsector")))
        .join(funds, ["ticker", "date"], "left")
        .drop("ticker")
    )


def sector_panel(headlines: DataFrame, predictions: DataFrame, daily: DataFrame, spells: DataFrame, funds: DataFrame) -> DataFrame:
    """Sentiment, synthetic return and fund return per sector and day."""
    sentiment = aggregate_sentiment(join_predictions(headlines, predictions))
    panel = panel_join(sentiment, synthetic_sector_returns(daily, spells))
    return (
        attach_etf_returns(panel, funds)
        .withColumn("sector_name", sector_name(F.col("gsector")))
        .select("gsector", "sector_name", "date", "n_headlines", "sentiment", "synthetic_ret", "etf_ret")
    )


# The panel has one row per sector and day; the windows below stay that small.


def lagged_sentiment(panel: DataFrame) -> DataFrame:
    """The sentiment of the sector's previous row, which need not be the previous day."""
    by_day = Window.partitionBy("gsector").orderBy("date")
    return panel.withColumn("sentiment_lag", F.lag("sentiment").over(by_day))


def stack_return_pairs(panel: DataFrame) -> DataFrame:
    """Two return series by two lags as long rows, complete pairs or not."""
    pairs = [
        F.struct(
            F.lit(series).alias("return_series"),
            F.lit(lag).alias("lag"),
            F.col(score).alias("score"),
            F.col(series).alias("ret"),
        )
        for series in ("synthetic_ret", "etf_ret")
        for score, lag in (("sentiment", "same-day"), ("sentiment_lag", "1d-lag"))
    ]
    keys = ["gsector", "sector_name", "date"]
    return lagged_sentiment(panel).select(*keys, F.inline(F.array(*pairs)))


def average_ranks(df: DataFrame, keys: list[str], column: str, into: str) -> DataFrame:
    """Rank within the keys; equal values share the mean of their ranks."""
    ties = F.count("*").over(Window.partitionBy(*keys, column))
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(column))
    return df.withColumn(into, rank + (ties - 1) / 2)


def sector_correlations(panel: DataFrame, min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Pearson and Spearman correlation per sector, return series and lag.

    Ranks are taken among complete pairs. A cell without any is kept with n = 0.
    """
    keys = ["gsector", "return_series", "lag"]
    complete = F.col("score").isNotNull() & F.col("ret").isNotNull()
    pairs = stack_return_pairs(panel).withColumn("complete", complete)
    pairs = average_ranks(pairs, [*keys, "complete"], "score", "score_rank")
    pairs = average_ranks(pairs, [*keys, "complete"], "ret", "ret_rank")
    enough = F.count_if("complete") >= min_pairs

    def among_complete(x, y):
        return F.when(enough, correlation(F.when(F.col("complete"), F.col(x)), F.when(F.col("complete"), F.col(y))))

    return pairs.groupBy(*keys).agg(
        F.min("sector_name").alias("sector_name"),
        F.count_if("complete").alias("n"),
        among_complete("score", "ret").alias("pearson"),
        among_complete("score_rank", "ret_rank").alias("spearman"),
    )


def zscore_by_sector(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Standard scores per sector; zero where the sector has no spread, null stays null."""
    sector = Window.partitionBy("gsector")

    def score(column):
        spread = F.nullif(F.stddev_samp(column).over(sector), F.lit(0.0))
        return F.coalesce(ratio(F.col(column) - F.avg(column).over(sector), spread), F.col(column) * 0)

    return panel.withColumns({f"{c}_z": score(c) for c in columns})
