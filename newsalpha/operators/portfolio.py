"""Sector scores with lagged weights, and long-short portfolios."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.functions.numbers import ratio, weighted_mean
from newsalpha.operators.ranking import exact_ntile
from newsalpha.operators.sectors import sector_on_daily

TRADING_DAYS = 252


def lagged_caps(daily: DataFrame) -> DataFrame:
    """Market value of the issuer's previous row. An issuer has one row per trading day."""
    by_day = Window.partitionBy("permno").orderBy("date")
    return daily.select("permno", "date", F.lag("market_cap").over(by_day).alias("lagged_cap"))


def lag_weighted(scores: DataFrame, daily: DataFrame, spells: DataFrame, column: str, into: str) -> DataFrame:
    """Mean of a column per sector and day, weighted by the previous day's market value."""
    caps = lagged_caps(daily).where(F.col("lagged_cap") > 0)
    weighted = scores.where(F.col(column).isNotNull()).join(caps, ["permno", "date"])
    return (
        sector_on_daily(weighted, spells)
        .groupBy("gsector", "date")
        .agg(weighted_mean(F.col(column), F.col("lagged_cap")).alias(into), F.count("*").alias("n_issuers"))
    )


def issuer_day_scores(predictions: DataFrame) -> DataFrame:
    """Mean probability per issuer and day, so that an issuer counts once."""
    return predictions.groupBy("permno", F.col("article_date").alias("date")).agg(F.avg("p_up").alias("p_up"))


def sector_score_lagged(predictions: DataFrame, daily: DataFrame, spells: DataFrame) -> DataFrame:
    """Sector score: probability of a rise, weighted by the previous day's market value."""
    return lag_weighted(issuer_day_scores(predictions), daily, spells, "p_up", "score")


def sector_predicted_return(forecasts: DataFrame, daily: DataFrame, spells: DataFrame) -> DataFrame:
    """Sector forecast from issuer forecasts with the same weights."""
    scores = forecasts.select("permno", "date", F.col("score").alias("predicted"))
    return lag_weighted(scores, daily, spells, "predicted", "predicted_return")


def quintile_portfolio(forecasts: DataFrame, groups: int = 5) -> DataFrame:
    """Per day the mean return of the top and bottom group by score, and their difference.

    Forecasts have one row per issuer and day.
    """
    complete = forecasts.select("permno", "date", "score", "ret").dropna(subset=["score", "ret"])
    ranked = exact_ntile(complete, "date", "score", "permno", groups, "bucket")
    legs = ranked.groupBy("date").agg(
        F.avg(F.when(F.col("bucket") == groups, F.col("ret"))).alias("long_ret"),
        F.avg(F.when(F.col("bucket") == 1, F.col("ret"))).alias("short_ret"),
        F.count("*").alias("n"),
    )
    return legs.withColumn("spread", F.col("long_ret") - F.col("short_ret"))


def sharpe_ratio(portfolio: DataFrame, column: str = "spread", periods: int = TRADING_DAYS) -> DataFrame:
    """Annualized mean over deviation of a daily return."""
    deviation = F.nullif(F.stddev_samp(column), F.lit(0.0))
    return portfolio.agg(
        F.count(column).alias("n_days"),
        F.avg(column).alias("mean_daily"),
        F.stddev_samp(column).alias("sd_daily"),
        (ratio(F.avg(column), deviation) * F.sqrt(F.lit(float(periods)))).alias("sharpe"),
    )


def score_sign_hit_rate(panel: DataFrame, *keys: str) -> DataFrame:
    """Share of sector-days on which score and fund return have the same sign."""
    same = (F.signum("sentiment") == F.signum("etf_ret")).cast("int")
    complete = panel.dropna(subset=["sentiment", "etf_ret"])
    return complete.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(same).alias("hit_rate"))


def score_bucket_returns(panel: DataFrame, groups: int = 5) -> DataFrame:
    """Mean fund return by score bucket, buckets within each sector's own history of days."""
    by_score = Window.partitionBy("gsector").orderBy("sentiment", "date")
    ranked = panel.dropna(subset=["sentiment", "etf_ret"]).withColumn("bucket", F.ntile(groups).over(by_score))
    return ranked.groupBy("bucket").agg(
        F.count("*").alias("n"), F.avg("etf_ret").alias("mean_etf_ret"), F.avg("sentiment").alias("mean_score")
    )
