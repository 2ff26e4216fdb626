"""From raw news to labelled, sector-tagged headlines as one lazy plan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.operators.filters import daily_market_cap, filter_common_stock
from newsalpha.operators.funnel import dedup_headlines, single_issuer_headlines
from newsalpha.operators.labels import assign_binary_label, return_window
from newsalpha.operators.linking import attach_permno, security_interval_join, single_firm_join
from newsalpha.operators.sectors import sector_name, sector_on_daily
from newsalpha.sources.readers import normalize_daily


def linked_news(news: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Company news of single-firm stories with the issuer attached."""
    dated = news.withColumn("feed_year", F.year("timestamp_utc"))
    return attach_permno(single_firm_join(dated, "feed_year").drop("feed_year"), crosswalk)


def daily_stock(raw: DataFrame, history: DataFrame) -> DataFrame:
    """Common-stock daily rows in one layout with market value."""
    stocks = filter_common_stock(security_interval_join(normalize_daily(raw), history))
    return daily_market_cap(stocks.select("permno", "date", "ret", "prc", "shrout"))


def labeled_with_sector(news: DataFrame, daily: DataFrame, calendar: DataFrame, spells: DataFrame, window: tuple[int, int] = (-1, 1), min_chars: int = 5) -> DataFrame:
    """Funnel, window return, label and sector.

    Return, window, market value and sector all belong to an issuer and a day. They are put
    on the daily table first, so that the news meets them in one join. Copies of a
    headline share issuer and date, so they can be removed after that join.
    """
    features = daily.select(
        "permno", "date", "ret", return_window("ret", window).alias("ret_window"), "market_cap"
    ).where(F.col("ret").isNotNull() & F.col("ret_window").isNotNull())
    features = sector_on_daily(features, spells).drop("ret").withColumnRenamed("date", "article_date")
    headlines = single_issuer_headlines(news, calendar, min_chars).select(
        "rp_story_id", "permno", "article_date", "headline", "timestamp_utc"
    )
    labeled = dedup_headlines(headlines.join(features, ["permno", "article_date"])).drop("timestamp_utc")
    return assign_binary_label(labeled).withColumn("sector_name", sector_name(F.col("gsector")))


def sector_label_share(labeled: DataFrame) -> DataFrame:
    """Value-weighted share of positive labels per sector and day, before any model."""
    return (
        labeled.where(F.col("market_cap") > 0)
        .groupBy("gsector", F.col("article_date").alias("date"))
        .agg(
            F.try_divide(F.sum(F.col("label") * F.col("market_cap")), F.sum("market_cap")).alias("positive_share"),
            F.count("*").alias("n_headlines"),
        )
    )
