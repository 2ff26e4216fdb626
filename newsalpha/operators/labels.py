"""Return windows and labels.

The daily table has one row per issuer and trading day, so an issuer's group in the
windows below is no longer than the trading calendar.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def return_window(ret: str, window: tuple[int, int]):
    """Compound return over the rows ``lo … hi`` around the current row, null unless all are there.

    Offsets count rows, not calendar days.
    """
    lo, hi = window
    frame = Window.partitionBy("permno").orderBy("date").rowsBetween(lo, hi)
    complete = F.count(ret).over(frame) == hi - lo + 1
    return F.when(complete, F.product(1 + F.col(ret)).over(frame) - 1)


def compute_return_window(daily: DataFrame, window: tuple[int, int] = (-1, 1)) -> DataFrame:
    """(permno, date, ret_window); incomplete windows are dropped."""
    return (
        daily.select("permno", "date", return_window("ret", window).alias("ret_window"))
        .where(F.col("ret_window").isNotNull())
    )


def forward_returns(daily: DataFrame, horizons: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Compound returns over the next k rows, one column per horizon, from one sort."""
    return daily.select(
        "permno", "date", *(return_window("ret", (1, k)).alias(f"fwd_{k}") for k in horizons)
    )


def assign_binary_label(df: DataFrame) -> DataFrame:
    """1 for a positive window return, 0 for zero or negative, null for null."""
    return df.withColumn("label", (F.col("ret_window") > 0).cast("tinyint"))


def universe_semi(daily: DataFrame, news: DataFrame) -> DataFrame:
    """Daily rows of issuers that occur in the news.

    The return windows that follow need the daily rows by issuer anyway, so a shuffled join
    costs nothing extra and the news is not read twice to learn the number of issuers.
    """
    issuers = news.select("permno").where(F.col("permno").isNotNull()).distinct()
    return daily.join(issuers, "permno", "left_semi")


def build_labeled_dataset(clean: DataFrame, daily: DataFrame, window: tuple[int, int] = (-1, 1)) -> DataFrame:
    """Headlines with window return, market value on the article date, and label.

    Window return and market value come from the same daily row, so one join brings both.
    """
    features = daily.select(
        "permno",
        F.col("date").alias("article_date"),
        return_window("ret", window).alias("ret_window"),
        "market_cap",
    ).where(F.col("ret_window").isNotNull())
    wanted = ["rp_story_id", "permno", "article_date", "headline"]
    headlines = clean.select(*(c for c in wanted if c in clean.columns))
    return assign_binary_label(headlines.join(features, ["permno", "article_date"]))
