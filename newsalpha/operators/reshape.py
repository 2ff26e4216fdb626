"""Set operations and changes of shape."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_parts(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct() if columns else df.distinct()


def common_ids(a: DataFrame, b: DataFrame, key: str = "rp_story_id") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def compare_models(tables: dict[str, DataFrame], key: str = "rp_story_id", vector: str = "embedding") -> DataFrame:
    """Vectors of several models under ids that start with the model's name, for the
    stories that all of them have."""
    shared = reduce(lambda a, b: a.intersect(b), (df.select(key) for df in tables.values()))
    return union_parts(*(
        df.join(shared, key, "left_semi").select(
            F.concat_ws("_", F.lit(model.upper()), F.col(key).cast("string")).alias(key), vector
        )
        for model, df in tables.items()
    ))


def compare_models_for_story(tables: dict[str, DataFrame], story, key: str = "rp_story_id", vector: str = "embedding") -> DataFrame:
    """The same for one story."""
    return compare_models({m: df.where(F.col(key) == story) for m, df in tables.items()}, key, vector)


def wide_to_long_prices(wide: DataFrame, tickers: list[str], day: str = "date") -> DataFrame:
    """One price column per ticker to (ticker, date, adj_close); missing closes go."""
    present = [t for t in tickers if t in wide.columns]
    return wide.unpivot([day], present, "ticker", "adj_close").dropna(subset=["adj_close"])


def long_to_wide_prices(prices: DataFrame, tickers: list[str], day: str = "date") -> DataFrame:
    return prices.groupBy(day).pivot("ticker", tickers).agg(F.max("adj_close"))


def accuracy_pivot(metrics: DataFrame, models: list[str]) -> DataFrame:
    """Accuracy in percent, years as rows and models as columns, plus an average row.

    The average is over years, not over headlines.
    """
    pct = F.avg(F.col("accuracy") * 100)
    years = metrics.groupBy(F.col("oos_year").cast("string").alias("year")).pivot("model", models).agg(pct)
    average = metrics.groupBy(F.lit("Average").alias("year")).pivot("model", models).agg(pct)
    return years.unionByName(average)


def partition_by_sector(panel: DataFrame) -> DataFrame:
    """Per sector what a split into one frame each would give: rows, dates, mean score."""
    return panel.groupBy("gsector", "sector_name").agg(
        F.count("*").alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg("sentiment").alias("mean_sentiment"),
    )
