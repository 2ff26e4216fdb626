"""Summary tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.constants import LENGTH_PERCENTILES
from newsalpha.functions.numbers import ratio
from newsalpha.functions.text import char_count, token_count, word_count
from newsalpha.operators.quantiles import exact_quantiles
from newsalpha.session import stage


def daily_coverage(clean: DataFrame) -> DataFrame:
    """Days, and the mean number of articles and issuers per day."""
    days = clean.groupBy("article_date").agg(
        F.count("*").alias("n_articles"), F.countDistinct("permno").alias("n_stocks")
    )
    return days.agg(
        F.count("*").alias("n_days"),
        F.avg("n_articles").alias("avg_articles"),
        F.avg("n_stocks").alias("avg_stocks"),
    )


def dataset_summary(clean: DataFrame) -> DataFrame:
    """(statistic, value) rows, values as text.

    The means per day are ratios of counts, so one pass over the rows gives everything.
    """
    days = F.countDistinct("article_date")
    summary = clean.agg(
        F.min("article_date").cast("string").alias("date_start"),
        F.max("article_date").cast("string").alias("date_end"),
        F.count("*").cast("string").alias("articles"),
        F.countDistinct("rp_story_id").cast("string").alias("stories"),
        F.countDistinct("permno").cast("string").alias("issuers"),
        days.cast("string").alias("days"),
        F.round(ratio(F.count("article_date"), days), 6).cast("string").alias("articles_per_day"),
        F.round(ratio(F.countDistinct("article_date", "permno"), days), 6).cast("string").alias("issuers_per_day"),
    )
    return summary.unpivot([], summary.columns, "statistic", "value")


def monthly_volume(clean: DataFrame) -> DataFrame:
    return clean.groupBy(F.trunc("article_date", "month").alias("month")).agg(F.count("*").alias("n"))


def label_share(labeled: DataFrame) -> DataFrame:
    return labeled.agg(
        F.count("*").alias("n"),
        F.avg("label").alias("share_positive"),
        F.min("article_date").alias("first_date"),
        F.max("article_date").alias("last_date"),
    )


def char_word_counts(texts: DataFrame, column: str) -> DataFrame:
    text = F.col(column)
    return texts.withColumns({"characters": char_count(text), "words": word_count(text)})


def text_length_stats(texts: DataFrame, column: str, percentiles: list[int] | None = None, measures: dict | None = None) -> DataFrame:
    """Percentiles and mean of characters, words and tokens per text, to one decimal.

    Lengths are first counted, so the percentile state holds distinct lengths and not rows.
    """
    percentiles = percentiles or LENGTH_PERCENTILES
    text = F.col(column)
    measures = measures or {"characters": char_count(text), "words": word_count(text), "tokens": token_count(text)}
    lengths = texts.where(text.isNotNull()).select(
        F.inline(F.array(*(
            F.struct(F.lit(name).alias("measure"), length.cast("bigint").alias("length"))
            for name, length in measures.items()
        )))
    )
    counted = lengths.groupBy("measure", "length").agg(F.count("*").alias("copies"))
    points = F.array(*(F.lit(p / 100) for p in percentiles))
    stats = counted.groupBy("measure").agg(
        F.percentile("length", points, F.col("copies")).alias("points"),
        ratio(F.sum(F.col("length") * F.col("copies")), F.sum("copies")).alias("mean"),
        F.sum("copies").alias("n"),
    )
    return stats.select(
        "measure",
        *(F.round(F.col("points")[i], 1).alias(f"p{p}") for i, p in enumerate(percentiles)),
        F.round("mean", 1).alias("mean"),
        "n",
    )


def rows_per_group(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def non_null_counts(df: DataFrame) -> DataFrame:
    """(series, non_null_count) for every column."""
    return df.agg(*(F.count(c).alias(c) for c in df.columns)).unpivot([], df.columns, "series", "non_null_count")


def profile_table(df: DataFrame, day: str, key: str) -> DataFrame:
    """Rows, columns, date range and distinct keys."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.countDistinct(key).alias("n_keys"),
    )


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, nulls, mean, deviation, minimum, quartiles and maximum per column."""
    spark = df.sparkSession
    quartiles = [(c, *points) for c, points in exact_quantiles(df, columns, [0.25, 0.5, 0.75]).items()]
    points = spark.createDataFrame(quartiles, "column_name string, q25 double, q50 double, q75 double")
    moments = df.agg(
        F.array(*(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.count_if(F.col(c).isNull()).alias("n_null"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("sd"),
                F.min(c).cast("double").alias("low"),
                F.max(c).cast("double").alias("high"),
            )
            for c in columns
        )).alias("columns")
    ).select(F.inline("columns"))
    return moments.join(F.broadcast(points), "column_name")


def return_histogram(labeled: DataFrame, bins: int = 80) -> DataFrame:
    """Density of window returns per label between the 1 % and 99 % quantiles.

    Each label has its own equal bins from its smallest to its largest kept return. The two
    columns are staged, because bounds, ranges and counts each read them.
    """
    rows = stage(labeled.select("ret_window", "label").dropna(), "returns")
    low, high = exact_quantiles(rows, ["ret_window"], [0.01, 0.99])["ret_window"]
    kept = rows.where(F.col("ret_window").between(low, high))
    ranges = kept.groupBy("label").agg(
        F.min("ret_window").alias("start"), F.max("ret_window").alias("stop"), F.count("*").alias("label_rows")
    )
    width = (F.col("stop") - F.col("start")) / bins
    place = F.least(F.floor(F.try_divide(F.col("ret_window") - F.col("start"), width)), F.lit(bins - 1))
    return (
        kept.join(ranges, "label")
        .withColumns({"bin": F.coalesce(place, F.lit(0)).cast("int"), "width": width})
        .groupBy("label", "bin", "start", "width", "label_rows")
        .agg(F.count("*").alias("n"))
        .select(
            "label", "bin",
            (F.col("start") + F.col("bin") * F.col("width")).alias("bin_start"),
            "n",
            ratio(F.col("n"), F.col("label_rows") * F.col("width")).alias("density"),
        )
    )
