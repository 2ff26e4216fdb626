"""The counted filtering funnel."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.constants import FUNNEL_LABELS, FUNNEL_STAGES
from newsalpha.functions.numbers import percent
from newsalpha.operators.filters import filter_headline_length, long_enough
from newsalpha.operators.sessions import shift_opening_window
from newsalpha.session import stage


def single_issuer_story_ids(news: DataFrame) -> DataFrame:
    """Stories with exactly one distinct known issuer."""
    return (
        news.where(F.col("permno").isNotNull())
        .groupBy("rp_story_id")
        .agg(F.min("permno").alias("low"), F.max("permno").alias("high"))
        .where(F.col("low") == F.col("high"))
        .select("rp_story_id")
    )


def single_entity_stories(news: DataFrame) -> DataFrame:
    """Rows with an issuer whose story has no other issuer."""
    return news.where(F.col("permno").isNotNull()).join(single_issuer_story_ids(news), "rp_story_id", "left_semi")


def return_keys(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("ret").isNotNull()).select("permno", F.col("date").alias("article_date"))


def has_return_semi(news: DataFrame, daily: DataFrame) -> DataFrame:
    """Rows whose issuer has a return on the article date."""
    return news.join(return_keys(daily), ["permno", "article_date"], "left_semi")


def dedup_headlines(news: DataFrame) -> DataFrame:
    """Per issuer, date and exact headline the earliest row.

    The rank limit runs before the shuffle too, so however many copies a headline has,
    each task sends on one of them.
    """
    copies = Window.partitionBy("permno", "article_date", "headline").orderBy("timestamp_utc", "rp_story_id")
    return news.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") == 1).drop("copy")


def clean_headlines(news: DataFrame, daily: DataFrame, calendar: DataFrame, min_chars: int = 5) -> DataFrame:
    """All stages of the funnel.

    The return test and the removal of copies use the same (issuer, date) partitioning.
    """
    return dedup_headlines(has_return_semi(single_issuer_headlines(news, calendar, min_chars), daily))


def single_issuer_headlines(news: DataFrame, calendar: DataFrame, min_chars: int = 5) -> DataFrame:
    """Long enough headlines of single-issuer stories, with their article date.

    The length test depends on the row alone, so it runs first and narrows what the
    shuffle carries; the story test still looks at every raw row.
    """
    long = filter_headline_length(news.where(F.col("permno").isNotNull()), min_chars)
    single = long.join(single_issuer_story_ids(news), "rp_story_id", "left_semi")
    return shift_opening_window(single, calendar)


def flagged_stages(news: DataFrame, daily: DataFrame, calendar: DataFrame, min_chars: int = 5) -> DataFrame:
    """All news rows with their article date and ``reached``, the last stage they pass before copies are removed.

    Each test becomes a flag. Short headlines are null: no later stage reads them.
    """
    stories = single_issuer_story_ids(news).withColumn("is_single", F.lit(True))
    returns = return_keys(daily).distinct().withColumn("has_return", F.lit(True))
    long = F.col("permno").isNotNull() & long_enough(F.col("headline"), min_chars)
    narrow = news.withColumn("headline", F.when(long, F.col("headline")))
    flagged = (
        shift_opening_window(narrow, calendar)
        .join(stories, "rp_story_id", "left")
        .join(returns, ["permno", "article_date"], "left")
    )
    single = F.col("permno").isNotNull() & F.col("is_single").isNotNull()
    priced = single & F.col("has_return").isNotNull()
    reached = F.when(priced & F.col("headline").isNotNull(), 3).when(priced, 2).when(single, 1).otherwise(0)
    return flagged.withColumn("reached", reached).drop("is_single", "has_return")


def stage_counts(flagged: DataFrame) -> DataFrame:
    """(stage, n): sums of flags; the last one counts distinct keys, which Spark pre-aggregates before it shuffles."""
    counts = flagged.agg(
        F.count("*").alias("0_raw"),
        *(F.count_if(F.col("reached") >= k).alias(FUNNEL_STAGES[k]) for k in (1, 2, 3)),
        F.countDistinct(F.when(F.col("reached") == 3, F.struct("permno", "article_date", "headline"))).alias("4_deduplicated"),
    )
    return counts.unpivot([], FUNNEL_STAGES, "stage", "n")


def funnel_stage_counts(news: DataFrame, daily: DataFrame, calendar: DataFrame, min_chars: int = 5) -> DataFrame:
    """(stage, n) for all five stages from one pass over the news."""
    return stage_counts(flagged_stages(news, daily, calendar, min_chars))


def filtering_funnel(news: DataFrame, daily: DataFrame, calendar: DataFrame, min_chars: int = 5) -> tuple[DataFrame, DataFrame]:
    """(clean rows, stage counts) from one run over the news.

    The flagged rows are written once, those that fail a test with nothing but the stage they reached; clean rows
    and counts are read from there. Counts are sums over written rows, so a task that runs twice counts once.
    """
    flagged = flagged_stages(news, daily, calendar, min_chars)
    passed = F.col("reached") == 3
    kept = flagged.select("reached", *(F.when(passed, F.col(c)).alias(c) for c in flagged.columns if c != "reached"))
    written = stage(kept, "funnel")
    return dedup_headlines(written.where(passed).drop("reached")), stage_counts(written)


def funnel_table(stage_counts: DataFrame) -> DataFrame:
    """Report of the five stages: share of raw and loss against the stage before."""
    ordered = Window.orderBy("stage")
    raw = F.first("n").over(ordered)
    prior = F.lag("n").over(ordered)
    labels = F.create_map(*(F.lit(text) for pair in FUNNEL_LABELS.items() for text in pair))
    return stage_counts.select(
        "stage",
        F.coalesce(F.element_at(labels, F.col("stage")), "stage").alias("label"),
        "n",
        percent(F.col("n"), raw).alias("pct_of_raw"),
        F.when(prior > 0, prior - F.col("n")).alias("dropped"),
        F.when(prior > 0, percent(prior - F.col("n"), prior)).alias("pct_dropped"),
    )
