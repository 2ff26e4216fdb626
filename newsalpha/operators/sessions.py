"""Trading sessions: local dates and the shift of pre-open news."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.functions.dates import in_opening_window, utc_to_eastern


def next_session_map(calendar: DataFrame, column: str = "trading_date") -> DataFrame:
    """(day, next_session) for every day from the first session up to the last.

    Built from the calendar alone, so the lookup is an equality join whatever the news.
    The calendar has one row per trading day; its ordering window stays that small.
    """
    days = calendar.select(F.col(column).alias("session")).distinct()
    following = F.lead("session").over(Window.orderBy("session"))
    return (
        days.withColumn("next_session", following)
        .where(F.col("next_session").isNotNull())
        .select(
            F.explode(F.sequence("session", F.date_sub("next_session", 1))).alias("day"),
            "next_session",
        )
    )


def next_trading_day(df: DataFrame, calendar: DataFrame, day: str, into: str, column: str = "trading_date") -> DataFrame:
    """First session strictly after ``day``; a day with none keeps itself."""
    sessions = next_session_map(calendar, column)
    first = calendar.select(F.min(column)).scalar()
    joined = df.join(sessions, F.col(day) == F.col("day"), "left")
    # A day before the calendar is not in the map either; its next session is the first one.
    following = F.greatest(F.coalesce("next_session", day), first)
    return joined.withColumn(into, F.when(F.col(day).isNotNull(), following)).drop("day", "next_session")


def shift_opening_window(df: DataFrame, calendar: DataFrame, column: str = "trading_date") -> DataFrame:
    """Add ``article_date``: the local date, moved to the next session for news of 09:00–09:29."""
    local = utc_to_eastern(F.col("timestamp_utc"))
    df = df.withColumns({"local_date": F.to_date(local), "in_window": in_opening_window(local)})
    df = next_trading_day(df, calendar, "local_date", "moved_date", column)
    moved: Column = F.when(F.col("in_window"), F.col("moved_date")).otherwise(F.col("local_date"))
    return df.withColumn("article_date", moved).drop("local_date", "in_window", "moved_date")
