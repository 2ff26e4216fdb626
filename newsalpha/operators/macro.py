"""Macro series in long form (series_id, date, value) and monthly market measures."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.constants import (
    AGGREGATE_LIMIT_STEPS,
    COUNTERPARTY_LIMIT_STEPS,
    FORWARD_FILLED_SERIES,
    MILLIONS_SERIES,
)
from newsalpha.functions.dates import month_start
from newsalpha.functions.numbers import log_price_ratio, log_return


def unit_scale(macro: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Millions to billions for the series quoted in millions."""
    scaled = F.col("series_id").isin(MILLIONS_SERIES if series is None else series)
    return macro.withColumn("value", F.when(scaled, F.col("value") / 1000).otherwise(F.col("value")))


def forward_fill(macro: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Carry the last value forward for the named series; a series has one row per day."""
    filled = F.last("value", ignorenulls=True).over(
        Window.partitionBy("series_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    )
    named = F.col("series_id").isin(FORWARD_FILLED_SERIES if series is None else series)
    return macro.withColumn("value", F.when(named, filled).otherwise(F.col("value")))


def step_value(day: Column, steps: list[tuple[str, float]]) -> Column:
    """Value of the last step on or before a day; null before the first."""
    value = F.lit(None).cast("double")
    for start, level in sorted(steps):
        value = F.when(day >= F.lit(start).cast("date"), F.lit(level)).otherwise(value)
    return value


def step_series(days: DataFrame, steps: dict[str, list[tuple[str, float]]] | None = None) -> DataFrame:
    """Dated steps as columns next to each day. The few steps fold into one expression, no join."""
    steps = steps or {
        "counterparty_limit": COUNTERPARTY_LIMIT_STEPS,
        "aggregate_limit": AGGREGATE_LIMIT_STEPS,
    }
    return days.withColumns({name: step_value(F.col("date"), points) for name, points in steps.items()})


def widen(macro: DataFrame, series: list[str]) -> DataFrame:
    """One column per series."""
    return macro.groupBy("date").pivot("series_id", series).agg(F.max("value"))


def coalesce_rates(wide: DataFrame) -> DataFrame:
    """Interest on reserves, from the older rate where the newer is missing."""
    return wide.withColumn("gen_iorb", F.coalesce("IORB", "IOER"))


def monthly(daily_logs: DataFrame, keys: list[str]) -> DataFrame:
    """Sum and sample deviation of log returns per month, in percent; null where all are missing."""
    return (
        daily_logs.groupBy(*keys, month_start(F.col("date")).alias("month"))
        .agg((F.sum("log_ret") * 100).alias("market_return"), (F.stddev_samp("log_ret") * 100).alias("market_volatility"))
        .withColumnRenamed("month", "date")
    )


def monthly_market(index: DataFrame, column: str = "vwretd") -> DataFrame:
    return monthly(index.select("date", log_return(F.col(column)).alias("log_ret")), [])


def monthly_market_from_price(prices: DataFrame, key: str = "ticker", column: str = "adj_close") -> DataFrame:
    """The same from closing prices; a price series has one row per day."""
    previous = F.lag(column).over(Window.partitionBy(key).orderBy("date"))
    logs = prices.select(key, "date", log_price_ratio(F.col(column), previous).alias("log_ret"))
    return monthly(logs.where(F.col("log_ret").isNotNull()), [key])
