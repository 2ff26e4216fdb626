"""Row filters, derived columns and projections."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsalpha.constants import SCRAPED_COLUMNS
from newsalpha.functions.numbers import ratio
from newsalpha.functions.text import strip_spaces


def company_news(min_relevance: int = 90) -> Column:
    """US company news of high relevance."""
    return (
        (F.col("entity_type") == "COMP")
        & (F.col("country_code") == "US")
        & (F.col("relevance") >= min_relevance)
    )


def filter_us_company_relevant(df: DataFrame, start: str, end: str, min_relevance: int = 90) -> DataFrame:
    """Company news between two timestamps, both included."""
    bounds = F.col("timestamp_utc").between(
        F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    )
    return df.where(company_news(min_relevance) & bounds)


def filter_scraped(df: DataFrame, start: str, end: str, min_relevance: int = 90) -> DataFrame:
    """The same for the scraped feed, whose headline may be missing and whose clock may carry a zone."""
    df = df.withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp_ntz"))
    return filter_us_company_relevant(df.where(F.col("headline").isNotNull()), start, end, min_relevance)


def long_enough(headline: Column, min_chars: int = 5) -> Column:
    return F.coalesce(F.length(strip_spaces(headline)) >= min_chars, F.lit(False))


def filter_headline_length(df: DataFrame, min_chars: int = 5) -> DataFrame:
    return df.where(long_enough(F.col("headline"), min_chars))


def date_split(df: DataFrame, start: str, end: str, column: str = "article_date") -> DataFrame:
    return df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filter_equity(df: DataFrame) -> DataFrame:
    """Equity of any kind, the broad filter of the monthly file."""
    return df.where(F.col("securitytype") == "EQTY")


def filter_common_stock(df: DataFrame) -> DataFrame:
    """Ordinary common shares, by security type or, in the old layout, by share code."""
    if "shrcd" in df.columns:
        return df.where(F.col("shrcd").isin(10, 11))
    return df.where(
        (F.col("securitytype") == "EQTY")
        & (F.col("securitysubtype") == "COM")
        & (F.col("sharetype") == "NS")
        & (F.col("usincflg") == "Y")
    )


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def daily_market_cap(df: DataFrame) -> DataFrame:
    """Shares from thousands to units; a negative price marks a quote midpoint."""
    shares = F.col("shrout") * 1000
    return df.withColumns({"shrout": shares, "market_cap": F.abs("prc") * shares})


def monthly_adjusted_cap(df: DataFrame) -> DataFrame:
    """Monthly file: common names, split-adjusted price, shares and market value."""
    # Names of the monthly file and what they are called here.
    df = df.withColumnsRenamed(
        {
            "mthcaldt": "date",
            "mthret": "ret",
            "mthretx": "retx",
            "mthprc": "prc",
            "mthvol": "vol",
            "mthcumfacshr": "cfacshr",
            "mthcumfacpr": "cfacpr",
        }
    )
    shares = F.col("shrout") * 1000
    adjusted_shares = shares * F.col("cfacshr")
    adjusted_price = ratio(F.abs("prc"), F.col("cfacpr"))
    return df.withColumns(
        {
            "shrout": shares,
            "altprc": F.abs("prc"),
            "adj_shrout": adjusted_shares,
            "adj_prc": adjusted_price,
            "market_cap": adjusted_price * adjusted_shares,
        }
    )


def project_available(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Those of the listed columns that exist, in the listed order."""
    wanted = SCRAPED_COLUMNS if columns is None else columns
    return df.select(*(c for c in wanted if c in df.columns))


def slice_months(df: DataFrame, first: str = "1984-01", last: str = "2017-06", column: str = "date") -> DataFrame:
    """Months ``first`` to ``last``, both included, on a month-start date."""
    return date_split(df, f"{first}-01", f"{last}-01", column)
