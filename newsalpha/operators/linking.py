"""News entity to issuer, and issuer histories."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.constants import LINK_RANKS, LINK_TYPES
from newsalpha.functions.text import isin_to_cusip, normalize_company_name
from newsalpha.operators.filters import company_news


def build_crosswalk(securities: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct (issuer, entity) pairs whose identifiers agree."""
    left = securities.where(F.col("ncusip").isNotNull()).select("permno", "ncusip").distinct()
    right = (
        names.where(F.length("isin") >= 11)
        .select("rp_entity_id", isin_to_cusip(F.col("isin")).alias("ncusip"))
        .distinct()
    )
    return left.join(right, "ncusip").select("permno", "rp_entity_id").distinct()


def one_issuer_per_entity(crosswalk: DataFrame) -> DataFrame:
    """The smallest issuer of each entity, so that the join cannot multiply news rows."""
    return crosswalk.where(F.col("permno").isNotNull()).groupBy("rp_entity_id").agg(F.min("permno").alias("permno"))


def attach_permno(news: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """News rows with a known issuer. An inner join equals left join and null drop."""
    lookup = one_issuer_per_entity(crosswalk).withColumn("permno", F.col("permno").cast("bigint"))
    return news.drop("permno").join(lookup, "rp_entity_id")


def single_firm_stories(news: DataFrame, *more_keys: str, min_relevance: int = 90) -> DataFrame:
    """Keys of provider stories about exactly one entity.

    Smallest equal to largest says the same as one distinct value, and needs only one
    partial aggregate. ``more_keys`` such as the year keep yearly tables apart.
    """
    keys = [*more_keys, "provider_id", "provider_story_id"]
    return (
        news.where(company_news(min_relevance))
        .groupBy(*keys)
        .agg(F.min("rp_entity_id").alias("first_entity"), F.max("rp_entity_id").alias("last_entity"))
        .where(F.col("first_entity") == F.col("last_entity"))
        .select(*keys)
    )


def single_firm_join(news: DataFrame, *more_keys: str, min_relevance: int = 90) -> DataFrame:
    """Company news that belongs to a single-firm provider story."""
    keys = [*more_keys, "provider_id", "provider_story_id"]
    stories = single_firm_stories(news, *more_keys, min_relevance=min_relevance)
    return news.where(company_news(min_relevance)).join(stories, keys, "left_semi")


def security_interval_join(daily: DataFrame, history: DataFrame, start: str = "secinfostartdt", end: str = "secinfoenddt") -> DataFrame:
    """Each daily row with the security description valid on that day."""
    history = history.alias("history")
    daily = daily.alias("daily")
    matched = daily.join(
        history,
        (F.col("daily.permno") == F.col("history.permno"))
        & F.col("daily.date").between(F.col(f"history.{start}"), F.col(f"history.{end}")),
    )
    return matched.drop(F.col("history.permno"))


def constituent_spells(members: DataFrame, names: DataFrame, links: DataFrame, sectors: DataFrame) -> DataFrame:
    """Index membership joined to names, company links and sectors whose intervals overlap it.

    The effective window is the part that membership and sector share; an open end
    runs to the end of the membership. The sector's own interval is ``gics_startdt, gics_enddt``.
    """
    end = F.col("mbrenddt")
    names = names.withColumnRenamed("permno", "name_permno")
    links = links.where(F.col("linktype").isin(LINK_TYPES) & F.col("linkprim").isin(LINK_RANKS)).select(
        "lpermno", "gvkey", "linkdt", "linkenddt"
    )
    sectors = sectors.withColumnsRenamed({"gvkey": "sector_gvkey", "indfrom": "gics_startdt", "indthru": "gics_enddt"})
    joined = (
        members.join(
            names,
            (F.col("permno") == F.col("name_permno"))
            & (F.col("mbrstartdt") <= F.col("nameenddt"))
            & (end >= F.col("namedt")),
            "left",
        )
        .join(
            links,
            (F.col("permno") == F.col("lpermno"))
            & (F.col("mbrstartdt") <= F.coalesce("linkenddt", end))
            & (end >= F.col("linkdt")),
            "left",
        )
        .join(
            sectors,
            (F.col("gvkey") == F.col("sector_gvkey"))
            & (F.col("mbrstartdt") <= F.coalesce("gics_enddt", end))
            & (end >= F.col("gics_startdt")),
            "left",
        )
    )
    return joined.drop("name_permno", "lpermno", "sector_gvkey").withColumns(
        effective_interval("mbrstartdt", "mbrenddt", "gics_startdt", "gics_enddt")
    )


def effective_interval(start: str, end: str, other_start: str, other_end: str) -> dict:
    """The overlap of an interval with another one whose end may be open."""
    return {
        "effstartdt": F.greatest(start, other_start),
        "effenddt": F.least(F.col(end), F.coalesce(other_end, end)),
    }


def names_lookup(names: DataFrame, min_chars: int = 5) -> DataFrame:
    """Distinct issuer names with their normalized form, short ones left out."""
    return (
        names.select("permno", "comnam", "ticker")
        .where(F.col("comnam").isNotNull())
        .distinct()
        .withColumn("comnam_norm", normalize_company_name(F.col("comnam")))
        .where(F.length("comnam_norm") >= min_chars)
    )


def link_coverage(news: DataFrame) -> DataFrame:
    """Rows, rows with an issuer, their share in percent, and distinct issuers."""
    return news.agg(
        F.count("*").alias("total"),
        F.count("permno").alias("matched"),
        F.countDistinct("permno").alias("issuers"),
    ).withColumn("matched_pct", F.try_divide(F.col("matched") * 100.0, F.col("total")))
