"""Point-in-time sectors."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.constants import SECTOR_FUNDS, SECTOR_NAMES
from newsalpha.operators.joins import valid_on


def code_lookup(code: Column, table: dict[str, str]) -> Column:
    """Value of a code in a fixed table, null for an unknown code. A literal map needs no join."""
    return F.element_at(F.create_map(*(F.lit(text) for pair in table.items() for text in pair)), code)


def sector_name(code: Column) -> Column:
    return code_lookup(code, SECTOR_NAMES)


def sector_fund(code: Column) -> Column:
    return code_lookup(code, SECTOR_FUNDS)


def usable_spells(spells: DataFrame) -> DataFrame:
    return (
        spells.select("permno", F.col("gsector").cast("string").alias("gsector"), "effstartdt", "effenddt")
        .dropna(subset=["gsector", "effstartdt", "effenddt"])
        .distinct()
    )


def disjoint_spells(spells: DataFrame) -> DataFrame:
    """Spells cut at each other's ends, so that an issuer has at most one on any day.

    Where spells overlap the latest start wins, then the smallest code. An issuer has few spells, so the
    cut is small work, and done once for all rows that ask for a sector.
    """
    usable = usable_spells(spells)
    cuts = usable.select("permno", F.explode(F.array("effstartdt", F.date_add("effenddt", 1))).alias("first")).distinct()
    following = F.lead("first").over(Window.partitionBy("permno").orderBy("first"))
    pieces = cuts.withColumn("last", F.date_sub(following, 1)).where(F.col("last").isNotNull())
    best = F.min(F.struct((-F.unix_date("effstartdt")).alias("age"), "gsector"))
    return (
        pieces.join(usable, "permno")
        .where(valid_on("first", "effstartdt", "effenddt"))
        .groupBy("permno", "first", "last")
        .agg(best.alias("best"))
        .select("permno", "first", "last", "best.gsector")
    )


def sector_on(rows: DataFrame, spells: DataFrame, day: str) -> DataFrame:
    """Add ``gsector`` to rows of an issuer on a day; rows without a spell go.

    At most one disjoint spell holds a day, so the join neither multiplies rows nor needs a choice behind it.
    """
    return rows.drop("gsector").join(disjoint_spells(spells), "permno").where(valid_on(day, "first", "last")).drop("first", "last")


def merge_sector(labeled: DataFrame, spells: DataFrame) -> DataFrame:
    """Headlines with the sector valid on their date, and its name. The headlines are read once."""
    return sector_on(labeled, spells, "article_date").withColumn("sector_name", sector_name(F.col("gsector")))


def sector_on_daily(daily: DataFrame, spells: DataFrame) -> DataFrame:
    """The same for daily rows."""
    return sector_on(daily, spells, "date")
