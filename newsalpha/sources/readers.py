"""Readers. Column choice and filters reach the parquet scan."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsalpha.schemas import require_unique

# Column names of the two layouts of the daily stock table.
NEW_LAYOUT = {
    "dlycaldt": "date",
    "dlyret": "ret",
    "dlyretx": "retx",
    "dlyprc": "prc",
    "dlyshrout": "shrout",
    "dlyvol": "vol",
}
DAILY_COLUMNS = ["permno", "date", "ret", "retx", "prc", "shrout", "vol"]


def scan_columns(spark: SparkSession, path: str, columns: list[str], where: Column | None = None) -> DataFrame:
    """A column subset of a parquet table with an optional filter."""
    df = spark.read.parquet(path).select(*columns)
    return df if where is None else df.where(where)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The stored daily stock table, checked for one row per issuer and day."""
    return require_unique(normalize_daily(spark.read.parquet(path)), "permno", "date")


def scan_chunks(spark: SparkSession, folder: str, key: str = "rp_story_id", pattern: str = "chunk_*.parquet") -> DataFrame:
    """All chunk files of a folder as one table with one row per id.

    Files that hold one column per dimension are read too; their ``dim_0 … dim_n``
    columns become one vector column. Of several vectors of an id the smallest is taken.
    """
    df = gather_dimensions(spark.read.option("pathGlobFilter", pattern).parquet(folder))
    first = Window.partitionBy(key).orderBy(*(c for c in df.columns if c != key))
    return df.withColumn("choice", F.row_number().over(first)).where(F.col("choice") == 1).drop("choice")


def gather_dimensions(df: DataFrame, prefix: str = "dim_", vector: str = "embedding") -> DataFrame:
    """Pack ``dim_0 … dim_n`` into one array column, in numeric order."""
    dims = sorted((c for c in df.columns if c.startswith(prefix)), key=lambda c: int(c[len(prefix) :]))
    if not dims:
        return df
    others = [c for c in df.columns if c not in dims]
    return df.select(*others, F.array(*dims).alias(vector))


def spread_dimensions(df: DataFrame, size: int, prefix: str = "dim_", vector: str = "embedding") -> DataFrame:
    """One column per dimension, for readers that expect the wide layout."""
    others = [c for c in df.columns if c != vector]
    return df.select(*others, *(F.col(vector)[i].alias(f"{prefix}{i}") for i in range(size)))


def scan_years(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """The years ``first`` to ``last`` of a table that has a folder per year; no other folder is opened."""
    return spark.read.parquet(folder).where(F.col("year").between(first, last))


def union_years(frames: dict[int, DataFrame]) -> DataFrame:
    """One table per year appended to one, with the year as a column."""
    dated = [df.withColumn("year", F.lit(year)) for year, df in sorted(frames.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dated)


def normalize_daily(df: DataFrame) -> DataFrame:
    """Either layout of the daily stock table as one schema; the new one wins."""
    present = set(df.columns)
    if "dlycaldt" in present:
        names = {old: new for old, new in NEW_LAYOUT.items() if old in present}
        df = df.drop(*(new for new in names.values() if new in present)).withColumnsRenamed(names)
    return df.select(*(c for c in DAILY_COLUMNS if c in df.columns))
