"""Ordering, head and repeatable sampling."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.constants import SAMPLE_SEED

# Digits of a draw that one pass counts by, and draws of one leading part that are read one by one.
DIGITS = 3
FEW = 10_000


def ordered_output(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*keys)


def head_rows(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order, as a top-n and not a full sort."""
    return df.orderBy(*keys).limit(n)


def draw(keys: list[str], seed: int):
    """A number per row that depends on its keys and the seed only (32 hex digits)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def nth_draw(draws: DataFrame, n: int, digits: int = DIGITS, few: int = FEW) -> tuple[str, int, int] | None:
    """The n-th smallest draw, how many are smaller and how many equal it; None if there are fewer than ``n``.

    Draws are counted by their leading digits; those that begin like the n-th one are counted by their next
    digits, until few are left. No pass moves more than one count per leading part and task.
    """
    begin, before = "", 0
    while True:
        draw_, length = F.col("draw"), len(begin) + digits
        counted = draws.where(draw_.startswith(begin)).groupBy(F.substring(draw_, 1, length).alias("part")).agg(F.count("*").alias("n"))
        for row in sorted(counted.collect(), key=lambda r: r["part"]):
            if before + row["n"] >= n:
                break
            before += row["n"]
        else:
            return None
        begin = row["part"]
        if len(begin) < length:
            return begin, before, row["n"]
        if row["n"] <= few:
            # A last pass over whole draws: one count per draw.
            digits = 32


def sample_n(df: DataFrame, n: int, keys: list[str], seed: int = SAMPLE_SEED) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the same ones on every run.

    The rows with the smallest draws are taken. The n-th smallest draw is found by counting leading digits; rows up to
    it are then filtered where they lie, so a sample stays spread over the cluster and nothing is sorted, moved or
    written. Rows that share the n-th draw have equal keys; where not all of them are wanted, as many as
    are missing are taken in order of a hash of the row.
    """
    if n <= 0:
        return df.limit(0)
    drawn = df.withColumn("draw", draw(keys, seed))
    last = nth_draw(drawn.select("draw"), n)
    if last is None:
        return df
    value, smaller, equal = last
    if smaller + equal == n:
        return drawn.where(F.col("draw") <= value).drop("draw")
    at = drawn.where(F.col("draw") == value).orderBy(F.xxhash64(*df.columns)).limit(n - smaller)
    return drawn.where(F.col("draw") < value).unionByName(at).drop("draw")


def cap_splits(df: DataFrame, caps: dict[str, int | None], keys: list[str], seed: int = SAMPLE_SEED) -> DataFrame:
    """At most the given number of rows per split (no cap means all), repeatably."""
    parts = None
    for split, cap in caps.items():
        rows = df.where(F.col("split") == split)
        rows = rows if cap is None else sample_n(rows, cap, keys, seed)
        parts = rows if parts is None else parts.unionByName(rows)
    return parts
