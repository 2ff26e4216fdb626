"""Exact linear quantiles by counting the cells of each column's range."""

from functools import reduce
from math import ceil, floor, isnan
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells a range is cut into, and rows that are left in all open ranges when their values are read one by one.
CELLS = 1024
FEW = 10_000


class Range(NamedTuple):
    """Values of a column from ``low`` to ``high``: the first of them has the place ``start``."""

    name: str
    low: float
    high: float
    start: int
    count: int


def binade(x: Column) -> Column:
    """A whole number that never falls as the value rises: sign and power of two; values that are no number come last."""
    power = F.greatest(F.lit(-1100.0), F.least(F.lit(1100.0), F.floor(F.log2(F.abs(x))).cast("double"))) + 1200
    return F.when(F.isnan(x), 9999).when(x == 0, 0).otherwise(F.signum(x) * power).cast("int")


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], cells: int = CELLS, few: int = FEW) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of several columns; nulls are left out, NaN counts as the largest value.

    One pass counts the rows of all columns by sign and power of two, with the least and the largest value of each cell.
    A wanted place that is the first or the last of its cell, or in a cell of one value, is settled; the other
    cells it needs are cut into ``cells`` equal parts and counted again, until few rows are left in them. Counts,
    minima and maxima merge, so nothing is sorted or moved but one row per cell and task, whatever the values are;
    equal values cannot crowd a task. Each pass reads the columns once; a cell's width is at most 1 / ``cells`` of the
    one before, so doubles take six passes at most. A column without values has null quantiles.
    """
    values = df.select(F.explode(F.array(*(
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x")) for c in columns
    ))).alias("v")).select("v.*").where("x is not null")
    cell = (F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    totals: dict[str, int] = {}
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    open_: list[Range] = []
    for row in sorted(values.groupBy("name", binade(F.col("x")).alias("cell")).agg(*cell).collect(), key=lambda r: (r["name"], r["cell"])):
        open_.append(Range(row["name"], row["low"], row["high"], totals.get(row["name"], 0), row["n"]))
        totals[row["name"]] = totals.get(row["name"], 0) + row["n"]
    wanted = {c: sorted({f(p * (totals[c] - 1)) for p in probabilities for f in (floor, ceil)}) for c in totals}
    while open_ := _settled(open_, wanted, found):
        within = [(F.col("name") == r.name) & F.col("x").between(r.low, r.high) for r in open_]
        which = reduce(lambda made, i: made.when(within[i], i), range(1, len(open_)), F.when(within[0], 0))
        rows = values.withColumn("range", which).where("range is not null")
        if sum(r.count for r in open_) <= few:
            counted = rows.groupBy("range", "x").agg(F.count("*").alias("n")).select("range", "n", F.col("x").alias("low"), F.col("x").alias("high"))
            order = "low"
        else:
            lows, highs = (F.element_at(F.array(*map(F.lit, side)), F.col("range") + 1) for side in ([r.low for r in open_], [r.high for r in open_]))
            # Of one sign and power of two, so the width is finite and not zero. Rising values never fall into a lower cell.
            place = F.floor((F.col("x") - lows) / (highs - lows) * cells).cast("double")
            counted = rows.groupBy("range", F.least(place, F.lit(cells - 1.0)).cast("int").alias("cell")).agg(*cell)
            order = "cell"
        parts: list[Range] = []
        at = [r.start for r in open_]
        for row in sorted(counted.collect(), key=lambda r: (r["range"], r[order])):
            parts.append(Range(open_[row["range"]].name, row["low"], row["high"], at[row["range"]], row["n"]))
            at[row["range"]] += row["n"]
        open_ = parts
    return {c: [_between(found[c], p * (totals[c] - 1)) if c in totals else None for p in probabilities] for c in columns}


def _settled(ranges: list[Range], wanted: dict[str, list[int]], found: dict[str, dict[int, float]]) -> list[Range]:
    """Note the wanted places that the ranges tell; the ranges that have others."""
    left = []
    for r in ranges:
        inside = [k for k in wanted[r.name] if r.start <= k < r.start + r.count]
        # Values without order or width, infinite ones among them, are alone in their cell.
        one = r.low == r.high or isnan(r.low)
        for k in inside:
            if one or k in (r.start, r.start + r.count - 1):
                found[r.name][k] = r.low if one or k == r.start else r.high
        if any(k not in found[r.name] for k in inside):
            left.append(r)
    return left


def _between(values: dict[int, float], place: float) -> float:
    low = int(place)
    if place == low:
        return values[low]
    return values[low] + (values[low + 1] - values[low]) * (place - low)
