"""The macro table."""

from pyspark.sql import DataFrame

from newsalpha.operators.macro import coalesce_rates, forward_fill, step_series, unit_scale, widen


def macro_table(macro: DataFrame, series: list[str]) -> DataFrame:
    """One row per day: scaled and filled series, the joined reserve rate, the policy limits."""
    wide = widen(forward_fill(unit_scale(macro)), series)
    return step_series(coalesce_rates(wide)).drop("IORR", "IOER", "IORB")
