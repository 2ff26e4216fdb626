"""Headline length statistics of a repeatable sample."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.constants import SAMPLE_SEED, SAMPLE_SIZE
from newsalpha.operators.sampling import sample_n
from newsalpha.operators.statistics import text_length_stats


def headline_length_report(headlines: DataFrame, keys: list[str], column: str = "headline", n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED, measures: dict | None = None) -> DataFrame:
    present = headlines.where(F.col(column).isNotNull())
    return text_length_stats(sample_n(present, n, keys, seed), column, measures=measures)
