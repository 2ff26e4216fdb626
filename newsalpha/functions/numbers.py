"""Arithmetic expressions that give null, never an error, where a ratio is undefined."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum of value times weight over sum of weight."""
    return ratio(F.sum(value * weight), F.sum(weight))


def correlation(x: Column, y: Column) -> Column:
    """Aggregate: Pearson correlation, null where one side is constant."""
    return ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def log_return(ret: Column) -> Column:
    return F.log(1 + ret)


def log_price_ratio(price: Column, previous: Column) -> Column:
    return F.log(ratio(price, previous))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * 100.0, whole)
