"""Expressions on ``array<float>`` or ``array<double>`` vectors."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsalpha.functions.numbers import sigmoid


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def l2_normalize(vector: Column) -> Column:
    """Unit vector; the zero vector stays as it is."""
    length = F.nullif(norm(vector), F.lit(0.0))
    return F.transform(as_doubles(vector), lambda x: F.coalesce(F.try_divide(x, length), x))


def combine(plus: Column, minus: Column, plus_too: Column) -> Column:
    """``plus - minus + plus_too``, entry by entry."""
    difference = F.zip_with(as_doubles(plus), as_doubles(minus), lambda x, y: x - y)
    return F.zip_with(difference, as_doubles(plus_too), lambda x, y: x + y)


def linear_score(vector: Column, weights: Column, intercept: Column) -> Column:
    """Logistic score of a vector under given weights."""
    return sigmoid(dot(vector, weights) + intercept)
