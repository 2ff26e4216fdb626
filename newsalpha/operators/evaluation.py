"""Measures of forecasts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.functions.numbers import correlation


def classify_accuracy(predictions: DataFrame, *keys: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts and accuracy; a probability at the threshold counts as positive."""
    up = F.col("p_up") >= threshold
    positive = F.col("label") == 1
    return predictions.groupBy(*keys).agg(
        F.count_if(up & positive).alias("tp"),
        F.count_if(~up & ~positive).alias("tn"),
        F.count_if(up & ~positive).alias("fp"),
        F.count_if(~up & positive).alias("fn"),
        F.avg((up == positive).cast("int")).alias("accuracy"),
    )


def accuracy_by_year(predictions: DataFrame) -> DataFrame:
    """Accuracy per model and year."""
    return classify_accuracy(predictions, "model", "oos_year").select("model", "oos_year", "accuracy")


def oos_forecast_correlation(forecasts: DataFrame) -> DataFrame:
    """Correlation of predicted and realized return over complete pairs."""
    complete = forecasts.dropna(subset=["score", "ret"])
    return complete.agg(
        F.count("*").alias("n"), correlation(F.col("score"), F.col("ret")).alias("oos_correlation")
    )
