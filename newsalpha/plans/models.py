"""From embeddings to stored out-of-sample predictions."""

from pyspark.sql import DataFrame, SparkSession

from newsalpha.operators.rolling import RollingResult, rolling_resume
from newsalpha.sources.writers import stored_or_none


def available_models(spark: SparkSession, folder: str, models: list[str]) -> dict[str, DataFrame]:
    """Embedding tables that exist under ``folder``."""
    tables = {model: stored_or_none(spark, f"{folder}/embeddings_{model}") for model in models}
    return {model: table for model, table in tables.items() if table is not None}


def run_available_models(labeled: DataFrame, folder: str, results: str, models: list[str], **options) -> RollingResult | None:
    """Run every available model, skip finished years, return all stored results."""
    result = None
    for model, table in available_models(labeled.sparkSession, folder, models).items():
        result = rolling_resume(labeled, table, results, model, **options)
    return result
