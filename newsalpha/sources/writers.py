"""Writers. Nothing here passes data through the driver."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def write_dataset(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), sort_by: tuple[str, ...] = ()) -> None:
    """Parquet with even files: partitions are rebalanced, so a year that holds a large
    share of the rows is split over several tasks and small years share one."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_dataset(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Write the partitions that ``df`` has rows for, each in place of what it held; others stay. Safe to run again."""
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """Result rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
