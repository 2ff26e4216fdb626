"""Session settings and staged tables."""

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job wants. Shuffle sizes stay with the cluster: adaptive
# execution starts from a high partition count and merges small partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split an oversized join partition even where that costs one more shuffle,
    # because one issuer or story may hold a large share of all rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Spark's setting that removes the shuffle files of a query when it ends.
DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else has started."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        spark.sparkContext.addPyFile(_package_archive())
        _shipped.add(application)


_shipped: set[str] = set()


@lru_cache
def _package_archive() -> str:
    package = Path(__file__).parent
    target = os.path.join(tempfile.mkdtemp(prefix="newsalpha-"), package.name)
    return shutil.make_archive(target, "zip", package.parent, package.name)


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("newsalpha")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set and all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder()


@lru_cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="newsalpha-")


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a written folder when the application ends."""
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = written.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(files.makeQualified(written))


def new_folder(spark: SparkSession, name: str) -> str:
    """An empty folder in the shared one that goes when the application ends, to append to."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    made.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(made)
    remove_at_exit(spark, path)
    return path


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For tables that several jobs read: the lineage ends at files that outlive any
    executor, and readers prune by the partition columns, whose rows are rebalanced so
    that a task writes few of them. The files go when the application ends.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more: what was made from them is written itself."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files: Spark drops them with the end of each.

    Otherwise they stay until the driver collects its garbage and its cleaner has come round to them, which can
    only be asked for. For steps that write their results or collect them; nothing is persisted.
    """
    before = spark.conf.get(DROPS_SHUFFLES)
    spark.conf.set(DROPS_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROPS_SHUFFLES, before)
