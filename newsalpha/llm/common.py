"""Tables, staged intermediates and small helpers of the corpus operators."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from newsalpha.session import DROPS_SHUFFLES, configure, released, shuffles_dropped, stage  # noqa: F401

# Rows of one Arrow batch. Texts may be long, so a batch holds few of them.
BATCH_ROWS = 256
BATCH_BYTES = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every corpus operator wants: those of the package, and small Arrow batches."""
    configure(spark)
    # The driver keeps the text of plans; those with tables of counters as literals are megabytes long.
    spark.conf.set("spark.sql.maxPlanStringLength", "100000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back; lineage ends there.

    The shuffle files behind it are of no more use. Spark drops them when the driver collects its garbage,
    which an idle driver seldom does, so it is asked to.
    """
    written = stage(df, name)
    df.sparkSession._jvm.System.gc()
    return written


def rows_mapped(df: DataFrame, work: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``work`` to the columns of each Arrow batch, given and returned as lists by name."""
    fields = _arrow_fields(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = work({name: batch.column(name).to_pylist() for name in batch.schema.names})
            if len(made[fields[0][0]]):
                yield pa.RecordBatch.from_arrays([pa.array(made[n], t) for n, t in fields], names=[n for n, _ in fields])

    return df.mapInArrow(batches, schema)


def columns_added(
    df: DataFrame, using: str, work: Callable[[list], dict[str, list]], schema: str, keep: list[str] | None = None
) -> DataFrame:
    """Add the columns that ``work`` makes from the column ``using`` of each Arrow batch.

    Of ``df``, the columns in ``keep`` stay (all by default) and are not touched; one that has the name of a
    new column is replaced.
    """
    fields = _arrow_fields(schema)
    new = {name for name, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = work(batch.column(USED).to_pylist())
            arrays = [*(batch.column(c) for c in kept), *(pa.array(made[n], t) for n, t in fields)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *(n for n, _ in fields)])

    types = StructType([*(df.schema[c] for c in kept), *StructType.fromDDL(schema).fields])
    source = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{using}`").alias(USED))
    return source.mapInArrow(batches, types)


# Name under which a batch has the column that is worked on.
USED = "__used"


def _arrow_fields(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(field.name, to_arrow_type(field.dataType)) for field in StructType.fromDDL(schema).fields]


def components(edges: DataFrame, name: str) -> DataFrame:
    """Smallest reachable id of every node that has an edge.

    ``edges`` has long columns ``a`` and ``b``. Alternates two steps until nothing changes: hand the
    larger neighbours of a node to its smallest one, then the smaller ones. Each round is written to the
    shared folder, so its lineage is short and a lost executor costs one round. Hubs are joined, not
    collected: a neighbourhood is never in one row.
    Returns ``node``, ``component``.
    """
    links = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    links, before = staged(links, name), None
    while True:
        last = links
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.where("u <> v").distinct()
        lowest = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = staged(smaller.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), name)
        released(last)
        state = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(u, v) >> 20)")).first()
        if state == before:
            break
        before = state
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
