"""Contiguous shards of nearly equal bytes."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.llm.common import staged

# Bytes that a row takes besides its text.
ROW_BYTES = 16


def byte_shards(df: DataFrame, shards: int = 40, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Cut the rows, in order of their id, into ``shards`` intervals of nearly equal bytes.

    Law ``bytes``: the rows are range-partitioned by id, every partition reports its bytes and rows, and
    running totals over these few figures give each partition its place. A row's prefix sum is that place
    plus the sum inside its partition; the shard is the target interval that holds the row's middle byte,
    so the bytes of a shard differ from the target by one row at most at either end. Only ids, sizes and
    checksums are shuffled, never texts.

    Null text: no bytes, checksum 0. Null ids come first. Rows with equal ids are told apart by checksum
    and by their place in the input, so repeated rows and a hot id spread over partitions. Empty table:
    no rows. Other columns are ignored.
    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, bytes_before``.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    keys = df.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = ["doc_id", "text_crc32", "place"]
    rows = staged(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards")
    totals = rows.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    # One row per partition: an unpartitioned window over them is small.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("bytes_offset"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_offset"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    placed = rows.select(
        *rows.columns,
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.row_number().over(inside).alias("number"),
    ).join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32",
        (F.col("bytes_offset") + F.col("upto") - F.col("size")).alias("bytes_before"),
        (F.col("rows_offset") + F.col("number") - 1).alias("rank"),
        "all_bytes",
    ).withColumn("shard", F.expr(f"cast((2 * bytes_before + size) * {shards} div (2 * all_bytes) as int)"))
    starts = placed.groupBy("shard").agg(F.min("rank").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "bytes_before",
    )
