"""Resumable embedding of a folder that keeps receiving headline files."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsalpha.operators.embedding import Embedder, HashingEmbedder, append_new_embeddings
from newsalpha.schemas import SCHEMAS


def embed_arrived(
    spark: SparkSession,
    source: str,
    output: str,
    progress: str,
    make: Callable[[], Embedder] = HashingEmbedder,
    schema: str = SCHEMAS["headlines"],
    files_per_batch: int = 1000,
) -> None:
    """Embed everything that has arrived in ``source`` since the last run, then stop.

    The stream's progress folder remembers the files, and the stored ids keep a story from
    being embedded twice when a batch is repeated or a story comes again.
    """

    def add(batch: DataFrame, _: int) -> None:
        append_new_embeddings(batch.select("rp_story_id", "headline"), output, make)

    (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
