"""Text to vectors with a model that the caller supplies."""

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsalpha.functions.vectors import as_doubles, l2_normalize
from newsalpha.sources.writers import append_dataset, stored_or_none

BATCH_SIZE = 128
# Chunks of a text that one row holds for a model.
CHUNKS = 64
# Texts of one task of a model.
ROWS_PER_TASK = 50_000


class Embedder(Protocol):
    """Anything that turns texts into one vector each."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEmbedder:
    """Signed hashing of lower-case words: the default where no model is at hand.

    A word's MD5 digest gives its position and its sign. The vector of a text is the sum
    over all its words, scaled to unit length.
    """

    def __init__(self, size: int = 768):
        self.size = size
        self.place = lru_cache(maxsize=100_000)(self._place)

    def _place(self, word: str) -> int:
        """Position from 1 on, negative where the sign is."""
        digest = hashlib.md5(word.encode()).hexdigest()
        position = int(digest[:8], 16) % self.size + 1
        return position if int(digest[8], 16) % 2 == 0 else -position

    def encode(self, texts: list[str]) -> np.ndarray:
        words = [text.lower().split() for text in texts]
        places = np.fromiter((self.place(word) for group in words for word in group), np.int64)
        row = np.repeat(np.arange(len(texts)), [len(group) for group in words])
        cells = row * self.size + np.abs(places) - 1
        vectors = np.bincount(cells, np.sign(places), len(texts) * self.size).reshape(len(texts), self.size)
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        return (vectors / np.where(lengths == 0, 1, lengths)).astype(np.float32)


def pool_tokens(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean of the unmasked token vectors per text; zeros where all are masked.

    For embedders whose model returns one vector per token.
    """
    weights = mask[..., None].astype(hidden.dtype)
    return (hidden * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), 1e-9)


_models: dict[str, Embedder] = {}


def model_of(name: str, make: Callable[[], Embedder]) -> Embedder:
    """The model of this Python worker, loaded at its first batch and kept for later tasks.

    A worker keeps one model; the next one takes its place.
    """
    if name not in _models:
        _models.clear()
        _models[name] = make()
    return _models[name]


def embed_texts(texts: DataFrame, column: str, make: Callable[[], Embedder], batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add ``embedding`` to every row: Arrow batches in, one list column out."""
    others = texts.columns
    name = hashlib.md5(cloudpickle.dumps(make)).hexdigest()

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(name, make)
        for part in parts:
            for start in range(0, part.num_rows, batch_size):
                piece = part.slice(start, batch_size)
                words = [text or "" for text in piece.column(column).to_pylist()]
                vectors = np.asarray(model.encode(words), dtype=np.float32)
                offsets = np.arange(len(words) + 1, dtype=np.int32) * vectors.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))
                yield pa.RecordBatch.from_arrays([*piece.columns, lists], names=[*others, "embedding"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return texts.mapInArrow(encode, f"{fields}, embedding array<float>")


def spread(texts: DataFrame, *keys: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal texts out to tasks by number, since a model's time goes by texts and not by bytes.

    A task that fails repeats ``rows_per_task`` texts, not a whole file split.
    """
    return texts.repartition(max(1, -(-texts.count() // rows_per_task)), *keys)


def embed_headlines(headlines: DataFrame, make: Callable[[], Embedder] = HashingEmbedder, key: str = "rp_story_id", normalize: bool = False, prompt: str = "") -> DataFrame:
    """(story, embedding), one row per story; a missing headline counts as empty.

    The model sees each distinct text once, since copies may be a large part of the news;
    the vectors are then joined back. A model that wants a prompt gets it in front of
    the text, and one that returns raw means can be scaled to unit length.
    """
    stories = headlines.groupBy(key).agg(F.coalesce(F.min("headline"), F.lit("")).alias("headline"))
    texts = stories.select(F.concat(F.lit(prompt), "headline").alias("text"), "headline").distinct()
    vectors = embed_texts(spread(texts, "headline"), "text", make)
    if normalize:
        vectors = vectors.withColumn("embedding", l2_normalize(F.col("embedding")).cast("array<float>"))
    return stories.join(vectors, "headline").select(key, "embedding")


def not_yet_embedded(headlines: DataFrame, stored: DataFrame, key: str = "rp_story_id") -> DataFrame:
    return headlines.join(stored.select(key), key, "left_anti")


def append_new_embeddings(headlines: DataFrame, path: str, make: Callable[[], Embedder] = HashingEmbedder, key: str = "rp_story_id") -> None:
    """Embed the stories that are not stored yet and append them; safe to run again."""
    stored = stored_or_none(headlines.sparkSession, path)
    todo = headlines if stored is None else not_yet_embedded(headlines, stored, key)
    append_dataset(embed_headlines(todo, make, key), path)


def mean_pool(tokens: DataFrame, key: str, mask: str = "attention_mask", vector: str = "embedding") -> DataFrame:
    """Mean vector of the unmasked tokens per text; zeros where all are masked.

    One aggregate over vectors with partial sums, not one row per dimension. A masked token
    takes part as a zero vector of negligible weight: it does not change a mean, and it
    keeps the texts that have no other token.
    """
    live = F.col(mask) == 1
    values = F.when(live, as_doubles(F.col(vector))).otherwise(F.transform(as_doubles(F.col(vector)), lambda x: F.lit(0.0)))
    weighted = tokens.select(
        key, array_to_vector(values).alias("v"), F.when(live, 1.0).otherwise(1e-30).alias("w")
    )
    means = weighted.groupBy(key).agg(Summarizer.mean(F.col("v"), F.col("w")).alias("m"))
    return means.select(key, vector_to_array("m").alias(vector))


def chunk_embed_average(texts: DataFrame, key: str, column: str, make: Callable[[], Embedder] = HashingEmbedder, chunk_words: int = 64) -> DataFrame:
    """Long texts: cut into chunks of words, embed each chunk, average per text.

    The whole text is used. The tasks that read the texts cut them into rows of ``CHUNKS`` chunks, embed these and send on the mean
    of a row's vectors; means of one text are averaged by their chunks. Neither chunks nor their vectors are shuffled.
    """
    words = F.filter(F.split(F.coalesce(column, F.lit("")), r"(?U)\s+"), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(chunk_words * CHUNKS))
    parts = texts.select(key, words.alias("words")).select(
        key, F.explode(F.transform(starts, lambda s: F.array_join(F.slice("words", s, F.lit(chunk_words * CHUNKS)), " "))).alias("part")
    )
    name = hashlib.md5(cloudpickle.dumps(make)).hexdigest()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(name, make)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_SIZE):
                piece = batch.slice(start, BATCH_SIZE)
                chunks, owner = [], []
                for row, text in enumerate(piece.column("part").to_pylist()):
                    split = text.split(" ")
                    for at in range(0, len(split), chunk_words):
                        chunks.append(" ".join(split[at : at + chunk_words]))
                        owner.append(row)
                first = np.searchsorted(owner, np.arange(piece.num_rows))
                vectors = np.concatenate([
                    np.asarray(model.encode(chunks[i : i + BATCH_SIZE]), dtype=np.float32) for i in range(0, len(chunks), BATCH_SIZE)
                ])
                counts = np.diff(np.r_[first, len(chunks)])
                means = np.add.reduceat(vectors, first, axis=0, dtype=np.float64) / counts[:, None]
                offsets = pa.array(np.arange(piece.num_rows + 1, dtype=np.int32) * means.shape[1])
                lists = pa.ListArray.from_arrays(offsets, pa.array(means.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column(key), lists, pa.array(counts.astype(np.float64))], names=[key, "mean", "chunks"])

    means = parts.mapInArrow(add, f"`{key}` {texts.schema[key].dataType.simpleString()}, mean array<double>, chunks double")
    # Parts of one text meet as means that are weighted by their chunks.
    whole = means.select(key, array_to_vector("mean").alias("v"), "chunks").groupBy(key).agg(Summarizer.mean(F.col("v"), F.col("chunks")).alias("m"))
    return whole.select(key, vector_to_array("m").alias("embedding"))


def token_counts(texts: DataFrame, column: str, count: Callable[[list[str]], list[int]] | None = None, into: str = "tokens") -> DataFrame:
    """Tokens per text by the built-in word and punctuation rule, or by a tokenizer.

    ``count`` gets a list of texts and returns their token counts without special
    tokens and without cutting.
    """
    if count is None:
        from newsalpha.functions.text import token_count

        return texts.withColumn(into, token_count(F.col(column)))
    return texts.withColumn(into, tokenizer_udf(count)(F.col(column)))


def tokenizer_udf(count: Callable[[list[str]], list[int]]) -> Callable[[Column], Column]:
    import pandas as pd

    @F.pandas_udf("bigint")
    def lengths(texts: pd.Series) -> pd.Series:
        present = texts.fillna("").tolist()
        return pd.Series(count(present), index=texts.index).where(texts.notna())

    return lengths


def hashing_embedder(size: int = 768) -> Callable[[], Embedder]:
    return partial(HashingEmbedder, size)
