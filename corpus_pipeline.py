"""The corpus pipeline: documents through five operators, each stage on all that the one before it kept."""

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsalpha.llm import benchmark, bpe, common, language, lines, minhash  # noqa: E402
from newsalpha.session import remove_at_exit, shared_folder  # noqa: E402

# Below this a language is less certain than two even guesses, one for the family and one within it.
LEAST_SCORE = 0.25


def _packed(docs: DataFrame) -> DataFrame:
    """Id, text and the whole row, so that no column of an operator meets one of the documents."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels teach: those that are undetermined or a guess go.

    Null and empty texts and texts without a letter are undetermined. Rows of one id are judged by their own text; a null id is
    never held out. Without any labelled row all are undetermined. Columns of any name stay as they are.
    """
    common.prepare(spark)
    model = language.fit(docs.where(~language.held_out()))
    found = language.identify(_packed(docs), model, keep=["row"])
    return found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier line repeats; ``n_chars`` follows the text.

    A null text stays null and keeps its ``n_chars``; an empty one stays empty. Documents go by id, null ids first; rows equal in id
    and text are treated alike. Columns of any name stay as they are.
    """
    common.prepare(spark)
    cleaned = lines.deduplicate_lines(_packed(docs), percent=80)
    values = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast("long"), F.col("row.n_chars"))}
    return cleaned.select(*(values.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    Null, empty and blank texts and rows without an id are in no group and stay. Rows that share an id stay or go together.
    """
    common.prepare(spark)
    found = minhash.near_duplicates(docs, words=5, percent=80)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts have none and stay; so does every row where the benchmark is empty. Each row is judged by its own text.
    """
    common.prepare(spark)
    found = benchmark.contamination(_packed(docs).select("text", "row"), common.table(spark, sf_dir, "benchmark"), percent=80)
    return found.where(F.size("leaks") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded bytes, per document, in place of the text.

    A null text counts as empty: no tokens, digests of nothing. Repeated rows give repeated rows; a column with the name of a new
    one is replaced.
    """
    common.prepare(spark)
    kept = [c for c in docs.columns if c != "text"]
    return bpe.encode(docs, *bpe.public_tokenizer(), output="digests", keep=kept)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", encode),
]

# Language models, signatures and merges have no SQL form: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = os.path.join(shared_folder(spark), f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        remove_at_exit(spark, path)
        docs = spark.read.parquet(path)
    return docs
