"""Rolling years: windows, splits, fits and out-of-sample predictions."""

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsalpha.constants import (
    C_GRID,
    MIN_TEST_ROWS,
    MIN_TRAIN_ROWS,
    MIN_VALIDATION_ROWS,
    TRAIN_YEARS,
    VALIDATION_YEARS,
)
from newsalpha.operators.logistic import train_logistic
from newsalpha.operators.sampling import sample_n
from newsalpha.schemas import SCHEMAS
from newsalpha.session import new_folder, released, shuffles_dropped, stage
from newsalpha.sources.writers import replace_partitions, stored_or_none

# Slices of the stories whose vectors are shuffled one after the other.
SLICES = 4


def rolling_windows(labeled: DataFrame, train_years: int = TRAIN_YEARS, val_years: int = VALIDATION_YEARS, day: str = "article_date") -> DataFrame:
    """(oos_year, split, start_date, end_date) for every year that has a full history."""
    years = labeled.agg(F.min(F.year(day)).alias("first"), F.max(F.year(day)).alias("last"))
    first = F.col("first") + train_years + val_years
    test_years = years.where(first <= F.col("last")).select(F.explode(F.sequence(first, F.col("last"))).alias("oos_year"))
    year = F.col("oos_year")
    spans = [
        ("train", year - val_years - train_years, year - val_years - 1),
        ("val", year - val_years, year - 1),
        ("test", year, year),
    ]
    return test_years.select(
        "oos_year",
        F.inline(F.array(*(
            F.struct(
                F.lit(split).alias("split"),
                F.make_date(start, F.lit(1), F.lit(1)).alias("start_date"),
                F.make_date(end, F.lit(12), F.lit(31)).alias("end_date"),
            )
            for split, start, end in spans
        ))),
    )


def window_split_counts(labeled: DataFrame, train_years: int = TRAIN_YEARS, val_years: int = VALIDATION_YEARS, day: str = "article_date") -> DataFrame:
    """Rows per split and window, and whether they suffice for a fit.

    Rows are first counted per year, so windows that overlap do not multiply them.
    """
    per_year = labeled.groupBy(F.year(day).alias("year")).agg(F.count("*").alias("n"))
    windows = rolling_windows(labeled, train_years, val_years, day)
    years = windows.select(
        "oos_year", "split", F.explode(F.sequence(F.year("start_date"), F.year("end_date"))).alias("year")
    )
    counts = (
        years.join(per_year, "year", "left")
        .groupBy("oos_year")
        .agg(*(
            F.coalesce(F.sum(F.when(F.col("split") == split, F.col("n"))), F.lit(0)).alias(f"n_{split}")
            for split in ("train", "val", "test")
        ))
    )
    usable = (
        (F.col("n_train") >= MIN_TRAIN_ROWS) & (F.col("n_val") >= MIN_VALIDATION_ROWS) & (F.col("n_test") >= MIN_TEST_ROWS)
    )
    return counts.withColumn("usable", usable)


def join_embeddings(labeled: DataFrame, embeddings: DataFrame, key: str = "rp_story_id") -> DataFrame:
    """Labels with the vector of their story."""
    return labeled.join(embeddings.select(key, "embedding"), key)


def one_per_story(df: DataFrame, *order: str, key: str = "rp_story_id") -> DataFrame:
    """The first row of each story in the given order."""
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("choice", F.row_number().over(first)).where(F.col("choice") == 1).drop("choice")


@dataclass
class RollingResult:
    metrics: DataFrame
    predictions: DataFrame


def rolling_oos(
    labeled: DataFrame,
    embeddings: DataFrame,
    model: str = "model",
    train_years: int = TRAIN_YEARS,
    val_years: int = VALIDATION_YEARS,
    c_grid: Iterable[float] = tuple(C_GRID),
    skip_years: Iterable[int] = (),
    caps: dict[str, int] | None = None,
) -> RollingResult:
    """Train on past years, choose C on the validation years, predict the year after.

    Labels and vectors are joined once and staged by year, so each window reads only
    its own years; the staged rows go when the last window is done. A story counts once, with its earliest row and, of several vectors, the
    smallest. Windows need enough rows that found a vector. The loop runs over years, of
    which there are few; every fit and every prediction is a distributed job, and the
    predictions of a year are written before they are rated. ``caps`` limits rows per
    split by a repeatable sample; without it all rows count.
    """
    spark = labeled.sparkSession
    features = staged_features(labeled, embeddings, f"features-{model}").select(
        "rp_story_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "year"
    )
    joined = features.select(F.make_date("year", F.lit(1), F.lit(1)).alias("article_date"))
    usable = window_split_counts(joined, train_years, val_years).where("usable").orderBy("oos_year")
    skip = set(skip_years)
    metrics, predictions = [], []
    for row in usable.toLocalIterator():
        year = row["oos_year"]
        if year in skip:
            continue
        spans = {
            "train": (year - val_years - train_years, year - val_years - 1),
            "val": (year - val_years, year - 1),
            "test": (year, year),
        }
        split = {
            name: capped(features.where(F.col("year").between(*span)), (caps or {}).get(name))
            for name, span in spans.items()
        }
        fitted = train_logistic(split["train"], split["val"], c_grid)
        scored = stage(fitted.predict_proba(split["test"]).select("rp_story_id", "label", "p_up"), f"predictions-{model}")
        result = scored.agg(
            F.avg(((F.col("p_up") >= 0.5) == (F.col("label") == 1)).cast("int")).alias("accuracy"),
            F.count("*").alias("n_test"),
        ).first()
        metrics.append((
            model, year, fitted.best_c, fitted.val_accuracy, result["accuracy"],
            fitted.n_train, fitted.n_val, result["n_test"],
        ))
        predictions.append(scored.select("rp_story_id", F.lit(year).alias("oos_year"), "p_up"))
    # Metrics and predictions stand for themselves; the next model or run writes its own.
    released(features)
    empty = spark.createDataFrame([], SCHEMAS["predictions"])
    return RollingResult(
        spark.createDataFrame(metrics, SCHEMAS["rolling_metrics"]),
        reduce(lambda a, b: a.unionByName(b), predictions, empty).withColumn("model", F.lit(model)),
    )


def staged_features(labeled: DataFrame, embeddings: DataFrame, name: str, key: str = "rp_story_id") -> DataFrame:
    """(story, label, embedding, year) by year, written once: each label's story with its vector.

    Vectors take far more room than all else, so they are shuffled once, a slice of the stories at a time, and a slice's shuffle files go
    when it is written. The disk holds the table and the shuffle of one slice.
    """
    spark = labeled.sparkSession
    kinds = {df.schema[key].dataType.simpleString() for df in (labeled, embeddings)}
    # Equal keys have equal hashes if they are of one kind, and whole numbers or text.
    slices = SLICES if len(kinds) == 1 and kinds <= {"int", "bigint", "string"} else 1
    slice_ = F.pmod(F.xxhash64(key), F.lit(slices))
    folder = new_folder(spark, name)
    with shuffles_dropped(spark):
        for i in range(slices):
            stories, vectors = (df if slices == 1 else df.where(slice_ == i) for df in (labeled, embeddings))
            rows = join_embeddings(one_per_story(stories, "article_date", "label"), one_per_story(vectors, "embedding"), key).select(
                key,
                F.col("label").cast("double").alias("label"),
                F.col("embedding").cast("array<float>").alias("embedding"),
                F.year("article_date").alias("year"),
            )
            rows.write.mode("append").partitionBy("year").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def capped(rows: DataFrame, cap: int | None) -> DataFrame:
    return rows if cap is None else sample_n(rows, cap, ["rp_story_id"])


def years_to_run(usable: DataFrame, done: DataFrame, model: str) -> DataFrame:
    """Windows of a model that have no stored result yet."""
    finished = done.where(F.col("model") == model).select("oos_year")
    return usable.where("usable").join(finished, "oos_year", "left_anti")


def rolling_resume(labeled: DataFrame, embeddings: DataFrame, folder: str, model: str = "model", **options) -> RollingResult:
    """Run the years that are missing from ``folder`` and return all stored results.

    Both tables have a partition per model and year, which is replaced as a whole. Predictions are stored before
    the metrics, and a year counts as done by its metrics. So a run that stops anywhere, in the middle of a write
    too, is repeated for the years that are not done and leaves the same rows as one that did not stop.
    """
    spark = labeled.sparkSession
    metrics_path, predictions_path = f"{folder}/metrics", f"{folder}/predictions"
    done = stored_or_none(spark, metrics_path)
    skip = [] if done is None else [r["oos_year"] for r in done.where(F.col("model") == model).select("oos_year").toLocalIterator()]
    fresh = rolling_oos(labeled, embeddings, model, skip_years=skip, **options)
    replace_partitions(fresh.predictions, predictions_path, ("model", "oos_year"))
    replace_partitions(fresh.metrics, metrics_path, ("model", "oos_year"))
    # With the declared schemas, since a run without a usable window leaves folders without files.
    return RollingResult(
        spark.read.schema(SCHEMAS["rolling_metrics"]).parquet(metrics_path),
        spark.read.schema(f"{SCHEMAS['predictions']}, model string").parquet(predictions_path),
    )


def run_models(labeled: DataFrame, embeddings: dict[str, DataFrame], **options) -> RollingResult:
    """The same run for each embedding table; results carry the model's name."""
    runs = [rolling_oos(labeled, table, name, **options) for name, table in embeddings.items()]
    return RollingResult(
        reduce(lambda a, b: a.unionByName(b), (r.metrics for r in runs)),
        reduce(lambda a, b: a.unionByName(b), (r.predictions for r in runs)),
    )
