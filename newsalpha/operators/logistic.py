"""Standardization, L2 logistic regression and ridge regression."""

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsalpha.constants import C_GRID, RIDGE_GRID
from newsalpha.operators.sums import matrix, summed

# Largest entry of the mean loss's gradient at which a logistic fit ends, and passes over the rows it may take.
GRADIENT = 1e-9
PASSES = 1000
# Rows that are kept as one record.
PACKED = 2048
# Steps back that a fit's next direction is formed from.
MEMORY = 10


def standardize(train: DataFrame, features: str = "features", into: str = "scaled", n: int | None = None) -> PipelineModel:
    """A scaler fitted on the training rows, ``n`` of them if known: mean zero, population variance one.

    Spark divides by the sample deviation; a constant factor turns that into the
    population deviation.
    """
    scaler = StandardScaler(inputCol=features, outputCol="centred", withMean=True, withStd=True).fit(train)
    n = train.count() if n is None else n
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    stretch = ElementwiseProduct(
        scalingVec=Vectors.dense([factor] * len(scaler.mean)), inputCol="centred", outputCol=into
    )
    return PipelineModel([scaler, stretch])


@dataclass
class LinearModel:
    """A weight per place of a vector, and an intercept."""

    coefficients: DenseVector
    intercept: float

    def score(self, vectors: Column) -> Column:
        """The intercept plus the weighted sum of each vector's entries."""
        weights, intercept = self.coefficients.toArray(), self.intercept

        @F.pandas_udf("double")
        def weighted(rows: pd.Series) -> pd.Series:
            return pd.Series(np.stack(rows.to_numpy()) @ weights + intercept if len(rows) else [], dtype=float)

        return weighted(vector_to_array(vectors))


def positive_probability(model: LinearModel, df: DataFrame, into: str) -> DataFrame:
    """Add P(label = 1) of the column ``scaled``."""
    return df.withColumn(into, 1 / (1 + F.exp(-model.score(F.col("scaled")))))


@dataclass
class FittedLogistic:
    scaler: PipelineModel
    model: LinearModel
    best_c: float
    val_accuracy: float
    n_train: int
    n_val: int

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Add ``p_up``, the probability of a positive label."""
        return positive_probability(self.model, self.scaler.transform(df), "p_up").drop("centred", "scaled")


def train_logistic(train: DataFrame, validation: DataFrame, c_grid: Iterable[float] = tuple(C_GRID)) -> FittedLogistic:
    """One fit per C on the scaled training rows; the best validation accuracy wins.

    The objective is C * sum(loss) + |w|^2 / 2. All fits go forward together: a pass over the rows gives loss and gradient
    at the next place of every fit, from which the driver takes a quasi-Newton step. One pass over the
    validation rows rates all of them. Equal accuracies go to the earlier C. With one label only, the
    weights are zero and the intercept is infinite.
    """
    grid = list(c_grid)
    n = train.count()
    scaler = standardize(train, n=n)
    held = packed(train.select(F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x"))).persist()
    try:
        models = _logistic_fits(held, n, scaler, [1 / (c * n) for c in grid])
    finally:
        held.unpersist()
    weights = np.array([m.coefficients.toArray() for m in models]).reshape(len(models), -1)
    intercepts = np.array([m.intercept for m in models])

    def hits(part: pa.RecordBatch) -> np.ndarray:
        up = matrix(part, "x") @ weights.T + intercepts > 0
        return np.r_[part.num_rows, (up == (part.column("label").to_numpy() == 1)[:, None]).sum(axis=0)]

    rows = scaler.transform(validation).select(F.col("label").cast("double").alias("label"), vector_to_array("scaled").alias("x"))
    count, *right = summed(rows, hits, 1 + len(models))
    accuracies = [float(r / count) if count else None for r in right]
    best = max(range(len(models)), key=lambda i: (accuracies[i] or 0.0, -i))
    return FittedLogistic(scaler, models[best], grid[best], accuracies[best], n, int(count))


def packed(rows: DataFrame) -> DataFrame:
    """(n, y, x, narrow): the labels and vectors of some thousand rows as bytes, which are kept and read at a fraction of the cost of rows.

    Where all entries are numbers of single precision they are kept as such.
    """

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, PACKED):
                piece = part.slice(start, PACKED)
                x = matrix(piece, "x")
                with np.errstate(over="ignore"):
                    single = x.astype(np.float32)
                narrow = bool((single == x).all())
                y = piece.column("label").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    pa.array([piece.num_rows], pa.int32()), pa.array([np.ascontiguousarray(y, np.float64).tobytes()], pa.binary()),
                    pa.array([(single if narrow else np.ascontiguousarray(x)).tobytes()], pa.binary()), pa.array([narrow]),
                ], names=["n", "y", "x", "narrow"])

    return rows.mapInArrow(pack, "n int, y binary, x binary, narrow boolean")


def _logistic_fits(held: DataFrame, n: int, scaler: PipelineModel, penalties: list[float]) -> list[LinearModel]:
    """The minimum of mean loss + penalty * |w|^2 / 2 for each penalty, over the scaled rows of ``packed``.

    L-BFGS, whose first guess of the curvature is the bound x'x / 4 of the loss's. That is summed in one pass, together with
    the number of positive labels.
    """

    mean, deviation = (v.toArray() for v in (scaler.stages[0].mean, scaler.stages[0].std))
    dims = len(mean)
    # A constant entry is zero when scaled.
    scale = np.divide(scaler.stages[1].getScalingVec().toArray(), deviation, out=np.zeros(dims), where=deviation != 0)

    def scaled(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Scaled entries with a constant 1 behind them, and labels."""
        for count, y, x, narrow in zip(*(part.column(c).to_pylist() for c in ("n", "y", "x", "narrow"))):
            made = np.ones((count, dims + 1))
            np.subtract(np.frombuffer(x, np.float32 if narrow else np.float64).reshape(count, dims), mean, out=made[:, :dims])
            made[:, :dims] *= scale
            yield made, np.frombuffer(y)

    def moments(part: pa.RecordBatch) -> np.ndarray:
        return sum(np.r_[(x.T @ x).ravel(), y.sum()] for x, y in scaled(part))

    *square, positive = summed(held, moments, (dims + 1) ** 2 + 1)
    if positive in (0, n):
        return [LinearModel(Vectors.dense(np.zeros(dims)), math.inf if positive else -math.inf) for _ in penalties]
    curvature = np.reshape(square, (dims + 1, dims + 1)) / (4 * n)
    penalized = np.r_[np.ones(dims), 0.0]

    def losses(places: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        """Mean loss and its gradient at each place."""
        at = np.array(places)

        def work(part: pa.RecordBatch) -> np.ndarray:
            total = np.zeros((len(at), dims + 2))
            for x, y in scaled(part):
                score, y = x @ at.T, y[:, None]
                error = 1 / (1 + np.exp(-np.clip(score, -700, 700))) - y
                total += np.c_[(np.logaddexp(0, score) - y * score).sum(axis=0), error.T @ x]
            return total.ravel()

        found = summed(held, work, at.shape[0] * (dims + 2)).reshape(len(at), dims + 2) / n
        return [(row[0], row[1:]) for row in found]

    start = np.r_[np.zeros(dims), math.log(positive / (n - positive))]
    fits = [_Descent(start, penalty * penalized, curvature) for penalty in penalties]
    for _ in range(PASSES):
        open_ = [fit for fit in fits if not fit.done]
        if not open_:
            break
        for fit, (loss, gradient) in zip(open_, losses([fit.trial for fit in open_])):
            fit.step(loss, gradient)
    return [LinearModel(Vectors.dense(fit.place[:-1]), float(fit.place[-1])) for fit in fits]


class _Descent:
    """Quasi-Newton steps of one fit; ``trial`` is where it wants loss and gradient next."""

    def __init__(self, start: np.ndarray, penalty: np.ndarray, curvature: np.ndarray):
        self.penalty, self.trial, self.done = penalty, start, False
        guess = curvature + np.diag(penalty)
        self.inverse = np.linalg.pinv((guess + guess.T) / 2, hermitian=True)
        self.place, self.value, self.gradient, self.pairs, self.length = start, math.inf, None, [], 1.0

    def step(self, loss: float, gradient: np.ndarray) -> None:
        value = loss + (self.penalty * self.trial**2).sum() / 2
        gradient = gradient + self.penalty * self.trial
        if self.gradient is not None:
            moved = self.trial - self.place
            slack = 1e-14 * abs(self.value)
            if not value <= self.value + 1e-4 * moved @ self.gradient + slack:
                self.length /= 2
                self.trial = self.place + moved / 2
                # Not to be told from the place itself any more.
                self.done = self.length < 1e-10
                return
            change = gradient - self.gradient
            if moved @ change > 1e-300:
                self.pairs = [*self.pairs, (moved, change)][-MEMORY:]
            self.done = not moved.any()
        self.place, self.value, self.gradient, self.length = self.trial, value, gradient, 1.0
        self.done = self.done or np.abs(gradient).max() <= GRADIENT
        self.trial = self.place - self._solved(gradient)

    def _solved(self, gradient: np.ndarray) -> np.ndarray:
        """The gradient times the inverse curvature, as the last steps tell it."""
        left, shares = gradient.copy(), []
        for moved, change in reversed(self.pairs):
            share = moved @ left / (moved @ change)
            left -= share * change
            shares.append(share)
        made = self.inverse @ left
        if self.pairs:
            moved, change = self.pairs[-1]
            made *= (moved @ change) / (change @ self.inverse @ change)
        for (moved, change), share in zip(self.pairs, reversed(shares)):
            made += moved * (share - change @ made / (moved @ change))
        return made


@dataclass
class FittedRidge:
    model: LinearModel
    best_alpha: float
    val_mse: float

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("predicted_return", self.model.score(F.col("features")))


def train_ridge(train: DataFrame, validation: DataFrame, target: str = "ret", grid: Iterable[float] = tuple(RIDGE_GRID), mean_loss: bool = True) -> FittedRidge:
    """Ridge of a return on vectors, the penalty chosen by validation error.

    ``mean_loss`` means mean(error^2) + alpha |w|^2; otherwise sum(error^2) + alpha |w|^2. Two passes over the training rows give
    the means and the moments about them, from which the weights for every alpha follow; one pass over the validation rows
    rates all of them. Rows without a target take no part.
    """
    alphas = list(grid)
    train, validation = (
        df.where(F.col(target).isNotNull()).select(F.col(target).cast("double").alias("y"), vector_to_array("features").alias("x")) for df in (train, validation)
    )
    train = train.persist()
    try:
        dims = train.select(F.size("x")).first()[0]

        def rows(part: pa.RecordBatch) -> np.ndarray:
            return np.c_[matrix(part, "x"), part.column("y").to_numpy()]

        n, *totals = summed(train, lambda part: np.r_[part.num_rows, rows(part).sum(axis=0)], dims + 2)
        means = np.array(totals) / n
        square = summed(train, _squares(rows, means), (dims + 1) ** 2).reshape(dims + 1, dims + 1) / n
    finally:
        train.unpersist()
    models = []
    for alpha in alphas:
        weights = np.linalg.lstsq(square[:-1, :-1] + (alpha if mean_loss else alpha / n) * np.eye(dims), square[:-1, -1], rcond=None)[0]
        models.append(LinearModel(Vectors.dense(weights), float(means[-1] - means[:-1] @ weights)))
    weights, intercepts = np.array([m.coefficients.toArray() for m in models]), np.array([m.intercept for m in models])

    def errors(part: pa.RecordBatch) -> np.ndarray:
        gaps = matrix(part, "x") @ weights.T + intercepts - part.column("y").to_numpy()[:, None]
        return np.r_[part.num_rows, (gaps**2).sum(axis=0)]

    count, *squared = summed(validation, errors, 1 + len(models))
    mse = [float(e / count) if count else math.nan for e in squared]
    best = min(range(len(models)), key=lambda i: (mse[i], i))
    return FittedRidge(models[best], alphas[best], mse[best])


def _squares(rows: Callable[[pa.RecordBatch], np.ndarray], means: np.ndarray) -> Callable[[pa.RecordBatch], np.ndarray]:
    """Products of the columns about their means."""

    def work(part: pa.RecordBatch) -> np.ndarray:
        about = rows(part) - means
        return (about.T @ about).ravel()

    return work


def logistic_gradient(fitted: FittedLogistic, train: DataFrame) -> DataFrame:
    """(pos, gradient) of the mean loss plus |w|^2 / (2 C n) at the fitted weights; the intercept has the place -1.

    Zero everywhere for the weights of an exact fit on the same rows, whatever solver found them.
    """
    scored = positive_probability(fitted.model, fitted.scaler.transform(train).select("label", "scaled"), "p")
    penalty = [w / (fitted.best_c * fitted.n_train) for w in fitted.model.coefficients.toArray().tolist()]
    return _gradient(scored.select((F.col("p") - F.col("label")).alias("error"), vector_to_array("scaled").alias("x")), penalty)


def ridge_gradient(fitted: FittedRidge, train: DataFrame, target: str = "ret") -> DataFrame:
    """(pos, gradient) of half of mean(error^2) + alpha |w|^2 at the fitted weights; the intercept has the place -1."""
    scored = fitted.predict(train.where(F.col(target).isNotNull()))
    penalty = [fitted.best_alpha * w for w in fitted.model.coefficients.toArray().tolist()]
    return _gradient(scored.select((F.col("predicted_return") - F.col(target)).alias("error"), vector_to_array("features").alias("x")), penalty)


def _gradient(errors: DataFrame, penalty: list[float]) -> DataFrame:
    """Mean of error times entry per place, with a constant 1 at the place -1, plus the penalty's part."""
    entries = errors.select("error", F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("pos", "entry"))
    means = entries.groupBy((F.col("pos") - 1).alias("pos")).agg(F.avg(F.col("error") * F.col("entry")).alias("mean"))
    return means.select("pos", (F.col("mean") + F.element_at(F.array(*map(F.lit, [0.0, *penalty])), F.col("pos") + 2)).alias("gradient"))
