from datetime import date

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from newsalpha import session
from newsalpha.constants import RIDGE_GRID
from newsalpha.operators import evaluation, logistic, rolling
from newsalpha.plans.models import run_available_models


def blobs(spark, n, seed, gap=2.0):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % 2
    x = rng.normal(size=(n, 5)) + np.where(y == 1, gap, -gap)[:, None]
    rows = [(i, float(y[i]), x[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, label double, v array<double>")
    return df.select("id", "label", array_to_vector("v").alias("features")), x, y


def test_separable_blobs(spark):
    train, val, test = (blobs(spark, n, seed)[0] for n, seed in ((400, 0), (100, 1), (60, 2)))
    fitted = logistic.train_logistic(train, val, [0.01, 0.1, 1.0])
    assert fitted.best_c in (0.01, 0.1, 1.0) and fitted.val_accuracy > 0.9
    scored = fitted.predict_proba(test)
    assert scored.columns == ["id", "label", "features", "p_up"]
    accuracy = evaluation.classify_accuracy(scored).first().accuracy
    assert accuracy > 0.85


@pytest.mark.parametrize("c", [1e-4, 1e-2, 1.0])
def test_fit_minimizes_the_stated_objective(spark, c):
    """Gradient of C * sum(loss) + |w|^2 / 2 on population-scaled features is close to zero."""
    df, x, y = blobs(spark, 300, 3, gap=0.3)
    fitted = logistic.train_logistic(df, df, [c])
    scaled = (x - x.mean(0)) / x.std(0)
    w, b = fitted.model.coefficients.toArray(), fitted.model.intercept
    p = 1 / (1 + np.exp(-(scaled @ w + b)))
    gradient = np.r_[c * scaled.T @ (p - y) + w, c * (p - y).sum()]
    assert np.abs(gradient).max() < 1e-3 * max(1.0, c * len(y))


def test_gradients_tell_fits_from_other_weights(spark):
    """Equal to NumPy's at any weights, zero at those of a fit."""
    df, x, y = blobs(spark, 300, 3, gap=0.3)
    fitted = logistic.train_logistic(df, df, [0.01])
    rows = {r.pos: r.gradient for r in logistic.logistic_gradient(fitted, df).collect()}
    assert sorted(rows) == list(range(-1, x.shape[1])) and max(map(abs, rows.values())) < 1e-4
    fitted.best_c = 10.0
    scaled, w = (x - x.mean(0)) / x.std(0), fitted.model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(scaled @ w + fitted.model.intercept)))
    off = {r.pos: r.gradient for r in logistic.logistic_gradient(fitted, df).collect()}
    assert np.allclose([off[j] for j in range(x.shape[1])], scaled.T @ (p - y) / 300 + w / 3000) and off[0] != pytest.approx(rows[0], abs=1e-4)
    target = df.withColumn("ret", F.col("label") * 2 + F.col("features").cast("string").substr(2, 4).cast("double"))
    ridge = logistic.train_ridge(target, target, grid=[0.1])
    assert max(abs(r.gradient) for r in logistic.ridge_gradient(ridge, target).collect()) < 1e-9
    ridge.best_alpha = 1.0
    assert max(abs(r.gradient) for r in logistic.ridge_gradient(ridge, target).collect()) > 1e-3


def test_scaling_uses_population_moments_of_the_training_rows(spark):
    df, x, _ = blobs(spark, 50, 4)
    rows = logistic.standardize(df).transform(df).orderBy("id").select("scaled").collect()
    assert np.allclose([r.scaled.toArray() for r in rows], (x - x.mean(0)) / x.std(0))


@pytest.mark.parametrize("mean_loss", [True, False])
def test_ridge_matches_the_closed_form(spark, mean_loss):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 4))
    y = x @ [0.5, -1.0, 0.0, 2.0] + 0.3 + rng.normal(size=200)
    df = spark.createDataFrame([(float(t), r.tolist()) for t, r in zip(y, x)], "ret double, v array<double>")
    df = df.select("ret", array_to_vector("v").alias("features"))
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (1e-5, 1.0, 50.0):
        fitted = logistic.train_ridge(df, df, grid=[alpha], mean_loss=mean_loss)
        penalty = alpha * (len(y) if mean_loss else 1)
        expected = np.linalg.solve(xc.T @ xc + penalty * np.eye(4), xc.T @ yc)
        assert np.allclose(fitted.model.coefficients.toArray(), expected, atol=1e-9)
    best = logistic.train_ridge(df, df, mean_loss=mean_loss)
    assert best.best_alpha == min(RIDGE_GRID)
    assert "predicted_return" in best.predict(df).columns


def test_all_penalties_share_their_passes(spark, monkeypatch):
    """Exact fits in few passes over the rows, whatever the number of penalties; one label only gives a certain answer."""
    df, x, y = blobs(spark, 300, 8, gap=0.3)
    passes, summed = [], logistic.summed
    monkeypatch.setattr(logistic, "summed", lambda *args: passes.append(1) or summed(*args))
    fitted = logistic.train_logistic(df, df, [1e-4, 1e-2, 1.0])
    assert len(passes) < 40
    rows = [r.gradient for r in logistic.logistic_gradient(fitted, df).collect()]
    assert max(map(abs, rows)) < 1e-8
    passes.clear()
    logistic.train_ridge(df.withColumn("ret", F.col("label") + F.col("id")), df.withColumn("ret", F.col("label")))
    assert len(passes) == 3
    ones = logistic.train_logistic(df.where("label = 1"), df, [1.0])
    assert {r.p_up for r in ones.predict_proba(df).collect()} == {1.0} and ones.val_accuracy == 0.5


def yearly(spark, years, per_year=60, dims=4, seed=6):
    rng = np.random.default_rng(seed)
    rows, vectors, story = [], [], 0
    for year in years:
        for i in range(per_year):
            label = int(rng.integers(2))
            rows.append((story, date(year, 1 + i % 12, 1 + i % 28), label))
            vectors.append((story, (rng.normal(size=dims) + 2 * label).tolist()))
            story += 1
    labeled = spark.createDataFrame(rows, "rp_story_id bigint, article_date date, label int")
    return labeled, spark.createDataFrame(vectors, "rp_story_id bigint, embedding array<float>")


def test_windows_and_split_counts(spark):
    labeled, _ = yearly(spark, range(2000, 2007))
    windows = rolling.rolling_windows(labeled).where("split = 'train'").orderBy("oos_year").collect()
    assert [(w.oos_year, w.start_date, w.end_date) for w in windows][0] == (2004, date(2000, 1, 1), date(2002, 12, 31))
    counts = rolling.window_split_counts(labeled).orderBy("oos_year").collect()
    assert [tuple(c) for c in counts] == [(y, 180, 60, 60, True) for y in (2004, 2005, 2006)]
    wide = rolling.rolling_windows(labeled, 6, 2)
    assert wide.count() == 0


def test_too_few_rows_are_not_usable(spark):
    labeled, vectors = yearly(spark, range(2000, 2005), per_year=10)
    assert not rolling.window_split_counts(labeled).first().usable
    result = rolling.rolling_oos(labeled, vectors)
    assert result.metrics.count() == 0 and result.predictions.count() == 0


def test_rolling_run_scores_each_test_story_once(spark):
    labeled, vectors = yearly(spark, range(2000, 2006))
    twice = vectors.unionByName(vectors)
    result = rolling.rolling_oos(labeled, twice, "m", c_grid=(0.01, 1.0))
    metrics = {r.oos_year: r for r in result.metrics.collect()}
    assert set(metrics) == {2004, 2005}
    assert all(m.accuracy > 0.85 and m.n_train == 180 and m.n_test == 60 for m in metrics.values())
    rows = result.predictions.join(labeled, "rp_story_id").collect()
    assert len(rows) == 120 and all(r.oos_year == r.article_date.year for r in rows)
    hits = np.mean([(r.p_up >= 0.5) == (r.label == 1) for r in rows])
    assert hits == pytest.approx(np.mean([m.accuracy for m in metrics.values()]))


def test_duplicate_stories_count_once(spark):
    labeled, vectors = yearly(spark, range(2000, 2005))
    late = labeled.withColumns({"article_date": F.date_add("article_date", 1), "label": 1 - F.col("label")})
    plain, doubled = (rolling.rolling_oos(rows, vectors, c_grid=(1.0,)) for rows in (labeled, labeled.unionByName(late)))
    one, two = plain.metrics.first(), doubled.metrics.first()
    assert (one.n_train, one.n_val, one.n_test) == (two.n_train, two.n_val, two.n_test) == (180, 60, 60)
    assert one.accuracy == two.accuracy and doubled.predictions.count() == 60


def test_windows_need_rows_with_a_vector(spark):
    labeled, vectors = yearly(spark, range(2000, 2006))
    validation = labeled.where("year(article_date) = 2003").select("rp_story_id")
    result = rolling.rolling_oos(labeled, vectors.join(validation, "rp_story_id", "left_anti"), c_grid=(1.0,))
    assert [(r.oos_year, r.n_train) for r in result.metrics.collect()] == [(2005, 120)]


def test_resume_without_a_usable_window(spark, tmp_path):
    labeled, vectors = yearly(spark, range(2000, 2003))
    for _ in range(2):
        result = rolling.rolling_resume(labeled, vectors, str(tmp_path / "none"), "m")
        assert result.metrics.count() == 0 and result.predictions.count() == 0
        assert "model" in result.predictions.columns


def test_resume_adds_missing_years_and_keeps_stored_ones(spark, tmp_path):
    labeled, vectors = yearly(spark, range(2000, 2006))
    folder = str(tmp_path / "results")
    rolling.rolling_resume(labeled.where("article_date < '2005-01-01'"), vectors, folder, "m", c_grid=(1.0,))
    first = {r.rp_story_id: r.p_up for r in spark.read.parquet(f"{folder}/predictions").collect()}
    assert len(first) == 60
    result = rolling.rolling_resume(labeled, vectors, folder, "m", c_grid=(1.0,))
    rows = result.predictions.collect()
    assert len(rows) == 120 and result.metrics.count() == 2
    assert {r.rp_story_id: r.p_up for r in rows if r.oos_year == 2004} == first
    again = rolling.rolling_resume(labeled, vectors, folder, "m", c_grid=(1.0,))
    assert again.predictions.count() == 120 and again.metrics.count() == 2


@pytest.fixture
def kept(tmp_path, monkeypatch):
    """A shared folder of its own; gives what is left of staged vectors."""
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "shared"))
    return lambda: [str(p) for p in (tmp_path / "shared").rglob("*.parquet") if "features-" in str(p)]


def test_each_model_releases_its_vectors(spark, kept):
    """Models follow each other without the staged vectors of the earlier ones; rows are whole where the keys differ in kind."""
    labeled, vectors = yearly(spark, range(2000, 2005))
    other = vectors.withColumn("rp_story_id", F.col("rp_story_id").cast("int"))
    result = rolling.run_models(labeled, {"a": vectors, "b": other}, c_grid=(1.0,))
    assert not kept()
    assert sorted((r.model, r.n_train, r.n_test) for r in result.metrics.collect()) == [("a", 180, 60), ("b", 180, 60)]
    rows = {(r.model, r.rp_story_id): r.p_up for r in result.predictions.collect()}
    assert len(rows) == 120 and all(rows["a", i] == pytest.approx(rows["b", i], abs=1e-9) for m, i in rows if m == "a")


def test_resumed_runs_release_their_vectors(spark, kept, tmp_path):
    labeled, vectors = yearly(spark, range(2000, 2006))
    for rows in (labeled.where("article_date < '2005-01-01'"), labeled):
        result = rolling.rolling_resume(rows, vectors, str(tmp_path / "results"), "m", c_grid=(1.0,))
        assert not kept()
    assert sorted((r.oos_year, r.n_train) for r in result.metrics.collect()) == [(2004, 180), (2005, 180)] and result.predictions.count() == 120


def test_training_rows_are_kept_as_they_are(spark):
    """Single precision where it says the same, double precision elsewhere; no row is lost at a cut."""
    for x, narrow in ((0.5, True), (0.1, False)):
        rows = spark.range(0, 5000, 1, 1).select(F.col("id").cast("double").alias("label"), F.array(F.lit(x), F.col("id") * 1.0).alias("x"))
        found = logistic.packed(rows).collect()
        assert [r.n for r in found] and sum(r.n for r in found) == 5000 and {r.narrow for r in found} == {narrow}
        kind = np.float32 if narrow else np.float64
        back = np.concatenate([np.frombuffer(r.x, kind).reshape(r.n, 2) for r in found]).astype(float)
        assert (back[:, 0] == x).all() and sorted(back[:, 1]) == list(range(5000)) and sorted(np.concatenate([np.frombuffer(r.y) for r in found])) == list(range(5000))


def test_a_run_that_was_stopped_is_repeated(spark, tmp_path, monkeypatch):
    """Stopped between its two writes, and with a partition of which only a part was written."""
    labeled, vectors = yearly(spark, range(2000, 2006))
    whole = rolling.rolling_resume(labeled, vectors, str(tmp_path / "whole"), "m", c_grid=(1.0,))
    folder, write = str(tmp_path / "stopped"), rolling.replace_partitions

    def stopping(df, path, keys):
        if path.endswith("metrics"):
            raise KeyboardInterrupt
        write(df.where("oos_year = 2004 or rp_story_id % 2 = 0"), path, keys)

    monkeypatch.setattr(rolling, "replace_partitions", stopping)
    with pytest.raises(KeyboardInterrupt):
        rolling.rolling_resume(labeled, vectors, folder, "m", c_grid=(1.0,))
    monkeypatch.setattr(rolling, "replace_partitions", write)
    again = rolling.rolling_resume(labeled, vectors, folder, "m", c_grid=(1.0,))
    for one, other in ((whole.predictions, again.predictions), (whole.metrics, again.metrics)):
        rows = [sorted([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect()) for df in (one, other)]
        assert rows[0] == rows[1] and len(rows[0]) > 1


def test_only_models_with_vectors_run(spark, tmp_path):
    labeled, vectors = yearly(spark, range(2000, 2005))
    vectors.write.parquet(str(tmp_path / "embeddings_one"))
    result = run_available_models(labeled, str(tmp_path), str(tmp_path / "out"), ["one", "two"], c_grid=(1.0,))
    assert [r.model for r in result.metrics.collect()] == ["one"]


def test_caps_sample_repeatably(spark):
    labeled, vectors = yearly(spark, range(2000, 2005))
    runs = [rolling.rolling_oos(labeled, vectors, c_grid=(1.0,), caps={"train": 120, "test": 20}) for _ in range(2)]
    first, second = ({r.rp_story_id: r.p_up for r in run.predictions.collect()} for run in runs)
    assert len(first) == 20 and set(first) == set(second)
    assert runs[0].metrics.first().n_train == 120


def test_accuracy_counts_a_half_as_positive(frame):
    df = frame([(0.5, 1), (0.5, 0), (0.4, 0), (0.6, 1)], "p_up double, label int")
    row = evaluation.classify_accuracy(df).first()
    assert (row.tp, row.tn, row.fp, row.fn, row.accuracy) == (2, 1, 1, 0, 0.75)


def test_forecast_correlation_of_a_constant_is_null(frame):
    df = frame([(1.0, 0.1), (1.0, 0.2), (None, 0.3)], "score double, ret double")
    row = evaluation.oos_forecast_correlation(df).first()
    assert row.n == 2 and row.oos_correlation is None


def test_mean_of_years_not_of_rows(frame):
    from newsalpha.operators.reshape import accuracy_pivot

    df = frame([("a", 2000, 0.5), ("a", 2001, 1.0), ("b", 2001, 0.25)], "model string, oos_year int, accuracy double")
    rows = {r.year: (r.a, r.b) for r in accuracy_pivot(df, ["a", "b"]).collect()}
    assert rows == {"2000": (50.0, None), "2001": (100.0, 25.0), "Average": (75.0, 25.0)}


def test_predictions_do_not_depend_on_test_labels(spark):
    labeled, vectors = yearly(spark, range(2000, 2005))
    flipped = labeled.withColumn("label", F.when(F.year("article_date") == 2004, 1 - F.col("label")).otherwise(F.col("label")))
    a, b = ({r.rp_story_id: r.p_up for r in rolling.rolling_oos(df, vectors, c_grid=(1.0,)).predictions.collect()} for df in (labeled, flipped))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)
