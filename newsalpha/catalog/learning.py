"""Queries over vectors, models and portfolios."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from newsalpha.catalog.base import DAILY, PANEL, SECTORED, Tables, query, rounded
from newsalpha.catalog.joins import built_panel, daily, sectored
from newsalpha.catalog.summaries import PREDICTED, predicted
from newsalpha.operators import decomposition, embedding, evaluation, labels, logistic, panel, portfolio, rolling, sectors, similarity
from newsalpha.operators.sampling import sample_n
from newsalpha.session import new_folder, stage

PANEL_SIZE = 30


def panel_of(t: Tables, n: int = PANEL_SIZE):
    return sample_n(t("embeddings"), n, ["vec_id"])


def dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def drawn(n):
    return f"""drawn AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM {{embeddings}}
  ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT {n}),
vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM {{embeddings}})"""


@query(f"""WITH {drawn(PANEL_SIZE)}
SELECT a.vec_id, b.vec_id AS panel_id, round(list_cosine_similarity(a.v, b.v), 3) AS cosine FROM vectors a CROSS JOIN drawn b""")
def pairwise_cosine(t):
    return similarity.pairwise_cosine(t("embeddings"), panel_of(t), "vec_id")


@query(f"""WITH {drawn(5)}
SELECT vec_id, panel_id, cosine, CAST(r AS INT) AS rank FROM (
  SELECT a.vec_id, b.vec_id AS panel_id, round(list_cosine_similarity(a.v, b.v), 6) AS cosine,
    row_number() OVER (PARTITION BY b.vec_id ORDER BY list_cosine_similarity(a.v, b.v) DESC, a.vec_id) AS r
  FROM vectors a CROSS JOIN drawn b WHERE a.vec_id NOT IN (SELECT vec_id FROM drawn)) x
WHERE r <= 5""")
def top_n_nearest(t):
    return rounded(similarity.top_n_nearest(t("embeddings"), panel_of(t, 5), "vec_id"))


@query(f"""WITH {drawn(PANEL_SIZE)},
pairs AS (
  SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(a.v, b.v), 9) AS cosine
  FROM drawn a JOIN drawn b ON a.vec_id < b.vec_id)
SELECT id_a, id_b, round(cosine, 6) AS cosine, 'most' AS which FROM (SELECT * FROM pairs ORDER BY cosine DESC, id_a, id_b LIMIT 1) x
UNION ALL
SELECT id_a, id_b, round(cosine, 6), 'least' FROM (SELECT * FROM pairs ORDER BY cosine, id_a, id_b LIMIT 1) y""")
def extreme_pairs_within(t):
    """The extremes among the sampled rows themselves."""
    sample = panel_of(t)
    return rounded(similarity.extreme_pairs(sample, sample, "vec_id"))


@query(f"""WITH {drawn(PANEL_SIZE)},
pairs AS (
  SELECT DISTINCT least(a.vec_id, b.vec_id) AS id_a, greatest(a.vec_id, b.vec_id) AS id_b,
    round(list_cosine_similarity(a.v, b.v), 9) AS cosine
  FROM vectors a JOIN drawn b ON a.vec_id <> b.vec_id)
SELECT id_a, id_b, round(cosine, 6) AS cosine, 'most' AS which FROM (SELECT * FROM pairs ORDER BY cosine DESC, id_a, id_b LIMIT 1) x
UNION ALL
SELECT id_a, id_b, round(cosine, 6), 'least' FROM (SELECT * FROM pairs ORDER BY cosine, id_a, id_b LIMIT 1) y""")
def extreme_pairs(t):
    return rounded(similarity.extreme_pairs(t("embeddings"), panel_of(t), "vec_id"))


@query("""
WITH vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM {embeddings}),
target AS (
  SELECT list_transform(list_zip(a.v, b.v, c.v), lambda z: z[1] - z[2] + z[3]) AS v
  FROM vectors a, vectors b, vectors c WHERE a.vec_id = 0 AND b.vec_id = 1 AND c.vec_id = 2)
SELECT vec_id, cosine, CAST(r AS INT) AS rank FROM (
  SELECT x.vec_id, round(list_cosine_similarity(x.v, target.v), 6) AS cosine,
    row_number() OVER (ORDER BY list_cosine_similarity(x.v, target.v) DESC, x.vec_id) AS r
  FROM vectors x, target WHERE x.vec_id NOT IN (0, 1, 2)) y
WHERE r <= 5""")
def vector_analogy(t):
    return rounded(similarity.vector_analogy(t("embeddings"), 0, 1, 2, "vec_id"))


@query("""
WITH entries AS (
  SELECT text_id, attention_mask AS m, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS e FROM fx_tokens)
SELECT text_id, CAST(pos AS INT) AS pos, round(sum(e * m) / greatest(sum(m), 1e-9), 6) AS value FROM entries GROUP BY text_id, pos""")
def mean_pool(t):
    pooled = embedding.mean_pool(t("fx_tokens"), "text_id")
    return rounded(pooled.select("text_id", F.posexplode("embedding").alias("pos", "value")))


HASHED = """hashed AS (
  SELECT id, chunk, CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % 768 AS pos,
    CASE WHEN CAST(('0x' || substr(md5(word), 9, 1)) AS BIGINT) % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign
  FROM words),
summed AS (SELECT id, chunk, pos, sum(sign) AS s FROM hashed GROUP BY id, chunk, pos),
lengths AS (SELECT id, chunk, sqrt(sum(s * s)) AS len FROM summed GROUP BY id, chunk)"""


@query(f"""WITH stories AS (SELECT rp_story_id AS id, coalesce(min(headline), '') AS text FROM fx_headlines GROUP BY 1),
words AS (
  SELECT id, 0 AS chunk, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS word FROM stories),
{HASHED}
SELECT s.id AS rp_story_id, CAST(s.pos AS INT) AS pos, round(s.s / l.len, 5) AS value
FROM summed s JOIN lengths l ON l.id = s.id AND l.chunk = s.chunk WHERE s.s <> 0""")
def embed_headlines(t):
    """Non-zero entries of the default embedder's vectors."""
    vectors = embedding.embed_headlines(t("fx_headlines"), embedding.hashing_embedder())
    entries = vectors.select("rp_story_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "value"))
    return entries.where(F.col("value") != 0).withColumn("value", F.round("value", 5))


@query("""
WITH split AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(text, '[\\s\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'),
    lambda x: x <> '') AS w FROM {documents}),
words AS (
  SELECT id, (i - 1) // 64 AS chunk, lower(word) AS word FROM
    (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split) x),
""" + HASHED + """,
chunks AS (SELECT id, count(DISTINCT chunk) AS n FROM words GROUP BY id),
scaled AS (
  SELECT s.id, s.pos, sum(CASE WHEN l.len = 0 THEN 0 ELSE s.s / l.len END) AS total
  FROM summed s JOIN lengths l ON l.id = s.id AND l.chunk = s.chunk GROUP BY s.id, s.pos)
SELECT s.id AS doc_id, round(sum(abs(total / n)), 3) AS l1_norm, round(sum(total / n), 3) AS entry_sum
FROM scaled s JOIN chunks c ON c.id = s.id GROUP BY s.id""")
def chunk_embed_average(t):
    """Two checksums of each document's mean chunk vector, whole texts."""
    vectors = embedding.chunk_embed_average(t("documents"), "doc_id", "text", embedding.hashing_embedder())

    def total(entry):
        return F.round(F.aggregate(F.transform("embedding", entry), F.lit(0.0), lambda a, x: a + x), 3)

    return vectors.select("doc_id", total(F.abs).alias("l1_norm"), total(lambda x: x).alias("entry_sum"))


@query("""
WITH entries AS (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS e FROM {embeddings}),
centred AS (SELECT vec_id, e - avg(e) OVER (PARTITION BY pos) AS e FROM entries)
SELECT vec_id, round(sum(e * e), 5) AS squared_distance, 1.0::DOUBLE AS all_shares FROM centred GROUP BY vec_id""")
def pca_project(t):
    """All components: they keep the distance of each row from the mean, and their shares add up to one."""
    dims = t("embeddings").select(F.max(F.size("embedding"))).first()[0]
    projected, share = decomposition.pca_project(t("embeddings"), "vec_id", k=dims)
    squares = F.aggregate("components", F.lit(0.0), lambda total, x: total + x * x)
    return projected.select("vec_id", F.round(squares, 5).alias("squared_distance"), F.lit(round(sum(share), 6)).alias("all_shares"))


TFIDF = """counted AS (
  SELECT doc_id, word, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]{{2,}}')) AS word FROM {documents}) x
  GROUP BY doc_id, word),
frequency AS (SELECT word, count(*) AS df FROM counted GROUP BY word),
weighted AS (
  SELECT doc_id, c.word, n * (ln((1 + (SELECT count(*) FROM {documents})) / (1.0 + df)) + 1) AS w
  FROM counted c JOIN frequency f ON f.word = c.word)"""


@query(f"""WITH {TFIDF.replace("{{", "{").replace("}}", "}")}
SELECT doc_id, count(*) AS n_words, round(sum(w / len), 5) AS total, round(max(w / len), 5) AS largest, max(word) AS last_word FROM (
  SELECT doc_id, word, w, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS len FROM weighted) x GROUP BY doc_id""")
def tfidf_weights(t):
    """Number, sum and largest of each document's weights, and its last word."""
    docs = t("documents")
    entries = decomposition.fit_tfidf(docs, "text").entries(docs, "doc_id", "text")
    return entries.groupBy("doc_id").agg(
        F.count("*").alias("n_words"), F.round(F.sum("weight"), 5).alias("total"), F.round(F.max("weight"), 5).alias("largest"),
        F.max("word").alias("last_word"),
    )


@query("SELECT doc_id, CAST(64 AS INT) AS dims, 0.0::DOUBLE AS gap FROM {documents}")
def tfidf_svd(t):
    """Whole fit and projection of every document.

    What the directions return for a document's own weights is its embedding's squared length, if the embedding is their
    product; the gap between the two is zero.
    """
    docs = t("documents")
    model = decomposition.fit_tfidf_svd(docs, "text")
    vectors = stage(model.transform(docs, "doc_id", "text"), "embeddings")
    own = decomposition.gathered(model.weights.numbered(docs, "doc_id", "text"), model.directions, "direction", "doc_id", len(model.singular_values), "own")
    across = own.join(vectors, "doc_id").groupBy("doc_id").agg(F.sum(dot("own", "embedding")).alias("across"))
    gap = F.round(F.abs(F.coalesce("across", F.lit(0.0)) - dot("embedding", "embedding")), 6)
    return vectors.join(across, "doc_id", "left").select("doc_id", F.size("embedding").alias("dims"), gap.alias("gap"))


@query(f"""WITH {TFIDF.replace("{{", "{").replace("}}", "}")}
SELECT CAST(j AS INT) AS direction, 0.0::DOUBLE AS residual, 0.0::DOUBLE AS skew, (SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) FROM weighted) AS trace
FROM unnest(range(64)) u(j)""")
def tfidf_svd_directions(t):
    """A'A v = s^2 v and orthogonality of the 64 directions, and the sum of all squared weights."""
    docs = t("documents")
    model = decomposition.fit_tfidf_svd(docs, "text")
    errors = decomposition.direction_errors(model, docs, "doc_id", "text")
    trace = model.weights.numbered(docs, "doc_id", "text").agg(F.round(F.sum(F.col("weight") * F.col("weight")), 4).alias("trace"))
    return errors.select("direction", F.round("residual", 5).alias("residual"), F.round("skew", 6).alias("skew")).crossJoin(trace)


@query("""
WITH per_year AS (SELECT year(article_date) AS y, count(*) AS n FROM fx_labeled GROUP BY 1),
span AS (SELECT min(y) AS a, max(y) AS b FROM per_year),
oos AS (SELECT CAST(unnest(generate_series(a + 4, b)) AS INT) AS oos_year FROM span)
SELECT oos_year, 'train' AS split, make_date(oos_year - 4, 1, 1) AS start_date, make_date(oos_year - 2, 12, 31) AS end_date FROM oos
UNION ALL SELECT oos_year, 'val', make_date(oos_year - 1, 1, 1), make_date(oos_year - 1, 12, 31) FROM oos
UNION ALL SELECT oos_year, 'test', make_date(oos_year, 1, 1), make_date(oos_year, 12, 31) FROM oos""")
def rolling_windows(t):
    return rolling.rolling_windows(t("fx_labeled"))


SPLITS = """span AS (SELECT min(year(article_date)) AS a, max(year(article_date)) AS b FROM fx_labeled),
oos AS (SELECT CAST(unnest(generate_series(a + 4, b)) AS INT) AS oos_year FROM span),
counts AS (
  SELECT oos_year,
    count(*) FILTER (WHERE year(article_date) BETWEEN oos_year - 4 AND oos_year - 2) AS n_train,
    count(*) FILTER (WHERE year(article_date) = oos_year - 1) AS n_val,
    count(*) FILTER (WHERE year(article_date) = oos_year) AS n_test
  FROM oos CROSS JOIN fx_labeled GROUP BY oos_year)"""


@query(f"""WITH {SPLITS}
SELECT oos_year, n_train, n_val, n_test, n_train >= 100 AND n_val >= 10 AND n_test >= 10 AS usable FROM counts""")
def window_split_counts(t):
    return rolling.window_split_counts(t("fx_labeled"))


# Logistic regressions of one standardized feature by Newton's method: rows of ``training`` (run, x, y), one fit per run and C.
NEWTON = """moments AS (SELECT run, avg(x) AS m, stddev_pop(x) AS s FROM training GROUP BY run),
scaled AS (SELECT t.run, (x - m) / s AS x, y FROM training t JOIN moments o ON o.run = t.run),
steps AS (
  SELECT DISTINCT run, c, 0 AS step, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b FROM scaled, (VALUES (1e-4), (1e-3), (1e-2), (1e-1), (1.0)) g(c)
  UNION ALL
  SELECT run, c, step + 1, w - (hbb * gw - hwb * gb) / (hww * hbb - hwb * hwb), b - (hww * gb - hwb * gw) / (hww * hbb - hwb * hwb)
  FROM (
    SELECT run, c, step, w, b, c * sum((p - y) * x) + w AS gw, c * sum(p - y) AS gb,
      c * sum(p * (1 - p) * x * x) + 1 AS hww, c * sum(p * (1 - p) * x) AS hwb, c * sum(p * (1 - p)) AS hbb
    FROM (SELECT s.run, c, step, w, b, x, y, 1 / (1 + exp(-(w * x + b))) AS p FROM steps s JOIN scaled d ON d.run = s.run WHERE step < 12) u
    GROUP BY run, c, step, w, b) v),
fits AS (SELECT * FROM steps WHERE step = 12),
rated AS (
  SELECT f.run, f.c, f.w, f.b, o.m, o.s, avg(CASE WHEN (1 / (1 + exp(-(f.w * (v.x - o.m) / o.s + f.b))) > 0.5) = (v.y = 1) THEN 1 ELSE 0 END) AS hits,
    count(*) AS n_val
  FROM fits f JOIN moments o ON o.run = f.run JOIN validation v ON v.run = f.run GROUP BY ALL),
chosen AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY run ORDER BY hits DESC, c) = 1)"""

# The first entry of the story's vector, in the windows of the rolling run and in the split of the single fits.
FEATURE = """feature AS (
  SELECT l.rp_story_id, l.permno, l.article_date, l.market_cap, year(l.article_date) AS y4, l.label AS y, e.embedding[1]::DOUBLE AS x
  FROM fx_labeled l JOIN {embeddings} e ON e.vec_id = l.vec_id)"""

ROLLED = f"""RECURSIVE {FEATURE}, {SPLITS},
usable AS (SELECT oos_year AS run FROM counts WHERE n_train >= 100 AND n_val >= 10 AND n_test >= 10),
training AS (SELECT run, x, y FROM usable JOIN feature ON y4 BETWEEN run - 4 AND run - 2),
validation AS (SELECT run, x, y FROM usable JOIN feature ON y4 = run - 1),
{NEWTON},
rolled AS (
  SELECT f.rp_story_id, f.permno, f.article_date, f.market_cap, c.run AS oos_year, 1 / (1 + exp(-(c.w * (f.x - c.m) / c.s + c.b))) AS p_up
  FROM chosen c JOIN feature f ON f.y4 = c.run)"""

FITTED = f"""RECURSIVE {FEATURE}, last AS (SELECT max(y4) AS z FROM feature),
training AS (SELECT 1 AS run, x, y FROM feature, last WHERE y4 < z - 1),
validation AS (SELECT 1 AS run, x, y FROM feature, last WHERE y4 = z - 1),
{NEWTON}"""


def first_entries(t):
    return story_vectors(t).withColumn("embedding", F.slice("embedding", 1, 1))


@query(f"WITH {ROLLED} SELECT rp_story_id, CAST(oos_year AS INT) AS oos_year, round(p_up, 3) AS p_up FROM rolled")
def rolling_oos_one_feature(t):
    """The rolling run with vectors of one entry, for which the fits can be repeated in SQL."""
    found = rolling.rolling_oos(t("fx_labeled"), first_entries(t)).predictions
    return found.select("rp_story_id", "oos_year", F.round("p_up", 3).alias("p_up"))


@query(f"""WITH {FITTED}
SELECT c AS best_c, round(hits, 6) AS val_accuracy, (SELECT count(*) FROM training) AS n_train, n_val, round(b, 3) AS intercept, round(w, 3) AS weight FROM chosen""")
def train_logistic_one_feature(t):
    model, _ = fitted(t, first_entry=True)
    return t.spark.createDataFrame(
        [(model.best_c, round(model.val_accuracy, 6), model.n_train, model.n_val, round(model.model.intercept, 3), round(float(model.model.coefficients[0]), 3))],
        "best_c double, val_accuracy double, n_train bigint, n_val bigint, intercept double, weight double",
    )


@query(f"""WITH {FITTED}
SELECT rp_story_id, CAST(y AS DOUBLE) AS label, round(1 / (1 + exp(-(w * (x - m) / s + b))), 3) AS p_up FROM chosen, feature, last WHERE y4 = z""")
def predict_proba_one_feature(t):
    model, test = fitted(t, first_entry=True)
    return model.predict_proba(test).select("rp_story_id", "label", F.round("p_up", 3).alias("p_up"))


@query(f"""WITH {FEATURE}, last AS (SELECT max(y4) AS z FROM feature),
rows_ AS (SELECT rp_story_id, x, ln(market_cap) AS y, y4, z FROM feature, last),
sums AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS xy, var_pop(x) AS xx FROM rows_ WHERE y4 < z - 1),
lines AS (
  SELECT alpha, xy / (xx + alpha) AS w, my - xy / (xx + alpha) * mx AS b
  FROM sums, (VALUES (1e-5), (1e-4), (1e-3), (1e-2), (1e-1), (1.0), (10.0), (50.0), (100.0)) g(alpha)),
errors AS (SELECT alpha, w, b, avg(pow(y - w * x - b, 2)) AS mse FROM lines, rows_ WHERE y4 = z - 1 GROUP BY ALL),
best AS (SELECT * FROM errors ORDER BY mse, alpha LIMIT 1)
SELECT rp_story_id, round(w * x + b, 5) AS predicted_return, CAST(alpha AS DOUBLE) AS best_alpha, round(mse, 5) AS val_mse FROM best, rows_ WHERE y4 = z""")
def train_ridge_one_feature(t):
    """On one entry of the vector ridge regression has a closed form."""
    return rounded(ridge(t, first_entry=True), 5)


@query(f"""WITH {ROLLED},
sectors_of AS (SELECT permno, min(gsector) AS gsector FROM fx_spells GROUP BY permno)
SELECT gsector, article_date AS date, round(sum((p_up - 0.5) * market_cap) / sum(market_cap), 3) AS sentiment, count(*) AS n_headlines
FROM rolled JOIN sectors_of s ON s.permno = rolled.permno WHERE gsector IS NOT NULL AND market_cap > 0 GROUP BY gsector, article_date""")
def vectors_to_sector_scores(t):
    """The chain from vectors through the rolling run to the scores of the sector panel."""
    labeled = t("fx_labeled")
    predictions = rolling.rolling_oos(labeled, first_entries(t)).predictions
    spells = t("fx_spells").groupBy("permno").agg(F.min("gsector").alias("gsector")).select(
        "permno", "gsector", F.lit("1990-01-01").cast("date").alias("effstartdt"), F.lit("2030-01-01").cast("date").alias("effenddt")
    )
    scored = panel.join_predictions(sectors.merge_sector(labeled, spells), predictions)
    return rounded(panel.aggregate_sentiment(scored).select("gsector", "date", "sentiment", "n_headlines"), 3)


def examples(t):
    """Vectors with a label, as model input."""
    return t("embeddings").select(
        "vec_id", (F.col("label") >= 5).cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )


@query("""
WITH entries AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS e FROM {embeddings}),
moments AS (SELECT pos, avg(e) AS m, stddev_pop(e) AS s FROM entries GROUP BY pos)
SELECT vec_id, CAST(e.pos AS INT) AS pos, round((e - m) / s, 6) AS value FROM entries e JOIN moments o ON o.pos = e.pos""")
def standardize(t):
    rows = examples(t)
    scaled = logistic.standardize(rows).transform(rows)
    return rounded(scaled.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("pos", "value")))


def features_by_year(t, first_entry: bool = False):
    labeled = t("fx_labeled")
    entries = F.col("embedding").cast("array<double>")
    vectors = t("embeddings").select("vec_id", array_to_vector(F.slice(entries, 1, 1) if first_entry else entries).alias("features"))
    return labeled.join(vectors, "vec_id").select(
        "rp_story_id", "permno", "article_date", "market_cap", F.col("label").cast("double").alias("label"), "features"
    )


def last_years(rows):
    """Training rows, those of the last but one year, and those of the last."""
    year = F.year("article_date")
    last = rows.agg(F.max(year)).first()[0]
    return rows.where(year < last - 1), rows.where(year == last - 1), rows.where(year == last)


def fitted(t, first_entry: bool = False):
    train, validation, test = last_years(features_by_year(t, first_entry))
    return logistic.train_logistic(train, validation), test


@query()
def train_logistic(t):
    model, _ = fitted(t)
    weights = model.model.coefficients.toArray().tolist()
    return t.spark.createDataFrame(
        [(model.best_c, model.val_accuracy, model.n_train, model.n_val, model.model.intercept, weights)],
        "best_c double, val_accuracy double, n_train bigint, n_val bigint, intercept double, weights array<double>",
    )


@query()
def predict_proba(t):
    model, test = fitted(t)
    return model.predict_proba(test).select("rp_story_id", "label", "p_up")


@query()
def train_ridge(t):
    """Ridge of the market value's logarithm, standing in for a return, on the story's vector."""
    return ridge(t)


# Of an exact fit the gradient is zero at every place of the vectors and for the intercept, at -1.
NO_GRADIENT = """SELECT CAST(pos - 1 AS INT) AS pos, 0.0::DOUBLE AS gradient
FROM unnest(range((SELECT max(len(embedding)) + 1 FROM {embeddings}))) u(pos)"""


@query(NO_GRADIENT)
def train_logistic_gradient(t):
    """The gradient of the objective at the weights that ``train_logistic`` finds on whole vectors."""
    train, validation, _ = last_years(features_by_year(t))
    model = logistic.train_logistic(train, validation)
    return logistic.logistic_gradient(model, train).select("pos", F.abs(F.round("gradient", 4)).alias("gradient"))


@query(NO_GRADIENT)
def train_ridge_gradient(t):
    """The same for ``train_ridge``."""
    train, validation, _ = last_years(features_by_year(t).withColumn("ret", F.log("market_cap")))
    model = logistic.train_ridge(train, validation)
    return logistic.ridge_gradient(model, train).select("pos", F.abs(F.round("gradient", 6)).alias("gradient"))


def ridge(t, first_entry: bool = False):
    train, validation, test = last_years(features_by_year(t, first_entry).withColumn("ret", F.log("market_cap")))
    model = logistic.train_ridge(train, validation)
    scored = model.predict(test)
    return scored.select(
        "rp_story_id", "predicted_return", F.lit(model.best_alpha).alias("best_alpha"), F.lit(model.val_mse).alias("val_mse")
    )


@query(f"""WITH {PREDICTED}
SELECT model, count(*) FILTER (WHERE p_up >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE p_up < 0.5 AND label = 0) AS tn,
  count(*) FILTER (WHERE p_up >= 0.5 AND label = 0) AS fp, count(*) FILTER (WHERE p_up < 0.5 AND label = 1) AS fn,
  round(avg(CASE WHEN (p_up >= 0.5) = (label = 1) THEN 1 ELSE 0 END), 6) AS accuracy
FROM predicted GROUP BY model""")
def classify_accuracy(t):
    return rounded(evaluation.classify_accuracy(predicted(t), "model"))


def story_vectors(t):
    """One vector per story of ``fx_labeled``, as an embedding run would leave it."""
    return t("fx_labeled").select("rp_story_id", "vec_id").join(t("embeddings"), "vec_id").select("rp_story_id", "embedding")


@query()
def rolling_oos(t):
    """Per-headline probabilities of every out-of-sample year."""
    return rolling.rolling_oos(t("fx_labeled"), story_vectors(t)).predictions


def coverage(result, *keys):
    """Sizes of the splits and the number of stored predictions per year."""
    predictions = result.predictions.groupBy("model", "oos_year").agg(F.count("*").alias("n_predictions"))
    sizes = result.metrics.select("model", "oos_year", "n_train", "n_val", "n_test")
    return sizes.join(predictions, ["model", "oos_year"]).select(
        *keys, "oos_year", "n_train", "n_val", "n_test", "n_predictions"
    )


@query(f"""WITH {SPLITS}
SELECT oos_year, n_train, n_val, n_test, n_test AS n_predictions FROM counts WHERE n_train >= 100 AND n_val >= 10 AND n_test >= 10""")
def rolling_resume(t):
    """A run that stops before the last year, then one that only adds what is missing."""
    folder = new_folder(t.spark, "rolling")
    labeled, vectors = t("fx_labeled"), story_vectors(t)
    last = labeled.agg(F.max("article_date")).first()[0]
    rolling.rolling_resume(labeled.where(F.col("article_date") < f"{last.year}-01-01"), vectors, folder)
    return coverage(rolling.rolling_resume(labeled, vectors, folder))


@query(f"""WITH {SPLITS}
SELECT model, oos_year, n_train, n_val, n_test, n_test AS n_predictions
FROM counts CROSS JOIN (VALUES ('negated'), ('plain')) m(model) WHERE n_train >= 100 AND n_val >= 10 AND n_test >= 10""")
def run_models(t):
    plain = story_vectors(t)
    negated = plain.withColumn("embedding", F.transform("embedding", lambda x: -x))
    result = rolling.run_models(t("fx_labeled"), {"plain": plain, "negated": negated})
    return coverage(result, "model")


@query(f"WITH {ROLLED} SELECT rp_story_id, CAST(oos_year AS INT) AS oos_year, round(p_up, 3) AS p_up FROM rolled")
def rolling_resume_one_feature(t):
    """The values of a resumed run: those of a run in one go, which SQL can repeat on vectors of one entry."""
    folder = new_folder(t.spark, "rolling")
    labeled, vectors = t("fx_labeled"), first_entries(t)
    last = labeled.agg(F.max("article_date")).first()[0]
    rolling.rolling_resume(labeled.where(F.col("article_date") < f"{last.year}-01-01"), vectors, folder)
    found = rolling.rolling_resume(labeled, vectors, folder).predictions
    return found.select("rp_story_id", "oos_year", F.round("p_up", 3).alias("p_up"))


@query(f"""WITH {ROLLED}
SELECT model, rp_story_id, CAST(oos_year AS INT) AS oos_year, round(p_up, 3) AS p_up FROM rolled CROSS JOIN (VALUES ('negated'), ('plain')) m(model)""")
def run_models_one_feature(t):
    """Two models of one entry; with the sign of a scaled entry its weight turns, so both give the same values."""
    plain = first_entries(t)
    negated = plain.withColumn("embedding", F.transform("embedding", lambda x: -x))
    found = rolling.run_models(t("fx_labeled"), {"plain": plain, "negated": negated}).predictions
    return found.select("model", "rp_story_id", "oos_year", F.round("p_up", 3).alias("p_up"))


def forward_sql(k):
    return " * ".join(f"(1 + lead(ret, {i}) OVER w)" for i in range(1, k + 1)) + " - 1"


@query(f"""SELECT permno, date, {", ".join(f"round({forward_sql(k)}, 9) AS fwd_{k}" for k in (1, 3, 5, 10))}
FROM fx_daily WINDOW w AS (PARTITION BY permno ORDER BY date)""")
def forward_returns(t):
    return rounded(labels.forward_returns(t("fx_daily")), 9)


LAGGED_CAPS = """caps AS (
  SELECT permno, date, lag(market_cap) OVER (PARTITION BY permno ORDER BY date) AS cap FROM daily),
day_sectors AS (
  SELECT c.permno, c.date, c.cap, f.gsector FROM caps c JOIN fx_spells f ON f.permno = c.permno AND c.date BETWEEN f.effstartdt AND f.effenddt
  WHERE c.cap > 0 AND f.gsector IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY c.permno, c.date ORDER BY f.effstartdt DESC, f.gsector) = 1)"""


@query(f"""WITH {SECTORED}, {LAGGED_CAPS},
issuer_days AS (
  SELECT s.permno, s.article_date AS date, avg(p.p_up) AS p_up FROM sectored s JOIN fx_predictions p ON p.rp_story_id = s.rp_story_id GROUP BY 1, 2)
SELECT c.gsector, c.date, round(sum(p_up * cap) / sum(cap), 6) AS score, count(*) AS n_issuers
FROM issuer_days i JOIN day_sectors c ON c.permno = i.permno AND c.date = i.date GROUP BY c.gsector, c.date""")
def sector_score_lagged(t):
    predictions = sectored(t).select("rp_story_id", "permno", "article_date").join(
        t("fx_predictions").select("rp_story_id", "p_up"), "rp_story_id"
    )
    return rounded(portfolio.sector_score_lagged(predictions, daily(t), t("fx_spells")))


@query(f"""WITH {DAILY}, {LAGGED_CAPS}
SELECT c.gsector, c.date, round(sum(f.score * cap) / sum(cap), 6) AS predicted_return, count(*) AS n_issuers
FROM fx_forecasts f JOIN day_sectors c ON c.permno = f.permno AND c.date = f.date WHERE f.score IS NOT NULL GROUP BY c.gsector, c.date""")
def sector_predicted_return(t):
    return rounded(portfolio.sector_predicted_return(t("fx_forecasts"), daily(t), t("fx_spells")))


LEGS = """legs AS (
  SELECT date, avg(CASE WHEN b = 5 THEN ret END) AS long_ret, avg(CASE WHEN b = 1 THEN ret END) AS short_ret, count(*) AS n
  FROM (SELECT date, ret, ntile(5) OVER (PARTITION BY date ORDER BY score, permno) AS b FROM fx_forecasts
        WHERE score IS NOT NULL AND ret IS NOT NULL) x GROUP BY date)"""


@query(f"""WITH {LEGS} SELECT date, round(long_ret, 9) AS long_ret, round(short_ret, 9) AS short_ret, n,
  round(long_ret - short_ret, 9) AS spread FROM legs""")
def quintile_portfolio(t):
    return rounded(portfolio.quintile_portfolio(t("fx_forecasts")), 9)


@query(f"""WITH {LEGS}, s AS (SELECT long_ret - short_ret AS spread FROM legs)
SELECT count(spread) AS n_days, round(avg(spread), 9) AS mean_daily, round(stddev_samp(spread), 9) AS sd_daily,
  round(avg(spread) / stddev_samp(spread) * sqrt(252), 6) AS sharpe FROM s""")
def sharpe_ratio(t):
    ratio = portfolio.sharpe_ratio(portfolio.quintile_portfolio(t("fx_forecasts")))
    return rounded(ratio, 9, sharpe=6)


@query("""
SELECT count(*) AS n, round(corr(score, ret), 6) AS oos_correlation FROM fx_forecasts WHERE score IS NOT NULL AND ret IS NOT NULL""")
def oos_forecast_correlation(t):
    return rounded(evaluation.oos_forecast_correlation(t("fx_forecasts")))


@query(f"""WITH {PANEL}
SELECT gsector, count(*) AS n, round(avg(CASE WHEN sign(sentiment) = sign(etf_ret) THEN 1 ELSE 0 END), 6) AS hit_rate
FROM panel WHERE sentiment IS NOT NULL AND etf_ret IS NOT NULL GROUP BY gsector""")
def score_sign_hit_rate(t):
    return rounded(portfolio.score_sign_hit_rate(built_panel(t), "gsector"))


@query(f"""WITH {PANEL}
SELECT CAST(bucket AS INT) AS bucket, count(*) AS n, round(avg(etf_ret), 6) AS mean_etf_ret, round(avg(sentiment), 6) AS mean_score
FROM (SELECT etf_ret, sentiment, ntile(5) OVER (PARTITION BY gsector ORDER BY sentiment, date) AS bucket
      FROM panel WHERE sentiment IS NOT NULL AND etf_ret IS NOT NULL) x GROUP BY bucket""")
def score_bucket_returns(t):
    return rounded(portfolio.score_bucket_returns(built_panel(t)))
