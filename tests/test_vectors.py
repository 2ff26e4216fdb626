import sys
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newsalpha.functions import vectors as vec
from newsalpha.operators import decomposition, embedding, similarity
from newsalpha.sources.readers import gather_dimensions, scan_chunks, spread_dimensions


def table(spark, matrix, key="id"):
    rows = [(i, row.tolist()) for i, row in enumerate(np.asarray(matrix, dtype=float))]
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<double>")


def cosines(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return unit @ unit.T


HIDDEN = np.array([
    [[1.0, 2, 3], [7, 8, 9], [9, 9, 9], [9, 9, 9]],
    [[10.0, 20, 30], [40, 50, 60], [0, 0, 0], [0, 0, 0]],
])


def test_masked_mean_in_a_batch():
    mask = np.array([[1, 1, 0, 0], [1, 1, 0, 0]])
    assert embedding.pool_tokens(HIDDEN, mask).tolist() == [[4, 5, 6], [25, 35, 45]]
    assert embedding.pool_tokens(HIDDEN, np.zeros((2, 4), dtype=int)).tolist() == [[0, 0, 0], [0, 0, 0]]


def test_masked_mean_of_a_token_table(frame):
    rows = [(t, p, 1 if p < 2 else 0, HIDDEN[t, p].tolist()) for t in range(2) for p in range(4)]
    rows += [(9, p, 0, [5.0, 5.0, 5.0]) for p in range(3)]
    df = frame(rows, "text_id int, pos int, attention_mask int, embedding array<float>")
    found = {r.text_id: r.embedding for r in embedding.mean_pool(df, "text_id").collect()}
    assert found == {0: [4, 5, 6], 1: [25, 35, 45], 9: [0, 0, 0]}


def test_unit_vectors(frame):
    df = frame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r.u for r in df.select(vec.l2_normalize(F.col("v")).alias("u")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_full_matrix_of_a_small_set(spark):
    x = np.random.default_rng(0).normal(size=(12, 5))
    df = table(spark, x)
    found = np.zeros((12, 12))
    for r in similarity.pairwise_cosine(df, df, "id").collect():
        found[r.id, r.panel_id] = r.cosine
    assert np.allclose(found, cosines(x), atol=5e-4 + 1e-9)


def test_extreme_pairs_match_brute_force(spark):
    x = np.random.default_rng(1).normal(size=(40, 3))
    df = table(spark, x).repartition(5)
    sim = cosines(x)
    i, j = np.triu_indices(40, 1)
    values = sim[i, j]
    found = {r.which: r for r in similarity.extreme_pairs(df, df, "id").collect()}
    for which, k in (("most", values.argmax()), ("least", values.argmin())):
        assert (found[which].id_a, found[which].id_b) == (i[k], j[k])
        assert found[which].cosine == pytest.approx(values[k])


def test_extreme_pairs_settle_ties_by_id(spark):
    df = table(spark, [[1, 0], [1, 0], [1, 0], [-1, 0], [-1, 0]]).repartition(3)
    found = {r.which: (r.id_a, r.id_b) for r in similarity.extreme_pairs(df, df, "id").collect()}
    assert found == {"most": (0, 1), "least": (0, 3)}


def test_nearest_and_analogy_match_brute_force(spark):
    x = np.random.default_rng(2).normal(size=(50, 4))
    df = table(spark, x).repartition(6)
    target = x[3] - x[4] + x[5]
    score = x @ target / np.linalg.norm(x, axis=1) / np.linalg.norm(target)
    score[[3, 4, 5]] = -2
    rows = similarity.vector_analogy(df, 3, 4, 5, "id", n=4).orderBy("rank").collect()
    assert [r.id for r in rows] == np.argsort(-score)[:4].tolist()
    queries = df.where("id in (7, 8)")
    near = similarity.top_n_nearest(df, queries, "id", n=3).collect()
    sim = cosines(x)
    sim[:, [7, 8]] = -2
    for q in (7, 8):
        assert [r.id for r in sorted(near, key=lambda r: r["rank"]) if r.panel_id == q] == np.argsort(-sim[q])[:3].tolist()


def test_string_ids(frame):
    df = frame([("king", [1.0, 1.0]), ("man", [1.0, 0.0]), ("woman", [0.0, 1.0]), ("queen", [0.1, 2.0]), ("cat", [-1.0, 0.0])], "w string, embedding array<double>")
    rows = similarity.vector_analogy(df, "king", "man", "woman", "w", n=1).collect()
    assert [r.w for r in rows] == ["queen"]


def test_a_large_panel_is_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    df = table(spark, rng.normal(size=(40, 3)))
    whole = {tuple(r) for r in similarity.pairwise_cosine(df, df, "id").collect()}
    monkeypatch.setattr(similarity, "CELLS", 21)
    blocks = similarity.compare(df, df, "id", "embedding", lambda c, d, o, n: tuple(i.ravel() for i in np.indices(c.shape)), 7)
    assert {(r.id, r.panel_id, round(r.cosine, 3)) for r in blocks.collect()} == {(a, b, round(c, 3)) for a, b, c in whole} and len(whole) == 1600


def test_extremes_take_the_first_of_tied_pairs(spark):
    df = table(spark, np.array([[1.0, 0], [2, 0], [3, 0], [0, 1], [0, 2]]))
    rows = {r.which: (r.id_a, r.id_b) for r in similarity.extreme_pairs(df, df, "id").collect()}
    assert rows == {"most": (0, 1), "least": (0, 3)}


def test_an_empty_panel_keeps_the_type_of_the_id(frame):
    df = frame([("a", [1.0])], "id string, embedding array<double>")
    assert dict(similarity.pairwise_cosine(df, df.limit(0), "id").dtypes)["panel_id"] == "string"


# Python workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class CountingEmbedder:
    """Length and first letter, so that tests can see which texts reached the model."""

    def encode(self, texts):
        return np.array([[len(t), ord(t[0]) if t else 0] for t in texts], dtype=np.float32)


def test_embedding_one_row_per_story(frame):
    df = frame([(1, "abc"), (1, "abc"), (2, None), (3, "abc"), (4, "z")], "rp_story_id bigint, headline string")
    found = {r.rp_story_id: r.embedding for r in embedding.embed_headlines(df, CountingEmbedder).collect()}
    assert found == {1: [3, 97], 2: [0, 0], 3: [3, 97], 4: [1, 122]}
    prompted = embedding.embed_headlines(df, CountingEmbedder, prompt="p: ", normalize=True)
    vector = {r.rp_story_id: r.embedding for r in prompted.collect()}[4]
    assert vector == pytest.approx([4 / np.hypot(4, 112), 112 / np.hypot(4, 112)])


def test_only_new_stories_are_appended(frame, spark, tmp_path):
    path = str(tmp_path / "vectors")
    embedding.append_new_embeddings(frame([(1, "a"), (2, "b")], "rp_story_id bigint, headline string"), path, CountingEmbedder)
    embedding.append_new_embeddings(frame([(2, "changed"), (3, "c")], "rp_story_id bigint, headline string"), path, CountingEmbedder)
    rows = {r.rp_story_id: r.embedding for r in spark.read.parquet(path).collect()}
    assert rows == {1: [1, 97], 2: [1, 98], 3: [1, 99]} and spark.read.parquet(path).count() == 3


def test_long_texts_are_read_to_the_end(frame):
    words = [f"w{i}" for i in range(150)]
    df = frame([(1, " ".join(words)), (2, "one"), (3, "")], "id int, text string")
    model = embedding.HashingEmbedder(32)
    make = partial(embedding.HashingEmbedder, 32)
    found = {r.id: r.embedding for r in embedding.chunk_embed_average(df, "id", "text", make, chunk_words=64).collect()}
    chunks = [" ".join(words[i : i + 64]) for i in (0, 64, 128)]
    assert np.allclose(found[1], model.encode(chunks).astype(float).mean(axis=0), atol=1e-6)
    assert np.allclose(found[2], model.encode(["one"])[0])
    assert not any(found[3])


def test_vectors_of_chunks_are_not_shuffled(frame):
    """Texts of more chunks than a row holds, repeated and null keys; the model's vectors meet before the only shuffle."""
    long = " ".join(f"w{i}" for i in range(1000))
    df = frame([(1, long), (1, "a b c"), (None, "x"), (None, None), (2, " \u2003 ")], "id int, text string")
    model, make = embedding.HashingEmbedder(16), partial(embedding.HashingEmbedder, 16)
    found = embedding.chunk_embed_average(df, "id", "text", make, chunk_words=4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and plan.count("Aggregate") == 1
    rows = {r.id: r.embedding for r in found.collect()}
    split = long.split()
    chunks = [" ".join(split[i : i + 4]) for i in range(0, 1000, 4)] + ["a b c"]
    assert np.allclose(rows[1], model.encode(chunks).astype(float).mean(axis=0), atol=1e-6)
    assert np.allclose(rows[None], model.encode(["x", ""]).astype(float).mean(axis=0)) and not any(rows[2])


def test_tokenizer_gets_whole_texts(frame):
    df = frame([("a b c",), (None,), ("x" * 5000,)], "text string")
    rows = embedding.token_counts(df, "text", lambda texts: [len(t) for t in texts]).collect()
    assert [r.tokens for r in rows] == [5, None, 5000]
    assert embedding.token_counts(frame([("It's 5%.",)], "text string"), "text").first().tokens == 6


def test_pca_matches_numpy(spark):
    x = np.random.default_rng(3).normal(size=(60, 4)) * [5, 2, 1, 0.5] + 7
    projected, share = decomposition.pca_project(table(spark, x), "id")
    centred = x - x.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(share, (s**2 / (s**2).sum())[:2])
    rows = np.array([r.components for r in projected.orderBy("id").collect()])
    assert np.allclose(np.abs(rows), np.abs(centred @ vt[:2].T))


def test_tfidf_svd_matches_numpy(frame):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"word{k}" for k in rng.integers(0, 30, size=20)) for _ in range(40)]
    df = frame(list(enumerate(texts)), "id int, text string").repartition(3)
    model = decomposition.fit_tfidf_svd(df, "text", 5)
    words = model.weights.vocabulary
    counts = np.array([[text.split().count(w) for w in words] for text in texts])
    weights = counts * (np.log((1 + 40) / (1 + (counts > 0).sum(0))) + 1)
    weights /= np.linalg.norm(weights, axis=1, keepdims=True)
    entries = {(r.id, r.word): r.weight for r in model.weights.entries(df, "id", "text").collect()}
    assert entries == {(i, words[j]): pytest.approx(weights[i, j]) for i, j in zip(*np.nonzero(weights))}
    assert np.allclose(model.singular_values, np.linalg.svd(weights, compute_uv=False)[:5])
    # A'A v = s^2 v for every direction v.
    assert np.allclose(weights.T @ weights @ model.basis, model.basis * model.singular_values**2, atol=1e-8)
    found = np.array([r.embedding for r in model.transform(df, "id", "text").orderBy("id").collect()])
    assert np.allclose(found, weights @ model.basis, atol=1e-9)


def test_words_are_met_once(frame):
    """One join and no second count for the weights, whether or not an id repeats."""
    df = frame([(1, "b aa b Å b"), (2, "aa bb aa"), (3, None), (4, "!"), (5, "cc aa bb bb")], "id int, text string")
    entries = decomposition.fit_tfidf(df, "text").entries(df, "id", "text")
    assert entries._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    weights = {(r.id, r.word): r.weight for r in entries.collect()}
    assert weights.keys() == {(1, "aa"), (2, "aa"), (2, "bb"), (5, "cc"), (5, "aa"), (5, "bb")} and weights[1, "aa"] == 1
    split = frame([(1, "aa bb"), (1, "bb cc"), (None, "aa"), (None, "cc cc")], "id int, text string")
    counts = {(r.id, r.word): r.n for r in decomposition.word_counts(split, "text", "id").collect()}
    assert counts == {(1, "aa"): 1, (1, "bb"): 2, (1, "cc"): 1, (None, "aa"): 1, (None, "cc"): 2}
    found = {(r.id, r.word): r.weight for r in decomposition.fit_tfidf(split, "text").entries(split, "id", "text").collect()}
    assert found.keys() == counts.keys() and sum(w * w for (i, _), w in found.items() if i is None) == pytest.approx(1)


def test_left_vectors_come_from_tables(frame, spark):
    """More columns than a step adds, words of one row, repeated values and rows that nothing meets; as NumPy finds them."""
    rng = np.random.default_rng(7)
    dense = np.where(rng.random((120, 60)) < 0.1, rng.random((120, 60)), 0) * np.linspace(3, 0.1, 60)
    dense = np.hstack([np.vstack([dense, np.zeros((24, 60))]), np.vstack([np.zeros((120, 24)), 2 * np.eye(24)])])
    dense = dense[dense.any(axis=1)]
    df = (dense > 0).sum(0)
    entries = frame([(int(i), int(j), int(df[j]), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))], "row long, number long, df long, weight double")
    left, values = decomposition.left_vectors(entries, 40)
    assert np.allclose(values, np.linalg.svd(dense, compute_uv=False)[:40])
    u = np.array([r.u for r in left.orderBy("row").collect()])
    assert np.allclose(u.T @ u, np.eye(40), atol=1e-9) and np.allclose(dense @ (dense.T @ u), u * values**2, atol=1e-6)


def test_products_by_parts_match_numpy(frame):
    """Both products from parts of the keys: a vector is sent once per part, no entry is joined; numbers in several bins, null keys, gaps."""
    rng, apart = np.random.default_rng(11), decomposition.BIN // 3
    dense = np.where(rng.random((30, 40)) < 0.2, rng.random((30, 40)), 0)
    keys = [None if i == 3 else f"k{i}" for i in range(30)]
    entries = frame([(keys[i], int(j) * apart, float(dense[i, j])) for i, j in zip(*np.nonzero(dense))], "key string, number long, weight double")
    given = rng.normal(size=(40, 3))
    vectors = frame([(j * apart, given[j].tolist()) for j in range(35)], "number long, v array<double>")
    right = decomposition.gathered(entries, vectors, "v", "key", 3, "sum")
    assert "Join" not in right._jdf.queryExecution().optimizedPlan().toString()
    found = {r["key"]: r["sum"] for r in right.collect()}
    want = {keys[i]: dense[i, :35] @ given[:35] for i in range(30) if dense[i, :35].any()}
    assert found.keys() == want.keys() and all(np.allclose(found[i], want[i]) for i in want)
    left = rng.normal(size=(30, 2))
    across = decomposition.scattered(entries, frame([(keys[i], left[i].tolist()) for i in range(30)], "key string, u array<double>"), "u", "key", 2, "sum")
    assert "Join" not in across._jdf.queryExecution().optimizedPlan().toString()
    found = {r["number"]: r["sum"] for r in across.collect()}
    want = {j * apart: dense[:, j] @ left for j in range(40) if dense[:, j].any()}
    assert found.keys() == want.keys() and all(np.allclose(found[j], want[j]) for j in want)


def test_rows_are_held_in_even_parts(frame, spark):
    """A task has as many parts as any other, and every entry is in one record, by row and by column."""
    entries = frame([(i, (i * 7 + j) % 50, 1 + (i + j) % 3, float(i + j + 1)) for i in range(200) for j in range(5)], "row long, number long, df long, weight double")
    blocks = decomposition.blocks_of(entries).withColumn("task", F.expr(f"pmod(hash(part), {spark.conf.get('spark.sql.shuffle.partitions')})")).collect()
    assert len({r.task for r in blocks}) == len(blocks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(i for r in blocks for i in np.frombuffer(r.rows, np.int64)) == list(range(200))
    assert sum(len(r.row_columns) for r in blocks) == sum(len(r.column_rows) for r in blocks) == 4 * 1000
    assert sum(np.frombuffer(r.column_weights).sum() for r in blocks) == sum(i + j + 1 for i in range(200) for j in range(5))


def test_direction_errors_tell_wrong_directions(frame):
    df = frame([(i, " ".join(f"word{k}" for k in range(i % 7, i % 7 + i % 5 + 2))) for i in range(30)], "id int, text string")
    model = decomposition.fit_tfidf_svd(df, "text", 3)
    good = decomposition.direction_errors(model, df, "id", "text").collect()
    assert len(good) == 3 and all(r.residual < 1e-8 and r.skew < 1e-8 for r in good)
    bent = F.transform("direction", lambda x, j: F.when(j == 1, x * 2).otherwise(x))
    model.directions = model.directions.select("number", bent.alias("direction"))
    bad = {r.direction: r for r in decomposition.direction_errors(model, df, "id", "text").collect()}
    assert bad[1].skew > 0.5 and bad[0].skew < 1e-8


def test_neither_vocabulary_nor_directions_go_through_the_driver(frame):
    """The embeddings come from written tables by joins; nothing is made from a local list."""
    df = frame([(i, f"alpha beta gamma{i % 3}") for i in range(12)], "id int, text string")
    plan = decomposition.tfidf_svd(df, "id", "text", k=2)._jdf.queryExecution().toString()
    assert "LocalTableScan" not in plan and "LogicalRDD" not in plan.replace("LogicalRDD [id", "")
    assert plan.count("words-") and plan.count("directions-")


def test_fits_without_words(frame):
    df = frame([(1, "! ?"), (2, None)], "id int, text string")
    assert [r.embedding for r in decomposition.tfidf_svd(df, "id", "text", k=4).collect()] == [[], []]


def test_fit_on_training_texts_only(frame):
    train = frame([(i, f"alpha beta gamma{i % 3}") for i in range(12)], "id int, text string")
    new = frame([(99, "alpha unseen words"), (100, None)], "id int, text string")
    rows = {r.id: r.embedding for r in decomposition.tfidf_svd(new, "id", "text", k=2, fit_on=train).collect()}
    assert len(rows[99]) == 2 and any(rows[99]) and rows[100] == [0.0, 0.0]


def test_chunk_files_with_one_column_per_dimension(spark, tmp_path):
    for i, ids in enumerate(([1, 2], [2, 3])):
        columns = {"rp_story_id": ids, **{f"dim_{d}": [float(x * 100 + d) for x in ids] for d in range(12)}}
        pq.write_table(pa.table(columns), tmp_path / f"chunk_{i:06d}.parquet")
    pq.write_table(pa.table({"other": [1]}), tmp_path / "notes.parquet")
    rows = {r.rp_story_id: r.embedding for r in scan_chunks(spark, str(tmp_path)).collect()}
    assert rows == {i: [i * 100 + d for d in range(12)] for i in (1, 2, 3)}
    wide = spread_dimensions(scan_chunks(spark, str(tmp_path)), 12)
    assert wide.columns[:3] == ["rp_story_id", "dim_0", "dim_1"] and gather_dimensions(wide).count() == 3
