import numpy as np

from newsalpha.llm import grid_join
from newsalpha.llm.grid_join import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, vectors, least):
    unit = [None if v is None or not len(v) or any(x is None for x in v) or not np.isfinite(np.array(v, float)).all() or not np.any(v)
            else np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for v in vectors]
    label, counts = list(range(len(ids))), [0] * len(ids)
    pairs = [(i, j) for i in range(len(ids)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and ids[i] is not None and ids[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]
    for i, j in pairs:
        counts[i] += 1
        counts[j] += 1
    for _ in ids:
        for i, j in pairs:
            low = label[i] if ids[label[i]] < ids[label[j]] else label[j]
            label[i] = label[j] = low
    return sorted(((i, n, ids[k]) for i, n, k in zip(ids, counts, label)), key=str)


def found(df, **options):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df, **options).collect()), key=str)


def test_equals_all_pairs(frame, monkeypatch):
    monkeypatch.setattr(grid_join, "BLOCK_BYTES", 40 * 8 * 4)
    monkeypatch.setattr(grid_join, "LEAF", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8))
    vectors = np.vstack([centres[rng.integers(40, size=300)] + rng.normal(size=(300, 8)) * 0.25, rng.normal(size=(300, 8))])
    vectors = [list(map(float, np.float32(v))) for v in vectors * rng.uniform(0.1, 9, size=(600, 1))]
    ids = rng.permutation(600).tolist()
    df = frame([(i, v, 0) for i, v in zip(ids, vectors)], SCHEMA).repartition(5)
    expected = brute(ids, vectors, 0.9)
    assert any(n > 1 for _, n, _ in expected)
    assert found(df, least=0.9) == expected


def test_odd_vectors(frame):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.0], [2.0, 0.01], None, [], [0.0, 0.0], [None, 1.0], [nan, 1.0], [inf, 1.0], [1.0, 0.0, 0.0], [1.0, 0.0], [-1.0, 0.0]]
    ids = [4, 3, 9, 5, 6, 7, 8, 10, 11, 12, None, 13]
    df = frame([(i, v, None) for i, v in zip(ids, vectors)], SCHEMA)
    expected = brute(ids, vectors, 0.95)
    got = found(df)
    assert [x for x in got if x[0] is not None] == [x for x in expected if x[0] is not None]
    assert [r.kept for r in near_vectors(df).where("vec_id is null").collect()] == [True]


def test_many_equal_vectors_are_one_class(frame):
    rows = found(frame([(i, [0.5, 0.25, 1.0], 0) for i in range(300)], SCHEMA).repartition(3))
    assert {r[1:] for r in rows} == {(299, 0)}


def test_empty(frame):
    assert near_vectors(frame([], SCHEMA)).collect() == []
