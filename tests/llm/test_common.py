import random

from pyspark.sql import functions as F

from newsalpha.llm.common import columns_added, components, prepare


def test_components_are_those_of_union_find(spark, frame):
    prepare(spark)
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(150)] + [(5000, 2000 + i) for i in range(80)] + [(7, 7), (None, 3), (3, None)]
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    found = {r.node: r.component for r in components(frame(edges, "a long, b long"), "test").collect()}
    assert found == {x: find(x) for x in parent}
    assert components(frame([], "a long, b long"), "test").collect() == []


def test_columns_of_other_types_pass_through(frame):
    df = frame([(1, "ab", {"k": [1.5]}), (2, None, None)], "id int, text string, other map<string, array<double>>").withColumn("n", F.lit("own"))
    rows = columns_added(df, "text", lambda texts: {"n": [len(t or "") for t in texts]}, "n int").collect()
    assert [(r.id, r.text, r.other, r.n) for r in rows] == [(1, "ab", {"k": [1.5]}, 2), (2, None, None, 0)]
