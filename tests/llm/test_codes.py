import hashlib
import math
import random

import numpy as np

from newsalpha.llm import codes

from .conftest import CLASHES


def brute(rows, parts, entries, rounds):
    """Plain rounds over all entries, in Python's whole numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    whole = [[[math.floor(256 * x) for x in r[1][p * width : (p + 1) * width]] for p in range(parts)] for r in kept]
    books = [[list(w[p]) for w in whole[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for w in whole:
                members[nearest(w[p], book)[1]].append(w[p])
            for e, m in enumerate(members):
                if m:
                    book[e] = [sum(c) // len(m) for c in zip(*m)]
    found = []
    for r, w in zip(kept, whole):
        near = [nearest(w[p], books[p]) for p in range(parts)]
        found.append((r[0], "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), r[2]))
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return [(i, code, error, sum(f[2] for f in found if f[3] == label), digest) for i, code, error, label in found]


def vectors(n, size, seed, step=0.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.2) for _ in range(size)] for _ in range(9)]
    rows = []
    for i in range(n):
        v = [rng.gauss(m, 0.06) for m in rng.choice(middles)]
        rows.append((i * 7 % n, [round(x / step) * step for x in v] if step else v, rng.choice([None, 0, 1, 2])))
    return rows


def as_rows(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


def test_equals_all_entries(frame):
    """Also on a coarse grid, where many entries are equally far or equal."""
    for seed, step in ((1, 0.0), (2, 0.125), (3, 1 / 256)):
        rows = vectors(400, 12, seed, step)
        df = frame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
        for rounds in (1, 2, 5):
            expected = sorted(brute(rows, 3, 20, rounds), key=str)
            assert as_rows(codes.compress(df, parts=3, entries=20, rounds=rounds)) == expected


def test_bounds_spare_distances(frame):
    rows = vectors(600, 16, 4)
    df = frame(rows, "vec_id long, embedding array<float>, label int").repartition(2)
    _, books, measured = codes.fit_codes(df, parts=4, entries=32, rounds=4, listing=8)
    assert books.shape == (4, 32, 4)
    assert len(measured) == 3 and all(m < 600 * 4 * 32 / 3 for m in measured)


def test_lists_follow_moved_entries():
    rng = np.random.default_rng(8)
    x, entries = rng.integers(-40, 40, (300, 3)), rng.integers(-40, 40, (25, 3))
    for length in (1, 2, 6, 25):
        closest, bounds, own = codes.listed(x, entries, length)
        state = codes._pack([(closest, bounds)])
        now = entries
        for _ in range(4):
            new = now + rng.integers(-3, 4, now.shape)
            shifts, now = np.sqrt(((new - now) ** 2).sum(1)) * (1 + codes.MARGIN), new
            ((rows, [(closest, bounds)]),) = codes._unpack(state, 1)
            closest, bounds, own, _ = codes.moved(x[rows], closest, bounds, now, shifts)
            far = codes.squares(x, now)
            assert (closest[:, 0] == far.argmin(1)).all() and (own == far.min(1)).all()
            state = codes._pack([(closest, bounds)])


def test_odd_rows(frame):
    from pyspark.sql import functions as F

    nan, inf = float("nan"), float("inf")
    sound = [(3, [0.5, -0.25, 0.1, 0.0], 1), (None, [0.5, 0.5, 0.5, 0.5], None), (1, [0.0] * 4, None), (1, [0.0] * 4, 1), (2, [-0.0, 1e-9, -1e-9, 9.0], 1)]
    left_out = [(4, None, 1), (5, [], 1), (6, [0.1, None, 0.0, 0.0], 1), (7, [nan, 0.0, 0.0, 0.0], 1), (0, [inf, 0.0, 0.0, 0.0], 1), (8, [0.0, 1e30, 0.0, 0.0], 1)]
    other = [(9, [1.0, 2.0], 1), (10, [1.0, 2.0, 3.0], 1)]
    df = frame(sound + left_out + other, "vec_id long, embedding array<double>, label int")
    df = df.withColumns({name: F.lit("own") for name in (*CLASHES, "code", "error", "state", "sums", "whole", "vector")})
    assert as_rows(codes.compress(df, parts=2, entries=64)) == sorted(brute(sound, 2, 64, 2), key=str)


def test_empty(frame):
    df = codes.compress(frame([], "vec_id long, embedding array<float>, label int"))
    assert df.collect() == [] and df.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
