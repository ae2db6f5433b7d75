import math
import random

import numpy as np
import pytest

from tessera.llm.hard_negatives import hard_negatives, walk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Every score, row by row."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in e], (y + 1) % 10 if i % 7 == 0 else y) for i, e, y in rows
            if i is not None and y is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for k, (a, u, y) in enumerate(good):
        if a % 100:
            continue
        scores = [(-sum(p * q for p, q in zip(u, v)), b, z) for n, (b, v, z) in enumerate(good) if n != k]
        for s, b, _ in sorted(x for x in scores if x[2] == y)[:5]:
            fits = sorted(x for x in scores if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s)[:5]
            out += [(a, b, r, c, -s, -t) for r, (t, c, _) in enumerate(fits, 1)]
    return sorted(out)


def got(spark, rows):
    return sorted(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())


def test_equals_brute_force(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 16))
    rows = []
    for i in range(3000):
        v = (centres[i % 12] + 0.4 * r.normal(size=16)) * r.uniform(0.2, 3)
        rows.append((i - 900, [float(np.float32(x)) for x in v], int(r.integers(0, 4))))
    assert got(spark, rows) == brute(rows)


def test_ties_and_a_third_of_equal_vectors(spark):
    r = random.Random(2)
    rows = [(i, [1.0, 0.5, 0.0] if i % 3 == 0 else [r.choice([0.0, 0.5, 1.0]) for _ in range(3)], r.randrange(3)) for i in range(1201)]
    assert got(spark, rows) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (5, [1.0, 1.0], 1), (6, [0.99, 0.98], 2), (8, [0.9], 3), (9, [], 2), (None, [1.0, 1.0], 2),
            (10, None, 1), (11, [1.0, None], 1), (12, [nan, 1.0], 2), (13, [1.0, inf], 2), (15, [1.0, 1.0], None), (100, [], 4),
            (16, [1.0, 1.0, 0.0], 2), (200, [-1.0, 0.0], 5), (201, [1.0, 0.0], 5)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    df = spark.createDataFrame([(0, [1.0], 1, "x", 2), (1, [1.0], 2, "y", 3), (2, [1.0], 1, "z", 4)],
                               "vec_id long, embedding array<double>, label int, row string, score int")
    assert [tuple(x) for x in hard_negatives(df).collect()] == [(0, 1, 1, 2, 65536, 65536)]


def test_scores_beyond_doubles(spark):
    big = 3e7  # inner products beyond 2**53
    rows = [(0, [big, 1.0, 0.25], 1), (1, [big, 1.0, 0.5], 1), (2, [big, 1.0, 0.0], 2), (3, [big, 0.0, 0.25], 2), (4, [big, 1.0, 0.25], 3)]
    assert got(spark, rows) == brute(rows)


def test_walk_stops_early():
    """Where rows lie in tight bundles, a member looks at few of them."""
    r = np.random.default_rng(0)
    axes = np.eye(16)
    x = np.floor(256 * np.vstack([axes[i % 16] + 0.01 * r.normal(size=16) for i in range(32_000)]))
    a = x[:64]
    e, s, i, looked = walk(a, np.zeros(64), np.arange(64), np.arange(64) % 16, np.arange(64), np.full(64, -np.inf), np.full(64, np.inf),
                           True, x, np.zeros(len(x)), np.arange(len(x)), np.arange(len(x)))
    assert looked < 0.25 * 64 * len(x)
    want = a @ x.T
    want[np.arange(64), np.arange(64)] = -np.inf
    assert np.array_equal(s.reshape(64, 5), -np.sort(-want, axis=1)[:, :5])


@pytest.mark.parametrize("sample", [1, 3])
def test_sample_of_directions_changes_no_result(spark, sample):
    r = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=4)], i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(x) for x in hard_negatives(df, sample=sample).collect()) == brute(rows)
