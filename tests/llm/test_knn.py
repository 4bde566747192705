"""Voronoi join (5)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsquality.llm import knn


def brute(rows, k):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is None or i % 50:
            continue
        s = [(-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(ok) if a != b and len(v) == len(q)]
        out += [(i, r + 1, None if n else j, -s_) for r, (s_, n, j) in enumerate(sorted(s)[:k])]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows],
                                 "vec_id BIGINT, embedding ARRAY<FLOAT>, row INT, cell STRING").repartition(3)


@pytest.mark.parametrize("options", [{}, {"n_pivots": 5, "group_queries": 3, "block_rows": 50}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 520)]  # one vector many times: ties
    rows += [(600, None), (601, [1.0, None] + [0.0] * 6), (602, [float("nan")] * 8), (603, [float("inf")] * 8), (650, [0.0] * 8),
             (700, [1.0, 2.0]), (701, [3.0, 4.0]), (750, []), (None, rows[1][1]), (50, rows[2][1]), (50, rows[2][1])]
    got = knn.top_k(frame(spark, rows), F.col("id") % 50 == 0, **options).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, 5)


def test_far_cells_are_not_sent(spark):
    """Clusters far apart: the bounds keep all but the near ones away."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * 0.1 + 50 * np.eye(4)[i % 4]).tolist()) for i in range(800)]
    df = frame(spark, rows)
    got = knn.top_k(df, F.col("id") % 50 == 0, n_pivots=16).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, 5)
    pivots = {4: np.array([256 * 50 * np.eye(4)[c] for c in range(4)])}
    summary = [{"dim": 4, "cell": c, "radius": 200.0, "dists": [1.0] * 6} for c in range(4)]
    asked = [{"dim": 4, "cell": 1, "n": 5, "norm": 13_000.0, "radius": 200.0, "reached": -math.inf}]
    groups, need = knn._plan(summary, asked, pivots, 5, 1000)
    assert groups == [(4, 1, 0, 1)] and {r[1] for r in need} == {1}


def test_short_vectors_are_not_sent(spark):
    """The queries' products with the pivots say which lengths no answer can have; a hot cell of queries is one plan."""
    pivots = {4: np.array([256 * 50 * np.eye(4)[c] for c in range(4)])}
    summary = [{"dim": 4, "cell": c, "radius": 1e8, "dists": [1e8] * 6} for c in range(4)]
    asked = [{"dim": 4, "cell": 1, "n": 5000, "norm": 100.0, "radius": 10.0, "reached": 50_000.0}]
    groups, need = knn._plan(summary, asked, pivots, 5, 1000)
    assert groups == [(4, 1, 0, 5)] and len(need) == 4
    assert {r[2:4] for r in need} == {(0, 5)} and all(499 < r[5] <= 500 for r in need)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * (1 if i % 3 else 40)).tolist()) for i in range(900)]
    got = knn.top_k(frame(spark, rows), F.col("id") % 50 == 0, group_queries=4).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, 5)


def test_pivots_grow_and_cells_chain(spark):
    assert knn._chain(np.array([[0.0], [10.0], [1.0], [11.0], [2.0]]), [0, 1, 2, 3, 4]) == [0, 2, 4, 1, 3]
    x = np.array([3.0, -32768.0, 5.0])
    assert len(knn._packed(x[[0, 2]])) == 4 and len(knn._packed(x)) == 24
    assert (knn._unpacked(knn._packed(x), 3) == x).all()


def test_large_numbers_and_few_rows(spark):
    rows = [(0, [1e30, -1e30]), (1, [1e30, 1e30]), (50, [3.0e8, 1.0]), (2, [2.5e8, 7.0])]
    got = {tuple(r) for r in knn.top_k(frame(spark, rows), F.col("id") % 50 == 0).collect()}
    want = {(i, r, j, max(-knn._LONG, min(knn._LONG, s))) for i, r, j, s in brute(rows, 5)}
    assert {g[:1] + g[2:] for g in got} == {w[:1] + w[2:] for w in want}
    assert knn.top_k(frame(spark, rows[:1]), F.col("id") % 50 == 0).collect() == []
    assert knn.top_k(frame(spark, []), F.col("id") % 50 == 0).collect() == []
