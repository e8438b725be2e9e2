"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import ann


def _brute(ids, x, queries, n):
    out = {}
    for k in queries:
        scores = (x * x[k]).sum(axis=1)
        other = np.flatnonzero(ids != ids[k])
        best = other[np.lexsort((ids[other], -scores[other]))[:n]]
        out[int(ids[k])] = [(int(ids[b]), float(scores[b])) for b in best]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, clustered):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((9000, 24))
    if clustered:
        x = 0.4 * x + rng.standard_normal((60, 24))[rng.integers(0, 60, 9000)]
    x[rng.integers(0, 9000, 2000)] = x[7]  # many copies of one vector
    x = x.astype(np.float32)
    ids = np.arange(9000)
    vectors = spark.createDataFrame([(int(i), v.tolist(), 1.0) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, score double")
    got = _found(ann.nearest(vectors, F.col("vec_id") % 50 == 0))
    want = _brute(ids, x.astype(np.float64), range(0, 9000, 50), 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[k]} & {i for i, _ in want[k]}) for k in want)
    assert hits >= 0.93 * 20 * len(want)
    for k, pairs in got.items():
        for i, s in pairs:
            assert abs(s - float(x[i].astype(float) @ x[k].astype(float))) < 1e-9
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))


def test_tests_drop_only_far_candidates():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((500, 32)).astype(np.float32), rng.standard_normal((20, 32)).astype(np.float32)
    turn = ann.rotation(32)
    exact = q @ x.T
    threshold = np.sort(exact, axis=1)[:, -10].astype(np.float64)
    i, j = ann.scan(x @ turn, q @ turn, threshold)
    near = set(zip(*np.nonzero(exact >= threshold[:, None])))
    kept = set(zip(i.tolist(), j.tolist()))
    assert len(near - kept) <= 0.03 * len(near) and len(kept) < 2 * len(near)


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]),
        (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (40, [0.0, 0.0]), (None, [1.0, 1.0]), (8, []),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = _found(ann.nearest(vectors, F.col("vec_id") % 20 == 0))
    assert got == {0: [(20, 1.0), (1, 0.5)], 20: [(0, 1.0), (1, 0.5)]}
    assert ann.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(vectors.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
