"""Hard negatives against plain Python over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from lamina.llm import hardneg


def _brute(rows, positives=5, negatives=10):
    ints = {}
    for i, v, label in sorted(((r[0], r[1], r[2]) for r in rows if None not in r[:3]), key=lambda r: (r[0], r[2], r[1] or [])):
        if any(x is None or x != x or abs(x) == float("inf") for x in v):
            continue
        ints.setdefault(i, ([int(256 * x // 1) for x in v], label))
    out = []
    for a, (va, la) in ints.items():
        if a % 10:
            continue
        scored = sorted(
            ((-sum(x * y for x, y in zip(va, v)), i, label) for i, (v, label) in ints.items() if len(v) == len(va) and i != a)
        )
        for ps, p, _ in [s for s in scored if s[2] == la][:positives]:
            fits = [(n, -ns) for ns, n, label in scored if label != la and 30 * -ps <= 100 * -ns <= 90 * -ps][:negatives]
            out += [(a, p, k, n, -ps, ns) for k, (n, ns) in enumerate(fits, 1)]
    return sorted(out)


def _run(spark, rows, schema="id long, v array<double>, label int, anchor int, score int, dim string"):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema)
    found = hardneg.hard_negatives(df, F.col("id") % 10 == 0, "id", "v")
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("small_blocks", [False, True])
def test_against_brute_force(spark, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(hardneg, "ROW_VALUES", 300)
        monkeypatch.setattr(hardneg, "ANCHOR_VALUES", 30)
        monkeypatch.setattr(hardneg, "CELLS_AT_ONCE", 100)
    rng = random.Random(4)
    rows = []
    for i in range(260):
        v = [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0, rng.random()]) for _ in range(6)]
        rows.append((i, v, rng.choice([0, 0, 0, 1, 2])))
    rows += [(300 + i, [0.5] * 6, i % 3) for i in range(90)]  # one vector under many ids: ties
    rows += [(1000, [0.1] * 3, 0), (1001, [0.2] * 3, 0), (1002, [0.1, 0.1, 0.2], 1)]  # another length
    rows += [(None, [1.0] * 6, 0), (1010, None, 0), (1020, [1.0] * 6, None), (1030, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0),
             (1040, [float("nan")] * 6, 0), (1050, [float("inf")] * 6, 0), (1060, [], 0), (1061, [], 0), (1062, [], 1)]
    rows += [rows[0], rows[10], rows[20], (30, [9.0] * 6, 5)]  # repeated rows; an id under two labels
    assert _run(spark, rows) == _brute(rows)


def test_negative_zero_and_large_scores(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-2.0, 5.0], 1), (3, [0.0, 1.0], 1), (4, [0.0, 2.0], 0)]
    rows += [(10, [3e6, 5e6], 0), (11, [5e6, 5e6], 0), (12, [3e6, 2e6], 1), (13, [2e6, 3e6], 1)]
    assert _run(spark, rows) == _brute(rows) != []


def test_empty(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(0, [1.0], 1)]) == []


def test_scores_beyond_64_bits(spark):
    got = _run(spark, [(0, [1e30], 0), (1, [1e30], 0), (2, [1e30], 1)])
    assert got == []  # all scores are equal at the largest number, so none is at most 90 hundredths of it
