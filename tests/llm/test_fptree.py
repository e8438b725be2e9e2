"""Ranked search against plain Python over all documents and items."""

import math
import random
import re
from collections import Counter

import pytest

from lamina.llm import fptree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOW))


def _brute(docs, items, best=10):
    counted = [(d, Counter(_terms(t)), len(_terms(t))) for d, t in docs]
    n_docs, length = sum(n > 0 for _, _, n in counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(_terms(t))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c, n in counted:
            s = 0
            for t in terms & set(c):
                m = 100 - 90 + (90 * n * n_docs) // length
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:best], 1)]
    return sorted(out, key=str)


def _run(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, n int, number int")
    i = spark.createDataFrame([(*r, 3, "x") for r in items], "item_id long, text string, score int, rank string")
    return sorted((tuple(r) for r in fptree.search(d, i).collect()), key=str)


def _corpus(rng):
    words = [f"w{k}" for k in range(60)] + ["Ñandú", "漢字", "x²", "naïve", "ÉA"]
    weights = [60 / (k + 1) for k in range(len(words))]
    docs = [(d, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 10, 30, 120])))) for d in range(500)]
    items = [(i, ", ".join(rng.choices(words, weights, k=rng.choice([1, 4, 12]))).upper()) for i in range(30)]
    docs += [(600 + k, docs[7][1]) for k in range(40)] + [docs[7], docs[8]]  # ties and repeated rows
    docs += [(None, docs[3][1]), (None, docs[9][1]), (700, None), (701, ""), (702, " .,- "), (-5, docs[3][1])]
    docs += [(703, " ".join(rng.choices(words, weights, k=60_000)))]
    items += [(30, None), (31, ""), (32, "unknown words"), (None, "w1 w2"), (33, docs[20][1]), (33, "w59")]
    return docs, items


@pytest.mark.parametrize("tree", [10**6, 300])
@pytest.mark.parametrize("bucket", [32, 1])
def test_against_brute_force(spark, monkeypatch, tree, bucket):
    monkeypatch.setattr(fptree, "TREE_TERMS", tree)
    monkeypatch.setattr(fptree, "BUCKET", bucket)
    docs, items = _corpus(random.Random(6))
    assert _run(spark, docs, items) == _brute(docs, items)


def test_several_passes_and_few_cells(spark, monkeypatch):
    monkeypatch.setattr(fptree, "ITEM_TERMS", 25)
    monkeypatch.setattr(fptree, "TREE_CELLS", 2000)
    docs, items = _corpus(random.Random(7))
    assert _run(spark, docs, items) == _brute(docs, items)


def test_bounds_hold():
    """No document scores above the bound of a node over it."""
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(40, rng.integers(1, 15), replace=False)) for _ in range(400)]
    sizes = np.array([len(r) for r in rows])
    tf, m = rng.integers(1, 9, sizes.sum()), rng.integers(10, 400, len(rows))
    tree = fptree.Tree(sizes, np.concatenate(rows), tf, m, 40)
    weights = rng.integers(0, 5000, 40)
    scores = np.array([(weights[tree.rank[a:b]] * tree.worth[a:b]).sum() for a, b in zip(tree.edges, tree.edges[1:])])
    ranks = np.arange(40)
    for k in range(len(tree.low)):
        bound = fptree.saturation(tree.tf[k], tree.least[k])[ranks] @ weights
        assert bound >= scores[tree.low[k] : tree.high[k]].max()
    assert len(tree.low) > 10 and sorted(tree.order) == list(range(400))


def test_empty(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert _run(spark, [], items) == [] and _run(spark, docs, []) == []
    assert _run(spark, [(1, None)], items) == [] and _run(spark, docs, [(1, None)]) == []
