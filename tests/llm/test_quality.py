"""The additive model: held-out ranking, features against direct counts, and special cases."""

import numpy as np

from lamina.llm import quality
from lamina.llm.queries import op9_quality


def test_features_against_counting():
    texts = ["", "One two two. Three!\nOne two two. Three!\n\nÄ9 $$", "x" * 5000, "a b c a b c a b c"]
    got = quality.features([t.encode() for t in texts])
    name = {n: i for i, n in enumerate(quality.FEATURES)}
    assert (got[0, [name["log_bytes"], name["digits"], name["top_word"]]] == 0).all()
    words = texts[1].split()
    assert np.isclose(got[1, name["log_words"]], np.log1p(len(words)))
    assert np.isclose(got[1, name["distinct_words"]], len(set(words)) / len(words))
    assert np.isclose(got[1, name["distinct_lines"]], 2 / 3) and np.isclose(got[1, name["top_line"]], 2 / 3)
    assert np.isclose(got[1, name["odd_marks"]], 4 / len(texts[1].encode()))
    assert np.isclose(got[3, name["distinct_triples"]], 3 / 7) and np.isclose(got[3, name["top_word"]], 3 / 9)
    alone = np.concatenate([quality.features([t.encode()]) for t in texts])
    assert np.allclose(got, alone)


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert np.mean((model.score(x[3000:]) > 0.5) == y[3000:]) > 0.9 and (0, 1) in model.pairs
    constant = quality.fit(x, np.ones(4000))
    assert (constant.score(x) > 0.9).all() and 0 <= quality.fit(np.zeros((0, 18)), np.zeros(0)).score(np.zeros((1, 18)))[0] <= 1


def test_held_out_ranking(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = op9_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    ranked = np.mean(good[:, None] > bad[None, :]) + 0.5 * np.mean(good[:, None] == bad[None, :])
    assert ranked > 0.95
    assert np.mean(good >= quality.THRESHOLD) > 0.97


def test_edges(spark):
    rows = [(1, "fine text of a kind", 0), (2, None, 0), (3, "", 0), (None, "x " * 100_000, 0), (1, "fine text of a kind", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert quality.score(docs.limit(0), quality.train(docs, labels.limit(0))).count() == 0
