"""Language identification: the forward sums against enumeration, and held-out accuracy."""

import itertools
import math
from collections import Counter

import numpy as np

from lamina.llm import langid
from lamina.llm.queries import op7_language_id


def _enumerated(word, pieces, share, language):
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        p, start = 1.0, 0
        for i, c in enumerate([*cuts, 1], 1):
            if c:
                part = word[start:i]
                p *= share[part][language] if part in share else langid.UNKNOWN if len(part) == 1 else 0.0
                start = i
        total += p
    return math.log(total)


def _model():
    pieces = ["a", "b", "ab", "ba", "▁", "▁a", "abb", "c"]
    rng = np.random.default_rng(0)
    model = langid.PieceModel(pieces, ["x", "y"])
    order = np.argsort(langid._hashes(pieces))
    model.share[:-1] = rng.random((len(pieces), 2)) / 5
    share = {pieces[o]: model.share[k] for k, o in enumerate(order)}
    return model, share


def test_forward_sums_all_segmentations():
    model, share = _model()
    some = ["▁a", "▁abba", "▁cabab", "▁z", "▁azb", "▁", "▁abbabb"]
    got = model.log_likelihoods(some)
    for i, w in enumerate(some):
        for k in (0, 1):
            assert abs(got[i, k] - _enumerated(w, None, share, k)) < 1e-9


def test_expectation_counts_every_letter_once():
    model, _ = _model()
    pieces = ["a", "b", "ab", "ba", "▁", "▁a", "abb", "c"]
    lengths = np.array([len(p) for p in np.array(pieces)[np.argsort(langid._hashes(pieces))]] + [1])
    expected = model.expected(["▁abba", "▁zab"], np.array([[2.0, 0.0], [1.0, 3.0]]))
    assert np.allclose(lengths @ expected, [2 * 5 + 4, 3 * 4])


def test_words_of_long_runs():
    assert "".join(w[1:] for w in langid.words("X" * 100)) == "x" * 100
    assert max(map(len, langid.words("X" * 100))) <= langid.MAX_RUN + 1
    model = langid.fit_pieces({"en": Counter(langid.words("the cat")), "de": Counter(langid.words("der hund"))})
    assert np.isfinite(model.log_likelihoods(langid.words("漢" * 90 + " " + "q" * 300))).all()


def test_numerals_are_no_letters():
    assert langid.words("½²³ ① Ⅷ 12_3") == [] and langid.words("m² x½y Ab①") == ["▁m", "▁x", "▁y", "▁ab"]
    model = langid.fit_pieces({"en": Counter(langid.words("the cat"))})
    assert [x[0] for x in langid.predict_texts(model, ["½²³", "①", "the ½"], {}, [])] == ["und", "und", "en"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = op7_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out").collect()
    assert len(got) > 100 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "12 !? 3", None),
            (5, "", "de"), (None, "und der hund", None), (6, "der " * 50_000, "de"), (6, "der " * 50_000, "de")]
    docs = spark.createDataFrame([(i, t, x, 0.5) for i, t, x in rows], "doc_id long, text string, lang string, score double")
    got = langid.identify(docs, langid.train(docs)).collect()
    found = {r["doc_id"]: r["lang_pred"] for r in got}
    assert len(got) == len(rows) and found == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "de", 6: "de"}
    nothing = langid.train(docs.filter("lang = 'zz'"))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(docs.limit(0), nothing).count() == 0
