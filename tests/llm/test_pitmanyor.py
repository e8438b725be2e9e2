"""The language model against direct counting, and its probabilities as a distribution."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lamina.llm import pitmanyor as py


def _tokens(text):
    return (text or "").encode().lower().split() + [None]


def test_tokens():
    texts = ["", "A b  c", "Äh\tä\x1cx y\n", " "]
    words, contexts, text_of = py.tokens([t.encode() for t in texts])
    assert Counter(text_of.tolist()) == {0: 1, 1: 4, 2: 4, 3: 1}
    assert words[0] == words[4] == words[-1] == py.END and len(set(words.tolist())) == 7
    assert contexts[0] == contexts[1]  # every text begins after an end


def test_seat_bounds():
    rng = np.random.default_rng(0)
    c = rng.integers(0, 5000, 300)
    t = py.seat(c, np.full(300, 0.5), 0.4, rng)
    assert ((t >= (c > 0)) & (t <= c)).all() and t[c > 1000].mean() > 5


def test_against_counting(spark, monkeypatch):
    monkeypatch.setattr(py, "COMMON_WORDS", 5)
    monkeypatch.setattr(py, "PART_BYTES", 4000)
    monkeypatch.setattr(py, "BLOCK_DOCS", 7)
    rng = random.Random(4)
    vocabulary = [f"Wort{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, range(60, 0, -1), k=rng.randint(1, 80))), i % 4 == 1) for i in range(80)]
    rows += [(200, None, False), (201, "", True), (202, "never seen before", True), (None, "wort1", True), (3, rows[3][1], False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part boolean").repartition(3)
    got = py.score_texts(docs, F.col("part")).collect()
    counts = Counter(t for _, text, h in rows if not h for t in _tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), h, len(_tokens(t)), sum(counts[x] > 0 for x in _tokens(t)), n,
         round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in _tokens(t)), 6))
        for i, t, h in rows
    )
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got) == want
    seen = [r for r in got if not r["held_out"] and r["n_tokens"] > 20]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)
    assert all(r["score"] < 0 for r in got)
    alone = py.score_texts(docs, F.lit(True)).collect()
    assert all(abs(r["base_score"]) < 1e-9 and abs(r["score"]) < 1e-9 for r in alone)
    assert py.score_texts(docs.limit(0), F.col("part")).count() == 0


def test_sums_to_one():
    """Over the known words and one unknown, the probabilities under any context add up to one."""
    rng = np.random.default_rng(7)
    words = np.sort(rng.integers(0, 2**62, 40)).astype(np.int64)
    contexts = np.tile(np.arange(6, dtype=np.int16), 41)
    counts = np.concatenate([rng.integers(0, 30, 240), np.zeros(6, int)]).astype(np.int32)  # the last word is unknown
    row = {
        "words": np.append(words, np.int64(2**62 + 5)), "word_pairs": np.full(41, 6, np.int32),
        "contexts": contexts, "counts": counts,
    }
    common = np.sort(words[:3].view(np.uint64))
    part = py.Part(row, common)
    start = py._initial(part, {"common": common})
    totals = {
        "common": common, "kinds": 40, "parent_tables": 40.0, "parent_customers": float(start["context_tables"].sum()),
        "common_parent_tables": np.ones(3, int), "d0": 0.4, "d1": 0.7, **{k: np.asarray(start[k]) for k in py._KINDS[:4]},
    }
    for sweep in (1, 2):
        part.sample(totals, [sweep, 0])
        totals = py._next_totals(totals, {k: np.asarray(v) for k, v in py._swept(part, totals).items()}, sweep)
    p = part.predictive(totals)
    assert np.allclose(np.bincount(contexts, p), 1.0) and (p > 0).all()


def test_scoring_rows_do_not_grow_with_the_parts(spark, monkeypatch):
    """Parts answer a block in one row, not in one for every document that has one of their words."""
    monkeypatch.setattr(py, "PART_BYTES", 200)
    made, map_batches = {}, py.map_batches

    def counted(df, function, schema, **options):
        out = map_batches(df, function, schema, **options)
        if schema.startswith("block"):
            made["rows"], made["parts"] = out.count(), df.count()
        return out

    monkeypatch.setattr(py, "map_batches", counted)
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(60)), i % 3 == 0) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part boolean").coalesce(1)
    assert py.score_texts(docs, F.col("part")).count() == 100
    assert made["parts"] > 40 and made["rows"] <= made["parts"]


def test_every_word_is_a_context_of_its_own():
    """Not one of a fixed number of classes, in which unrelated words would share a restaurant."""
    vocabulary = [f"w{i}" for i in range(80_000)]
    words, contexts, _ = py.tokens([" ".join(vocabulary).encode()])
    assert len(set(words.tolist())) == len(set(contexts.tolist())) == len(vocabulary) + 1
    assert (contexts[1:] == words[:-1]).all() and contexts[0] == py.END


def test_totals_of_contexts_come_from_all_parts(spark, monkeypatch):
    """Customers and tables of a context as every part sees them, against counting all texts."""
    monkeypatch.setattr(py, "PART_BYTES", 1500)
    monkeypatch.setattr(py, "COMMON_WORDS", 3)
    monkeypatch.setattr(py, "BLOCK_DOCS", 9)
    seen, context_totals = {}, py._context_totals

    def kept(sent, swept):
        out = context_totals(sent, swept)
        seen["sent"], seen["sums"] = sent.collect(), {r["part"]: r for r in out.collect()}
        seen["swept"] = {k: v.filter("shard >= 0").collect() for k, v in swept.items()}
        return out

    monkeypatch.setattr(py, "_context_totals", kept)
    rng = random.Random(11)
    rows = [(i, " ".join(f"v{min(rng.randrange(150), rng.randrange(150))}" for _ in range(40)), i % 5 == 2) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part boolean").repartition(3)
    many = {r["doc_id"]: r["score"] for r in py.score_texts(docs, F.col("part")).collect()}

    customers, pairs = Counter(), Counter()
    for _, text, held in rows:
        words, contexts, _ = py.tokens([text.encode()])
        if not held:
            customers.update(contexts.view(np.int64).tolist())
            pairs.update(zip(contexts.view(np.int64).tolist(), words.tolist()))
    extra = {k: Counter() for k in seen["swept"]}
    for k, found in seen["swept"].items():
        for r in found:
            extra[k].update(dict(zip(r["contexts"], r["extra"])))
    single = Counter(u for u, _ in pairs)
    own = {}
    for r in sorted(seen["sent"], key=lambda r: r["shard"]):
        own.setdefault(r["part"], []).extend(r["contexts"])
    assert len(own) > 5 and max(r["shard"] for r in seen["sent"]) > 0
    for part, contexts in own.items():
        sums = seen["sums"][part]
        assert sums["customers"] == [customers[u] for u in contexts]
        for k in extra:
            tables = sums[f"tables{k}"]
            assert tables == [single[u] + extra[k][u] for u in contexts]
            assert all(t <= c for t, c in zip(tables, sums["customers"]))
    assert any(extra[k] != extra[k + 1] for k in list(extra)[:-1]) and sum(extra[py.SWEEPS].values()) > 0

    # One part, which holds every word, gives the same model but for the draws.
    monkeypatch.setattr(py, "PART_BYTES", 1 << 30)
    one = {r["doc_id"]: r["score"] for r in py.score_texts(docs, F.col("part")).collect()}
    assert max(abs(one[i] - many[i]) / abs(one[i]) for i in one) < 0.03
