"""Pfair schedules and benchmark containment against brute force."""

import random
import re

import pytest

from lamina.llm import decontaminate, mixing


@pytest.mark.parametrize("weights", [[1], [1, 1, 1], [5, 3, 1], [1, 97, 2], [7, 11, 13, 2, 1, 1]])
def test_less_than_one_block_off_in_every_prefix(weights):
    total = sum(weights)
    out = mixing.period(weights)
    assert [s for _, _, s in out] == list(range(total))
    done = [0] * len(weights)
    for t, (k, j, _) in enumerate(out, 1):
        assert j == done[k]
        done[k] += 1
        assert all(abs(d * total - w * t) < total for d, w in zip(done, weights))


def test_mix(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), "x") for i in range(700)] + [(None, "b", "x"), (5, "a", "x"), (5, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, k string").repartition(4)
    got = mixing.mix(docs, {"a": 2, "b": 1, "zz": 9}, block_docs=8).collect()
    assert len(got) == len(rows)
    assert all((r["slot"] is None) == (r["source"] is None) for r in got)
    places = [(r["source"], r["block"], r["place"]) for r in got]
    assert len(set(places)) == len(places)
    owner = {}
    for r in got:
        if r["slot"] is not None:
            assert owner.setdefault(r["slot"], (r["source"], r["block"])) == (r["source"], r["block"])
    on = sorted({r["slot"] for r in got if r["on_target"]})
    assert on == list(range(len(on))) and on
    for t in range(1, len(on) + 1):
        a = sum(owner[s][0] == "a" for s in range(t))
        assert abs(a - 2 * t / 3) < 1
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.filter("source is null")).filter("slot is not null").count() > 0


def _shingles(text):
    w = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_contained_items(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([3, 5, 6, 12, 40, 90, 300])))) for k in range(40)]
    items += [(100, None), (101, ""), (None, "a b c d e f"), (3, items[3][1])]
    docs = []
    for d in range(120):
        text = rng.choices(words, k=rng.randint(0, 200))
        for _, item in rng.sample(items[:40], rng.randint(0, 2)):
            part = item.split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = part
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(text).title()))
    docs += [(500, None), (501, ""), (None, items[5][1]), (7, docs[7][1]), (502, ("x " * 30_000) + items[6][1])]
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in docs], "doc_id long, text string, shingle int, item int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["id"], r["item"], r["n_shared"], r["n_item"]) for r in decontaminate.contaminated(df, bench).collect()}
    want = set()
    for d, t in docs:
        have = _shingles(t)
        for k, item in items:
            own = _shingles(item)
            if k is not None and own and len(own & have) >= 0.8 * len(own) - 1e-9:
                want.add((d, k, len(own & have), len(own)))
    assert got == want and len(want) > 30
    bad = {d for d, *_ in want}
    kept = [r["doc_id"] for r in decontaminate.decontaminate(df, bench).collect()]
    assert sorted(map(str, kept)) == sorted(str(d) for d, _ in docs if d not in bad)
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
