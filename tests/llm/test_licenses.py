"""License notices against counting words, and against a plain edit-distance search."""

import random
import re

from lamina.llm import licenses
from lamina.llm.licenses import BASE, NOTICES, allowed_edits

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _base(text):
    words = WORD.findall(_lower(text))
    hits = []
    for phrase, label in BASE.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def _within(text, notice, k):
    """Whether some substring of ``text`` is within ``k`` edits (Sellers' algorithm)."""
    row = list(range(len(notice) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, n in enumerate(notice, 1):
            new.append(min(row[i - 1] + (c != n), row[i] + 1, new[i - 1] + 1))
        row, best = new, min(best, new[-1])
    return best <= k


def _scan(texts):
    return licenses._scan_chunk(licenses.Matcher(NOTICES), [t.encode() for t in texts])


def test_base_counts():
    rng = random.Random(1)
    parts = ["cc", "by", "CC-BY", "General", "public", "license", "all rights", "reserved", "ü", "xcc", "bye", ".", "\n", "[", "`", "É"]
    texts = [rng.choice([" ", "--", ""]).join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(500)]
    for text, row in zip(texts, _scan(texts)):
        assert row[:5] == _base(text)


def test_fuzzy_agrees_with_edit_distance():
    rng = random.Random(2)
    notices = list(NOTICES)
    for _ in range(150):
        notice = rng.choice(notices)
        chars = list(notice)
        for _ in range(rng.randint(0, allowed_edits(notice) + 2)):
            i = rng.randrange(len(chars))
            chars[i : i + 1] = rng.choice([[], [rng.choice("abcz")], [chars[i], rng.choice("abcz")]])
        normal = " ".join(WORD.findall("lorem ipsum " + "".join(chars) + " dolor"))
        row = _scan([normal])[0]
        for label in set(NOTICES.values()):
            near = any(_within(normal, n, allowed_edits(n)) for n, x in NOTICES.items() if x == label)
            assert (label in row[5].split(",")) == (near or label in row[4].split(",")), (normal, label)


def test_spans_point_into_the_text(spark):
    text = "Ünter: Licensed  under the Apache Lisense, Version 2.0.\nAll rights reserved!"
    rows = [(1, text, 0), (2, None, 0), (3, "", 0), (1, text, 0), (None, "x " * 200_000 + "Released under the MIT License", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = licenses.license_spans(docs).collect()
    assert len(got) == 5
    for r in got:
        if r["doc_id"] == 1:
            found = {s["label"]: text[s["start"] : s["end"]] for s in r["spans"]}
            assert found["apache"] == "Licensed  under the Apache Lisense" and found["reserved"] == "All rights reserved"
            assert r["labels"] == "apache,reserved" and r["base_labels"] == "reserved" and r["score"] == 1.0
        elif r["doc_id"] is None:
            assert r["labels"] == "mit" and r["n_words"] == 200_005 and r["spans"][0]["start"] == 400_000
        else:
            assert (r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, 0, None, "", 0.0)
