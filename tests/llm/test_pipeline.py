"""The corpus pipeline against the operators' brute-force versions, one stage after another."""

import random

import corpus_pipeline
from lamina.llm import mixing
from tests.llm.test_linededup import _brute
from tests.llm.test_mixing_and_benchmark import _shingles
from tests.llm.test_simhash import _components, _reference


def _expected(rows, items):
    """Ids and texts that are left before the last stage."""
    kept = [(d, t, s) for d, t, s in rows if t is not None and any(c.isalpha() for c in t)]
    lines = _brute([(d, t) for d, t, _ in kept])
    kept = [(d, lines[d][0], s) for d, t, s in kept if not (lines[d][2] and not lines[d][0].replace("\n", " ").strip(" "))]
    component = _components([_reference(t) for _, t, _ in kept], lambda a, b: (a ^ b).bit_count() <= 3)
    ids = {}
    for (d, _, _), c in zip(kept, component):
        ids[c] = min(ids.get(c, d), d)
    kept = [k for k, c in zip(kept, component) if ids[c] == k[0]]
    bad = lambda t: any(len(_shingles(i) & _shingles(t)) >= 0.8 * len(_shingles(i)) for i in items if _shingles(i))
    return [k for k in kept if not bad(k[1])]


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(6)
    words = {"en": [f"the{i}" for i in range(300)], "de": [f"und{i}x" for i in range(300)]}
    text = lambda n, lang="en": " ".join(rng.choices(words[lang], k=n))
    letters = str.maketrans("0123456789", "abcdefghij")
    items = [text(30).translate(letters) for _ in range(4)]
    rows = []
    for d in range(90):
        lines = [text(rng.randint(5, 40), rng.choice(["en", "de"])).translate(letters) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.3 and rows:
            lines.append(rng.choice(rows)[1].split("\n")[0])
        if rng.random() < 0.1:
            lines.append(rng.choice(items))
        rows.append((d, "\n".join(lines), rng.choice(["a", "a", "b"])))
    rows += [(100, rows[3][1], "b"), (101, rows[5][1] + " tail", "a"), (102, None, "a"), (103, "123 !!", "b"), (104, "", "a")]
    rows += [(105, items[0], "a"), (106, text(400).translate(letters), "b")]
    rows.append((107, rows[-1][1].replace(" ", "  ", 1), "b"))
    docs = spark.createDataFrame(
        [(d, t, "en" if d % 2 else "de", s, len(t or ""), 1) for d, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, h int",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == docs.columns, name
    left = {r["doc_id"]: r["text"] for r in frame.collect()}
    want = _expected(rows, items)
    assert left == {d: t for d, t, _ in want} and 40 < len(left) < len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in frame.collect())
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in mixed} == set(left)
    plan = mixing.mix(frame).collect()
    assert {(r["doc_id"], r["slot"], r["place"]) for r in mixed} == {(r["doc_id"], r["slot"], r["place"]) for r in plan}


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_column_names(spark, tmp_path):
    """Columns called like those the stages use inside come through unchanged."""
    names = ["n_lines", "n_dropped", "row_hash", "gone", "row", "line_no", "fp", "component_id", "doc"]
    text = "eine Zeile, die es zweimal gibt, und noch ein paar Wörter dazu"
    rows = [(1, f"{text}\nanderes", "de", "a"), (2, f"{text}\nverschieden davon", "de", "a"), (None, None, None, None)]
    docs = spark.createDataFrame([(*r, 9, *range(9)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} int" for n in names))
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for stage in (corpus_pipeline.drop_repeated_lines, corpus_pipeline.drop_benchmark):
        docs = stage(spark, docs, str(tmp_path))
    got = {r["doc_id"]: r for r in docs.collect()}
    assert got[1]["text"] == f"{text}\nanderes" and got[2]["text"] == "verschieden davon" and got[None]["text"] is None
    assert all([r[n] for n in names] == list(range(9)) for r in got.values())
