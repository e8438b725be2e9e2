"""Line deduplication against brute force over all pairs of lines."""

import random

from lamina.llm import linededup
from lamina.session import StepFolder  # noqa: F401


def _shingles(line):
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def _brute(rows, similarity=0.8, min_chars=1):
    lines = []
    for d, text in rows:
        for n, raw in enumerate(text.split("\n") if text is not None else []):
            line = raw.strip(" ").lower()
            if len(line) >= min_chars:
                lines.append((d, n, line))
    parent = list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, _, a) in enumerate(lines):
        for j in range(i):
            sa, sb = _shingles(a), _shingles(lines[j][2])
            if len(sa & sb) >= similarity * len(sa | sb):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    first = {}
    for i, (d, n, _) in enumerate(lines):
        first[root(i)] = min(first.get(root(i), (d, n)), (d, n))
    gone = {(d, n) for i, (d, n, _) in enumerate(lines) if first[root(i)] != (d, n)}
    out = {}
    for d, text in rows:
        parts = text.split("\n") if text is not None else []
        kept = [p for n, p in enumerate(parts) if (d, n) not in gone]
        out[d] = (None if text is None else "\n".join(kept), len(parts), len(parts) - len(kept))
    return out


def _check(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, h int, line_no int")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in linededup.dedup_lines(docs).collect()}
    assert got == _brute(rows)


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"{rng.choice('abcdefgh')}{rng.choice('xyz')}word{i}" for i in range(150)]
    base = [[rng.choice(words) for _ in range(rng.randint(5, 60))] for _ in range(25)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 3])):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line).capitalize())
        rows.append((d, "\n".join(lines)))
    _check(spark, rows)


def test_edges(spark):
    long = " ".join(f"token{i}" for i in range(20_000))
    rows = [
        (5, None), (4, ""), (3, "\n\nshort\nshort\n"), (2, "The same line of some length\n" * 3),
        (1, "  THE SAME line of some length  \nanother one, unlike the first line"), (6, long), (7, long + " end"),
        (8, "漢字" * 30), (9, "漢字" * 30 + "字"),
    ]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, h int, line_no int")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in linededup.dedup_lines(docs).collect()}
    assert got[5] == (None, 0, 0) and got[4] == ("", 1, 0) and got[3] == ("\n\nshort\n", 5, 1)
    assert got[2] == ("", 4, 3) and got[1][2] == 0 and got[6][2] == 0 and got[7] == ("", 1, 1)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(None, "one line that is long enough"), (1, "one line that is long enough"), (1, "one line that is long enough"),
            (1, "a quite different line under the same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["text"], r["n_dropped"]) for r in linededup.dedup_lines(docs).collect())
    assert got == [("1", "", 1), ("1", "", 1), ("1", "a quite different line under the same id", 0),
                   ("None", "one line that is long enough", 0)]
