"""Line deduplication against brute force over character shingles, written without the operator's."""

import random

from lamina.llm import linededup


def _grams(line):
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def _similar(a, b):
    return len(_grams(a) & _grams(b)) >= 0.8 * len(_grams(a) | _grams(b))


def _dropped(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return {r["doc_id"] for r in linededup.dedup_lines(docs).filter("n_dropped > 0").collect()}


def test_one_changed_letter(spark):
    rng = random.Random(8)
    lines = []
    for _ in range(150):
        line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz     ", k=rng.randint(55, 160))).replace(" ", "x", 1)
        line = "q" + line[1:-1] + "q"
        at = rng.randrange(len(line))
        lines += [line, line[:at] + ("0" if line[at] != " " else "1") + line[at + 1 :]]
    want = {i for i in range(1, len(lines), 2) if _similar(lines[i - 1], lines[i])}
    assert len(want) > 140 and _dropped(spark, lines) == want


def test_other_scripts(spark):
    rng = random.Random(9)
    lines = []
    for low, high in ((0x0E01, 0x0E2E), (0x0E81, 0x0E82), (0x1780, 0x17A2), (0x4E00, 0x4F00), (0x1F600, 0x1F640)):
        line = "".join(chr(rng.randint(low, high)) + rng.choice(["", "ab"]) for _ in range(90))
        lines += [line, line[:40] + "z" + line[41:]]
    want = {i for i in range(1, len(lines), 2) if _similar(lines[i - 1], lines[i])}
    assert want == {1, 3, 5, 7, 9} and _dropped(spark, lines) == want


def test_large_buckets(spark, monkeypatch):
    """Buckets of more than PAIRED lines meet by rare shingles, with the same result."""
    rng = random.Random(10)
    base = ["".join(rng.choices("abcdefgh", k=80)) for _ in range(6)]
    lines = []
    for line in base:
        for _ in range(12):
            at = rng.randrange(80 - 20)
            lines.append(line[:at] + "".join(rng.choices("xyz", k=rng.choice([1, 2, 10]))) + line[at + 3 :])
    first = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if _similar(lines[i], lines[j]) and first[i] != first[j]:
                low, high = sorted((first[i], first[j]))
                first = [low if f == high else f for f in first]
    want = {i for i, f in enumerate(first) if f != i}
    for paired in (256, 1):
        monkeypatch.setattr(linededup, "PAIRED", paired)
        assert _dropped(spark, lines) == want


def test_unrelated_long_lines_are_told_by_bitmaps(spark, monkeypatch):
    """Long lines of few syllables share buckets by chance; hardly any pair's texts are compared."""
    rng = random.Random(11)
    syllables = ["ba", "den", "ko", "lir", "mu", "sta", "ve", "zon"]
    lines = ["".join(rng.choices(syllables, k=400)) for _ in range(40)]
    lines.append(lines[7][:300] + "q" + lines[7][301:])
    compared, verified = [], linededup._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(linededup, "_verified", counted)
    assert _dropped(spark, lines) == {40} and sum(compared) < 20


def test_texts_are_read_for_likely_pairs_only(spark, monkeypatch):
    """Lines that share a bucket, but are told apart by their bitmaps, are not shuffled or written again."""
    rng = random.Random(12)
    lines = []
    for _ in range(40):
        line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60))
        lines += [line, line[:20] + "0" + line[21:40] + "1" + line[41:]]
    assert not any(_similar(lines[i], lines[i + 1]) for i in range(0, 80, 2))
    lines += [lines[0][:30] + "2" + lines[0][31:]]
    asked, texts = [], linededup._texts

    def counted(all_lines, wanted):
        asked.append(wanted.count())
        return texts(all_lines, wanted)

    monkeypatch.setattr(linededup, "_texts", counted)
    assert _dropped(spark, lines) == {80} and 2 <= sum(asked) <= 8


def test_near_misses_of_a_family_are_told_by_bitmaps(spark, monkeypatch):
    """Copies of one line that differ too much to be linked share buckets; few of their pairs reach the texts."""
    rng = random.Random(13)
    base = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=420))
    lines = []
    for _ in range(40):
        at = rng.randrange(len(base) - 30)
        lines.append(base[:at] + "".join(rng.choices("0123456789", k=30)) + base[at + 30 :])
    alike = [(i, j) for i in range(40) for j in range(i) if _similar(lines[i], lines[j])]
    compared, verified = [], linededup._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(linededup, "_verified", counted)
    assert _dropped(spark, lines) <= {i for pair in alike for i in pair}
    assert sum(compared) < 780 / 4
