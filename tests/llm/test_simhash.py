"""SimHash components against brute force over all pairs."""

import random

import pytest
import xxhash

from lamina.llm import simhash


def _reference(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(values, near):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", "  ", "One", "A b", "A b c", "Äh Ü x y z " * 50, "a\x1cb\x0bc d"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) % 2**64 == _reference(text)


def test_links_join_all_within_three_bits(spark):
    rng = random.Random(5)
    values = set()
    for _ in range(12):  # families that spread over few bits, over one group, and anywhere
        centre = rng.getrandbits(64)
        places = rng.choice([rng.sample(range(64), 9), list(range(16, 32)), list(range(64)), [0, 1, 2, 3, 4, 5]])
        for _ in range(25):
            values.add(centre ^ sum(1 << b for b in rng.sample(places, rng.randint(0, 5))))
    values |= {0, (1 << 64) - 1, 7}
    values = sorted(values)
    want = _components(values, lambda a, b: (a ^ b).bit_count() <= 3)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    links = [(a % 2**64, b % 2**64) for a, b in simhash.links(fps).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    joined = {frozenset(x) for x in links}
    place = {v: i for i, v in enumerate(values)}
    got = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for a, b in joined:
            low = min(got[place[a]], got[place[b]])
            if got[place[a]] != low or got[place[b]] != low:
                got[place[a]] = got[place[b]] = low
                changed = True
    assert got == want


def test_near_duplicates(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [
        (9, long, 1), (3, long, 1), (4, long.replace("w200", "x"), 1), (7, None, 1), (8, "", 1),
        (1, "quite another text of its own", 1), (1, "quite another text of its own", 1), (None, long, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = [_reference(t) for _, t, _ in rows]
    comp = _components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    want = []
    for i, (d, _, _) in enumerate(rows):
        ids = [r[0] for r, c in zip(rows, comp) if c == comp[i] and r[0] is not None]
        want.append((str(d), f"{fps[i]:016x}", min(ids)))
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted(want)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
