"""Packing: ids against the tokenizer itself, pieces and sequences by round trip, plans against bounds."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from lamina.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a  b", "a \n b", "\n\nx", "x\t y", "  lead", "trail  ", "<|endoftext|> hi", "it's we'll 'sabc 's", "a  b",
    "a　 b", "\x1c b\x1c", "᠎ x", "１２ ３", "  a", "a\u0085 b", "don't  'll", "ab.\nCd", "ab\nCd,", "é.\n\nf", "a,\n b",
    "a.b,c!?d", "Ñ. a", "x\n", "a.\n", "漢字。かな、 カナ", "😀 😀😀.", "ﬁ ½² x²", "a\r\nb", "​ z", "Éa,É", "a_b. c", "x,y\n\tz",
]


def _tokenizer():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


def test_ids_are_those_of_the_whole_text(monkeypatch):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choices("ab .,!'\n\t Ñé9½漢。 _-", k=rng.randint(1, 60))) for _ in range(3000)]
    whole = _tokenizer()
    for limit in (packing.LONG_CHUNK, 5):
        monkeypatch.setattr(packing, "LONG_CHUNK", limit)
        for cached in (packing.CACHED_CHUNKS, 10):
            monkeypatch.setattr(packing, "CACHED_CHUNKS", cached)
            ids = packing.TokenIds(PATH)
            for text in texts:
                got = ids.of(text)
                assert np.frombuffer(got, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def _check(rows, packed, capacity):
    whole = _tokenizer()
    documents, places = {}, {}
    for r in packed:
        documents.setdefault(r["doc_id"], {}).setdefault(r["piece"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, text in set(rows):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        data = np.array(ids, dtype="<u4").tobytes()
        pieces = documents[doc]
        if len(ids) <= capacity:
            assert set(pieces) == {0}
        start = 0
        for n in range(len(pieces)):
            for p in pieces[n]:
                assert p["start"] == start and (n == 0 or p["length"] == capacity) and 0 < p["length"] <= capacity
                assert p["ids_crc32"] == zlib.crc32(data[4 * start : 4 * (start + p["length"])])
            start += pieces[n][0]["length"]
        assert start == len(ids)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("rank_rows", [100_000, 7])
def test_round_trip(spark, monkeypatch, rank_rows):
    monkeypatch.setattr(packing, "RANK_ROWS", rank_rows)
    rng = random.Random(5)
    rows = [(d, " ".join(rng.choices(["alpha", "beta", "gamma,", "d."], k=rng.choice([1, 3, 8, 20, 40, 200])))) for d in range(300)]
    rows += [(d, t) for d, t in enumerate(ODD, 1000)] + [(2000, None), (2001, "x" * 5000), (2002, " ".join(["word"] * 30_000))]
    rows += [(None, "no id"), (5000, "copy"), (5000, "copy")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, rank int, length string")
    packed = packing.pack(df, PATH, capacity=64).collect()
    total = sum(r["length"] for r in packed)
    assert len([r for r in packed if r["doc_id"] == 5000]) == 2
    assert _check(rows, packed, 64) <= 1.03 * total / 64 + 1


def test_sequences_hold_the_ids(spark):
    rows = [(d, " ".join(["word"] * (7 * d % 50))) for d in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack(df, PATH, capacity=32, keep_ids=True)
    held = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    whole, n = _tokenizer(), 0
    documents = {}
    for r in packed.collect():
        documents.setdefault(r["doc_id"], []).append((r["start"], held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]))
        n += r["length"]
    for d, text in rows:
        assert sum((ids for _, ids in sorted(documents[d])), []) == whole.encode(text, add_special_tokens=False).ids + [2]
    assert sum(map(len, held.values())) == n


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def _sequences(counts):
    out = packing.combinations(counts)
    used = np.zeros_like(counts)
    for lengths, times in out:
        assert sum(lengths) < len(counts) and times > 0
        for x in lengths:
            used[x] += times
    assert (used == counts).all()
    return sum(times for _, times in out), len(out)


def test_plans():
    rng = np.random.default_rng(3)
    for capacity in (1, 2, 7, 16, 100):
        for scale in (1, 5, 1_000_000):
            counts = rng.integers(0, 5, capacity + 1) * scale
            counts[0] = 0
            n, kinds = _sequences(counts)
            least = max(-(-(counts * np.arange(capacity + 1)).sum() // capacity), counts[capacity // 2 + 1 :].sum())
            assert least <= n <= 1.25 * least + 2 and kinds <= 6 * capacity
    exact = np.zeros(101, dtype=np.int64)
    exact[[60, 25, 10, 5, 50]] = [4, 4, 4, 4, 2]
    assert _sequences(exact)[0] == 5  # 60 + 25 + 10 + 5 four times, 50 + 50 once
    exact = np.zeros(11, dtype=np.int64)
    exact[[4, 3]] = [2, 4]
    assert _sequences(exact)[0] == 2  # 4 + 3 + 3 twice


def test_combinations_against_exhaustive_search():
    """Every exact single, pair and triple that is there is found."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        counts = rng.integers(0, 3, 21) * (rng.random(21) < 0.4)
        counts[0] = 0
        index = packing.SumIndex(counts)
        for opened in np.flatnonzero(counts):
            left = counts.copy()
            left[opened] -= 1
            items = [int(x) for x in np.repeat(np.arange(21), left)]
            gap = 20 - int(opened)
            there = gap == 0 or gap in items
            there |= any(a + b == gap for i, a in enumerate(items) for b in items[i + 1 :])
            there |= any(a + b + c == gap for i, a in enumerate(items) for j, b in enumerate(items[i + 1 :], i + 1) for c in items[j + 1 :])
            found = index.filling(int(opened))
            assert (found is not None) == there
            assert not found or (sum(found) == gap and all(items.count(x) >= found.count(x) for x in found))
