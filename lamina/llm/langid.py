"""Language of a text by unigram pieces, summed over all segmentations.

Each language gives a probability to every piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces (forward algorithm); a text's is the
product over its words. The piece probabilities are learned by expectation maximisation.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from lamina.llm.common import map_slices

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
TRAIN_ROWS = 1500    # documents per language the model is fitted on: the bound of what is collected
ROUNDS = 3           # of expectation maximisation
MAX_RUN = 32         # longer words are scored as consecutive runs of this many letters
UNKNOWN = 1e-6       # probability of a letter that is not a piece
SMOOTHING = 0.01     # expected count every piece has beforehand, in each language
WORD_CACHE = 200_000
UNDETERMINED = "und"

_MARK = "▁"
_WORD = re.compile(r"[^\W\d_]+")  # letters, but for numerals such as ½ or ②, which str.isalpha tells
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """The words of a text with the mark of a beginning word, long ones cut into runs."""
    out = []
    for found in _WORD.findall((text or "").lower()):
        for w in [found] if found.isalpha() else "".join(c if c.isalpha() else " " for c in found).split():
            if len(w) <= MAX_RUN:
                out.append(_MARK + w)
            else:
                out.extend(_MARK + w[i : i + MAX_RUN] for i in range(0, len(w), MAX_RUN))
    return out


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """Distinct lower-case pieces made of letters, with or without the mark before them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    low = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in low if p.removeprefix(_MARK).isalpha() or p == _MARK)


def _codes(same_length: list[str]) -> np.ndarray:
    raw = "".join(same_length).encode("utf-32-le")
    return np.frombuffer(raw, dtype=np.uint32).reshape(len(same_length), -1).astype(np.uint64)


def _hashes(pieces: list[str]) -> np.ndarray:
    out = np.zeros(len(pieces), dtype=np.uint64)
    for i, p in enumerate(pieces):
        h = 0
        for c in p:
            h = (h * int(_STEP) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        out[i] = h
    return out


class PieceModel:
    """Piece probabilities of several languages; ``share`` is (pieces + 1, languages), its last row
    the letter outside the vocabulary."""

    def __init__(self, pieces: list[str], languages: list[str], share: np.ndarray | None = None):
        hashes = _hashes(pieces)
        order = np.argsort(hashes)
        self.hashes, self.languages = hashes[order], languages
        self.longest = max(map(len, pieces), default=1)
        if share is None:
            share = np.full((len(pieces) + 1, len(languages)), 1.0 / max(1, len(pieces)))
            share[-1] = UNKNOWN
        self.share = share

    def _lookup(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)

    def lattice(self, codes: np.ndarray):
        """(start, end, word rows, piece) of all pieces in words of one length; single letters
        outside the vocabulary come as the unknown piece."""
        n = codes.shape[1]
        for i in range(n):
            h = np.zeros(len(codes), dtype=np.uint64)
            for j in range(i, min(n, i + self.longest)):
                h = h * _STEP + codes[:, j] + np.uint64(1)
                piece = self._lookup(h)
                if j == i:
                    piece = np.where(piece < 0, len(self.hashes), piece)
                rows = np.flatnonzero(piece >= 0)
                if len(rows):
                    yield i, j + 1, rows, piece[rows]

    def log_likelihoods(self, some_words: list[str]) -> np.ndarray:
        """(words, languages): log of the sum over all segmentations."""
        out = np.zeros((len(some_words), len(self.languages)))
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(some_words):
            by_length.setdefault(len(w), []).append(k)
        for n, ids in by_length.items():
            codes = _codes([some_words[k] for k in ids])
            forward = np.zeros((n + 1, len(ids), len(self.languages)))
            forward[0] = 1.0
            for i, j, rows, piece in self.lattice(codes):
                forward[j, rows] += forward[i, rows] * self.share[piece]
            out[ids] = np.log(forward[n])
        return out

    def expected(self, some_words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected piece counts, given how often each word stands in each language."""
        total = np.zeros_like(self.share)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(some_words):
            by_length.setdefault(len(w), []).append(k)
        for n, ids in by_length.items():
            for part in range(0, len(ids), 20_000):
                own = ids[part : part + 20_000]
                steps = list(self.lattice(_codes([some_words[k] for k in own])))
                forward = np.zeros((n + 1, len(own), len(self.languages)))
                backward = np.zeros_like(forward)
                forward[0] = backward[n] = 1.0
                for i, j, rows, piece in steps:
                    forward[j, rows] += forward[i, rows] * self.share[piece]
                for i, j, rows, piece in reversed(steps):
                    backward[i, rows] += backward[j, rows] * self.share[piece]
                weight = counts[own] / forward[n]
                for i, j, rows, piece in steps:
                    gain = forward[i, rows] * self.share[piece] * backward[j, rows] * weight[rows]
                    for k in range(len(self.languages)):
                        total[:, k] += np.bincount(piece, gain[:, k], len(total))
        return total


def fit_pieces(word_counts: dict[str, Counter], path: str = VOCABULARY, rounds: int = ROUNDS) -> PieceModel:
    """Expectation maximisation over word counts by language."""
    languages = sorted(word_counts)
    model = PieceModel(load_pieces(path), languages)
    vocabulary = sorted(set().union(*word_counts.values())) if languages else []
    if not vocabulary:
        return model
    counts = np.array([[word_counts[x].get(w, 0) for x in languages] for w in vocabulary], dtype=float)
    for _ in range(rounds):
        expected = model.expected(vocabulary, counts)[:-1] + SMOOTHING
        model.share[:-1] = expected / expected.sum(axis=0) * (1 - UNKNOWN)
    return model


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    rows_per_language: int = TRAIN_ROWS,
    vocabulary: str = VOCABULARY,
) -> PieceModel:
    """A model of at most ``rows_per_language`` labelled documents of each language, those whose
    ids have the smallest hashes. Words are counted by Spark; the driver gets counts of that
    sample only. Rows with a null text or language are left out."""
    labelled = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("text is not null and lang is not null")
    sample = labelled.select("id", "lang", F.pmod(F.hash("id"), F.lit(64)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):  # in parts first: one language may have most rows
        first = Window.partitionBy(*keys).orderBy(F.xxhash64("id"), "id")
        sample = sample.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= rows_per_language)
    chosen = labelled.join(F.broadcast(sample.select("id", "lang").distinct()), ["id", "lang"])

    def count(batch):
        found: dict[str, Counter] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(lang, Counter()).update(words(text))
        rows = [(lang, w, n) for lang, c in found.items() for w, n in c.items()]
        if rows:
            yield tuple(zip(*rows))

    counted = map_slices(chosen.select("text", "lang"), count, "lang string, word string, n long")
    totals: dict[str, Counter] = {}
    for r in counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator():
        totals.setdefault(r["lang"], Counter())[r["word"]] = r["n"]
    return fit_pieces(totals, vocabulary)


def predict_texts(model: PieceModel, texts: list[str | None], cache: dict[str, int], known: list) -> list[tuple]:
    """(language, score) for each text; ``cache`` and ``known`` carry word scores along."""
    counted = [Counter(words(t)) for t in texts]
    if len(cache) > WORD_CACHE:
        cache.clear()
        known.clear()
    new = sorted({w for c in counted for w in c if w not in cache})
    if new:
        base = len(cache)
        for part in range(0, len(new), 20_000):
            known.append(model.log_likelihoods(new[part : part + 20_000]))
        cache.update((w, base + k) for k, w in enumerate(new))
    scores = np.concatenate(known) if known else np.zeros((0, len(model.languages)))
    known[:] = [scores]
    out = []
    for c in counted:
        if not c or not model.languages:
            out.append((UNDETERMINED, 0.0))
            continue
        ids = np.fromiter((cache[w] for w in c), np.int64, len(c))
        total = np.fromiter(c.values(), float, len(c)) @ scores[ids]
        best = int(np.argmax(total))
        out.append((model.languages[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())))
    return out


def identify(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score``, the language's posterior probability
    under equal priors (ties go to the alphabetically first).

    A text that is null or has no letters is ``und`` with score 0. Whole texts are read, repeated
    rows give repeated results, other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    cache: dict[str, int] = {}
    known: list = []

    def scan(batch):
        if len(batch):
            found = predict_texts(model, batch.column(1).to_pylist(), cache, known)
            yield batch.column(0), *zip(*found)

    out = map_slices(docs.select(id_col, text_col), scan, f"id {id_type}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
