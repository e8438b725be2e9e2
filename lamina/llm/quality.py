"""Quality score by an additive model with pairwise interactions.

Every feature is cut into bins. Boosting visits the features in turn, each time fitting a shallow
tree of that feature alone to what the model still misses and adding it, shrunk, to the feature's
lookup table; then pairs of features get tables the same way. A score is a sum of table entries.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lamina.llm.common import TOKEN_BYTES, class_table, map_batches, mix64, run_hashes, runs, text_chunks

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "letters", "digits", "capitals",
    "marks", "odd_marks", "lines_per_word", "distinct_words", "top_word", "distinct_triples",
    "distinct_lines", "top_line", "short_words", "sentence_ends", "longest_line",
)
TRAIN_ROWS = 12_000  # labelled documents the model is fitted on: the bound of what is collected
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 12
RATE, LEAVES, LEAST = 0.1, 3, 20
THRESHOLD = 0.3

_LETTER = class_table(set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100)))
_DIGIT = class_table(set(range(0x30, 0x3A)))
_UPPER = class_table(set(range(0x41, 0x5B)))
_END = class_table(set(b".!?"))
_COMMON_MARK = class_table(set(b".,;:'\"-()"))
_SPACE = ~TOKEN_BYTES
_LINE = class_table(set(range(256)) - {0x0A, 0x00})


def _sums(mask: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[highs] - total[lows]).astype(float)


def _distinct(group: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per group: members, distinct members, and how often the most frequent one comes."""
    key = np.sort((group.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    owner = (key[first] >> np.uint64(44)).astype(np.int64)
    times = np.diff(np.append(first, len(key)))
    top = np.zeros(n)
    np.maximum.at(top, owner, times)
    return np.bincount(group, minlength=n).astype(float), np.bincount(owner, minlength=n).astype(float), top


def features(texts: list[bytes]) -> np.ndarray:
    """(texts, FEATURES) from whole texts; an empty text has zeros."""
    n = len(texts)
    data = np.frombuffer(b"\x00".join(texts) + b"\x00", dtype=np.uint8)
    highs = np.cumsum([len(t) + 1 for t in texts]) - 1
    lows = np.concatenate([[0], highs[:-1] + 1])
    size = (highs - lows).astype(float)
    inside = TOKEN_BYTES.copy()
    inside[0] = False
    s, e = runs(data, inside)
    word_of = np.searchsorted(highs, s)
    length = (e - s).astype(float)
    hashes = run_hashes(data, s, e)
    words, kinds, top = _distinct(word_of, hashes, n)
    some, w = np.maximum(size, 1), np.maximum(words, 1)
    mean = np.bincount(word_of, length, n) / w
    spread = np.sqrt(np.maximum(np.bincount(word_of, length**2, n) / w - mean**2, 0))
    same = np.flatnonzero(word_of[2:] == word_of[:-2]) if len(s) > 2 else np.zeros(0, int)
    triple = mix64(hashes[same] * np.uint64(3) + hashes[same + 1] * np.uint64(5) + hashes[same + 2] * np.uint64(7))
    triples, triple_kinds, _ = _distinct(word_of[same], triple, n)
    ls, le = runs(data, _LINE)
    line_of = np.searchsorted(highs, ls)
    lines, line_kinds, top_line = _distinct(line_of, run_hashes(data, ls, le), n)
    longest = np.zeros(n)
    np.maximum.at(longest, line_of, (le - ls).astype(float))
    letters = _sums(_LETTER[data], lows, highs)
    digits = _sums(_DIGIT[data], lows, highs)
    spaces = _sums(_SPACE[data], lows, highs)
    common = _sums(_COMMON_MARK[data], lows, highs)
    ends = _sums(_END[data], lows, highs)
    odd = np.maximum(size - letters - digits - spaces - common, 0)
    return np.column_stack([
        np.log1p(size), np.log1p(words), mean, spread, letters / some, digits / some,
        _sums(_UPPER[data], lows, highs) / np.maximum(letters, 1), (common + odd) / some, odd / some,
        lines / w, kinds / w, top / w, np.where(triples > 0, triple_kinds / np.maximum(triples, 1), 1.0),
        np.where(lines > 0, line_kinds / np.maximum(lines, 1), 1.0), top_line / np.maximum(lines, 1),
        np.bincount(word_of, length <= 3, n) / w, ends / w, np.log1p(longest),
    ])


class AdditiveModel:
    """Lookup tables of single features and of pairs; ``score`` adds them up."""

    def __init__(self, n_features: int, intercept: float):
        self.intercept = intercept
        self.cuts = [np.zeros(0) for _ in range(n_features)]
        self.tables = [np.zeros(1) for _ in range(n_features)]
        self.pair_cuts = [np.zeros(0) for _ in range(n_features)]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (a, b), table in self.pairs.items():
            total += table[
                np.searchsorted(self.pair_cuts[a], x[:, a], side="right"),
                np.searchsorted(self.pair_cuts[b], x[:, b], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _step(gain: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gain / (weight + 1.0)


def _tree(gain: np.ndarray, weight: np.ndarray, rows: np.ndarray, leaves: int) -> np.ndarray:
    """One value per bin: a regression tree with few leaves, grown best split first."""
    g, w, r = (np.concatenate([[0.0], np.cumsum(v)]) for v in (gain, weight, rows))
    parts = [(0, len(gain))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            m = np.arange(a + 1, b)
            m = m[(r[m] - r[a] >= LEAST) & (r[b] - r[m] >= LEAST)]
            if len(m):
                better = (
                    (g[m] - g[a]) ** 2 / (w[m] - w[a] + 1) + (g[b] - g[m]) ** 2 / (w[b] - w[m] + 1)
                    - (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1)
                )
                k = int(np.argmax(better))
                if better[k] > best[0]:
                    best = (float(better[k]), (a, b), int(m[k]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gain))
    for a, b in parts:
        out[a:b] = _step(g[b] - g[a], w[b] - w[a])
    return out


def _pair_tree(gain: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a grid cut once along each of its two axes, and what the cut gains."""
    best = (np.zeros_like(gain), 0.0)
    for i in range(1, gain.shape[0]):
        for j in range(1, gain.shape[1]):
            out, won = np.zeros_like(gain), 0.0
            for rows in (slice(0, i), slice(i, None)):
                for cols in (slice(0, j), slice(j, None)):
                    g, w = gain[rows, cols].sum(), weight[rows, cols].sum()
                    out[rows, cols] = _step(g, w)
                    won += g * g / (w + 1)
            if won > best[1]:
                best = (out, won)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Boosts main effects cyclically, then the pairs that promise most; without labels of both
    kinds the model is a constant."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    model = AdditiveModel(x.shape[1] if x.ndim == 2 else len(FEATURES), float(np.log(rate / (1 - rate))))
    if len(y) < 2 * LEAST or y.min() == y.max():
        return model
    total = np.full(len(y), model.intercept)
    bins = []
    for j in range(x.shape[1]):
        model.cuts[j] = _cuts(x[:, j], BINS)
        model.pair_cuts[j] = _cuts(x[:, j], PAIR_BINS)
        model.tables[j] = np.zeros(len(model.cuts[j]) + 1)
        bins.append(np.searchsorted(model.cuts[j], x[:, j], side="right"))
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[j])
            add = RATE * _tree(
                np.bincount(b, y - p, size), np.bincount(b, p * (1 - p), size), rows[j], LEAVES
            )
            model.tables[j] += add
            total += add[b]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    sizes = [len(c) + 1 for c in model.pair_cuts]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        at = coarse[a] * sizes[b] + coarse[b]
        return np.bincount(at, values, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    p = 1 / (1 + np.exp(-total))
    promise = {
        (a, b): _pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)))[1]
        for a in range(len(sizes)) for b in range(a + 1, len(sizes))
    }
    chosen = sorted(promise, key=lambda k: (-promise[k], k))[:PAIRS]
    model.pairs = {k: np.zeros((sizes[k[0]], sizes[k[1]])) for k in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            p = 1 / (1 + np.exp(-total))
            add = RATE * _pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)))[0]
            model.pairs[a, b] += add
            total += add[coarse[a], coarse[b]]
    return model


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", max_rows: int = TRAIN_ROWS,
) -> AdditiveModel:
    """A model of at most ``max_rows`` labelled documents, those whose ids have the smallest hashes.

    Spark computes the features; the driver gets one row of numbers for each of these documents.
    An id with several labels counts once, with the largest; null labels and ids are left out.
    """
    sample = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
        .filter("id is not null and y is not null")
        .groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    labelled = texts.join(F.broadcast(sample), "id").select("y", "text")

    def scan(batch):
        for first, some in text_chunks(batch, "text"):
            yield batch.column(0).slice(first, len(some)), list(features(some))

    rows = map_batches(labelled, scan, "y int, x array<double>").collect()
    rows.sort(key=lambda r: (r["y"], r["x"]))
    if not rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], dtype=float))


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD on).

    A null text is the empty text, whose features are zero; repeated rows give repeated results,
    other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batch):
        for first, some in text_chunks(batch, batch.schema.names[1]):
            yield batch.column(0).slice(first, len(some)), model.score(features(some))

    out = map_batches(docs.select(id_col, text_col), scan, f"id {id_type}, score double")
    return out.withColumnRenamed("id", id_col).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
