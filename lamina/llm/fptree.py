"""Ranked lexical search with trees of documents.

A document is reduced to those of its terms that some item has, ordered by how many documents hold
them, the commonest first. In that order documents that share their common terms share a path of a
prefix tree. Every node knows, over the documents below it, the highest frequency of each term and the
lowest length norm m; an item's weights applied to these bound all scores below the node. For
each item the tree is searched depth first, the child of the highest bound before the others, and
children bounded below the tenth best score so far are left.

Each task builds trees of a bounded number of terms over its documents, one after the other, and carries
the best of every item from tree to tree; the tasks' best are merged at the end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lamina.llm.common import WORD_BYTES, map_slices, pa_schema, run_hashes, runs, text_chunks
from lamina.session import cut_lineage

BEST = 10
ITEM_TERMS = 50_000      # terms of items, with repeats in different items, that are searched in one pass
TREE_TERMS = 1_000_000   # restricted terms of the documents of one tree
TREE_CELLS = 32 << 20    # frequency maxima one tree may hold: nodes times terms
BUCKET = 32              # documents of a leaf at least, unless they share no longer path

_TOP, _LOWEST = np.int64(1_000_000_000), np.iinfo(np.int64).min


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of the texts, and the text it is in."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    ends_of = np.cumsum([len(t) + 1 for t in texts]) - 1
    s, e = runs(data, WORD_BYTES)
    return run_hashes(data, s, e), np.searchsorted(ends_of, s)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term): the distinct terms of each item, as hashes."""
    kind = items.schema[id_col].dataType.simpleString()

    def scan(batch: pa.RecordBatch):
        for first, texts in text_chunks(batch, "text"):
            found, text_of = terms(texts)
            yield batch.column(0).slice(first, len(texts)).take(pa.array(text_of)), found.view(np.int64)

    named = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    return map_slices(named, scan, f"item {kind}, term long").distinct()


def restricted(docs: DataFrame, known: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs): each document's number of terms, and the known ones among them, by their place
    in the sorted array ``known``, with their frequencies."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batch: pa.RecordBatch):
        for first, texts in text_chunks(batch, "text"):
            found, text_of = terms(texts)
            place = np.minimum(np.searchsorted(known, found), max(0, len(known) - 1))
            hit = known[place] == found if len(known) else np.zeros(len(found), bool)
            key, tf = np.unique(text_of[hit] * len(known) + place[hit], return_counts=True)
            offsets = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * len(known)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (key % max(1, len(known)), tf)]
            yield batch.column(0).slice(first, len(texts)), np.bincount(text_of, minlength=len(texts)), *lists

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_slices(named, scan, f"id {kind}, n long, terms array<int>, tfs array<int>")


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (_TOP * tf) // (1000 * tf + 8 * m)


class Tree:
    """A prefix tree over documents whose ranks ascend, cut off at buckets of documents.

    Node k has the children first[k]:last[k], or, where there are none, the documents low[k]:high[k] of the
    tree's order; ``tf`` and ``m`` bound the documents below it.
    """

    def __init__(self, sizes: np.ndarray, ranks: np.ndarray, tf: np.ndarray, m: np.ndarray, kinds: int):
        edges = np.concatenate([[0], np.cumsum(sizes)])
        data = ranks.astype(">u4").tobytes()
        keys = [data[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
        self.m = m[self.order]
        size = sizes[self.order]
        self.edges = np.concatenate([[0], np.cumsum(size)])
        self.own = np.repeat(np.arange(len(size)), size)  # the document of each entry
        at = np.arange(self.edges[-1]) + np.repeat(edges[self.order] - self.edges[:-1], size)
        self.rank, self.freq = ranks[at], tf[at]
        self.worth = saturation(self.freq, self.m[self.own])
        self._shape(self._shared([keys[k] for k in self.order]), max(BUCKET, 1 + 4 * len(size) * kinds // TREE_CELLS))
        self._bounds(kinds)

    @staticmethod
    def _shared(keys: list[bytes]) -> np.ndarray:
        """Ranks that each document has in common with the one before, from the first on."""
        out = np.zeros(len(keys), dtype=np.int64)
        for k in range(1, len(keys)):
            a, b = keys[k - 1], keys[k]
            n = min(len(a), len(b))
            if a[:n] == b[:n]:
                out[k] = n // 4
            else:
                unlike = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
                out[k] = int(unlike.argmax()) // 4
        return out

    def _shape(self, shared: np.ndarray, bucket: int) -> None:
        low, high, first, last = [0], [len(shared)], [0], [0]
        k = 0
        while k < len(low):
            a, b = low[k], high[k]
            if b - a > bucket:
                inner = shared[a + 1 : b]
                cuts = a + 1 + np.flatnonzero(inner == inner.min())
                first[k] = len(low)
                for x, y in self._joined(np.concatenate([[a], cuts, [b]]), bucket):
                    low.append(x)
                    high.append(y)
                    first.append(0)
                    last.append(0)
                last[k] = len(low)
            k += 1
        self.low, self.high, self.first, self.last = (np.array(x, dtype=np.int64) for x in (low, high, first, last))

    @staticmethod
    def _joined(cuts: np.ndarray, bucket: int):
        """Runs of documents; neighbours of few documents are put together up to ``bucket`` of them."""
        start = int(cuts[0])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - start > bucket and start < a:
                yield start, int(a)
                start = int(a)
        yield start, int(cuts[-1])

    def _bounds(self, kinds: int) -> None:
        self.tf = np.zeros((len(self.low), kinds), dtype=np.int32)
        self.least = np.zeros(len(self.low), dtype=np.int64)
        leaves = np.flatnonzero(self.first == self.last)
        leaf_of = np.zeros(len(self.m), dtype=np.int64)
        for k in leaves:
            leaf_of[self.low[k] : self.high[k]] = k
            self.least[k] = self.m[self.low[k] : self.high[k]].min()
        np.maximum.at(self.tf, (leaf_of[self.own], self.rank), self.freq)
        for k in np.flatnonzero(self.first < self.last)[::-1]:  # children come after their parent
            below = slice(self.first[k], self.last[k])
            self.tf[k], self.least[k] = self.tf[below].max(axis=0), self.least[below].min()

    def search(self, ranks: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: "Best") -> None:
        """Offers ``best`` every document that may be among the best; ``dense`` has the weight of each rank."""
        stack = [(0, np.iinfo(np.int64).max)]
        while stack:
            k, bound = stack.pop()
            if bound < best.least():
                continue
            a, b = self.first[k], self.last[k]
            if a == b:
                lo, hi = self.edges[self.low[k]], self.edges[self.high[k]]
                scores = np.zeros(self.high[k] - self.low[k], dtype=np.int64)
                np.add.at(scores, self.own[lo:hi] - self.low[k], dense[self.rank[lo:hi]] * self.worth[lo:hi])
                best.offer(scores, self.order[self.low[k] : self.high[k]])
                continue
            bounds = saturation(self.tf[a:b][:, ranks], self.least[a:b, None]) @ weights
            promising = np.flatnonzero(bounds >= best.least())
            promising = promising[np.argsort(bounds[promising], kind="stable")]  # the highest is popped first
            stack.extend(zip((a + promising).tolist(), bounds[promising].tolist()))


class Best:
    """The best documents of one item so far: highest score, then null id, then smallest id."""

    def __init__(self, n: int):
        self.n = n
        self.score, self.named, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def least(self) -> int:
        """Scores below this are of no use."""
        return max(1, int(self.score[-1])) if len(self.score) == self.n else 1

    def of(self, named: np.ndarray, ids: np.ndarray) -> "Best":
        self._source = named, ids
        return self

    def offer(self, scores: np.ndarray, places: np.ndarray) -> None:
        good = scores >= self.least()
        if not good.any():
            return
        named, ids = self._source
        score = np.concatenate([self.score, scores[good]])
        has = np.concatenate([self.named, named[places[good]]])
        own = np.concatenate([self.id, ids[places[good]]])
        top = np.lexsort((own, has, -score))[: self.n]
        self.score, self.named, self.id = score[top], has[top], own[top]


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def _search(vectors: DataFrame, asked: list[tuple[np.ndarray, np.ndarray]], kinds: int, docs: int, length: int, best_n: int) -> DataFrame:
    """(item, named, id, score): the best of each task. ``asked`` has ranks and weights for each item."""
    schema = "item int, named boolean, id long, score long"
    target = pa_schema(schema)

    def run(batches):
        best = [Best(best_n) for _ in asked]
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held)
            ids = table["id"].combine_chunks()
            named, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            lists = [table[c].combine_chunks() for c in ("ranks", "tfs")]
            sizes = lists[0].value_lengths().to_numpy().astype(np.int64)
            m = 100 - 90 + (90 * table["n"].to_numpy() * docs) // length
            tree = Tree(sizes, *[x.flatten().to_numpy() for x in lists], m, kinds)
            dense = np.zeros(kinds, dtype=np.int64)
            for (ranks, weights), own in zip(asked, best):
                dense[ranks] = weights
                tree.search(ranks, weights, dense, own.of(named, ids))
                dense[ranks] = 0

        for batch in batches:
            entries = batch.column("ranks").value_lengths().to_numpy(zero_copy_only=False)
            first = 0
            for cut in range(1, len(batch) + 1):
                size += int(entries[cut - 1])
                if size >= TREE_TERMS:
                    held.append(batch.slice(first, cut - first))
                    flush()
                    held, size, first = [], 0, cut
            if first < len(batch):
                held.append(batch.slice(first))
        if held:
            flush()
        for item, own in enumerate(best):
            n = len(own.score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, item, np.int32)), pa.array(own.named), pa.array(own.id), pa.array(own.score)], schema=target
            )

    return vectors.mapInArrow(run, schema)


def _one_pass(docs: DataFrame, pairs, id_col: str, text_col: str, best_n: int) -> DataFrame:
    """(item, id, score) for items given as rows (item number, term), which the driver holds."""
    known = np.unique(np.array([t for _, t in pairs], dtype=np.int64).view(np.uint64))
    vectors = cut_lineage(restricted(docs, known, id_col, text_col))
    whole = vectors.agg(F.sum(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = whole["docs"] or 0, whole["length"] or 0
    df = np.zeros(len(known), dtype=np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[row["t"]] = row["df"]  # at most as many rows as there are known terms
    order = np.argsort(-df, kind="stable")
    rank_of = np.empty_like(order)
    rank_of[order] = np.arange(len(order))
    weights = weight(n_docs, df)
    asked: dict[int, list[int]] = {}
    for item, term in pairs:
        asked.setdefault(item, []).append(int(np.searchsorted(known, np.uint64(term & (2**64 - 1)))))
    numbers = sorted(asked)
    own = [(rank_of[p], weights[p]) for p in (np.array(asked[i], dtype=np.int64) for i in numbers)]
    held = vectors.filter(F.size("terms") > 0)

    # Ranks ascend within a document, so that equal beginnings mean shared commonest terms.
    def ranked(batch: pa.RecordBatch):
        lists = [batch.column(batch.schema.names.index(c)) for c in ("terms", "tfs")]
        sizes = lists[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        rank = rank_of[lists[0].flatten().to_numpy()]
        by = np.lexsort((rank, row))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        moved = [pa.ListArray.from_arrays(offsets, pa.array(x[by].astype(np.int32))) for x in (rank, lists[1].flatten().to_numpy())]
        yield batch.column(0), batch.column(1), *moved

    kind = vectors.schema["id"].dataType.simpleString()
    paths = map_slices(held, ranked, f"id {kind}, n long, ranks array<int>, tfs array<int>")
    found = _search(paths, own, len(known), n_docs, max(1, length), best_n)
    place = F.array(*[F.lit(i) for i in numbers])[F.col("item")] if numbers else F.lit(None).cast("int")
    return cut_lineage(found.select(place.alias("number"), F.when(F.col("named"), F.col("id")).alias("id"), "score"))


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text", best_n: int = BEST,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best_n`` best documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z in
    lower case; a null text has none. An item's term t counts, once each, floor(1000 ln((2 N + 2) / (2 df +
    1))) times (1000000000 tf) div (1000 tf + 8 m), m = 100 - 90 + (90 n N) div L, where N documents have a
    term, L is the number of their terms and n that of the document. Equal scores go by ascending id, null
    first. Rows of items that share an id, null too, are one item with the terms of all. Repeated rows
    and ids of documents are ranked one by one. Empty tables, and items without a term of any
    document, give no rows. Columns other than those named are not read.
    """
    pairs = cut_lineage(item_terms(items, item_id, item_text))
    sizes = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    kind = pairs.schema["item"].dataType.simpleString()
    # Items get numbers, and neighbours are searched in one pass as far as their terms allow.
    rows, total, numbered = [], 0, []
    for number, row in enumerate(sizes.orderBy("item").toLocalIterator()):
        numbered.append((number, total // ITEM_TERMS, row["item"]))
        total += row["size"]
    blocks = (numbered[-1][1] + 1) if numbered else 0
    spark = docs.sparkSession
    names = spark.createDataFrame(numbered, f"number int, block int, own {kind}")
    result = spark.createDataFrame([], f"number int, id {docs.schema[doc_id].dataType.simpleString()}, score long")
    for block in range(blocks):
        some = pairs.join(F.broadcast(names.filter(F.col("block") == block)), F.col("item").eqNullSafe(F.col("own")))
        rows = [(r["number"], r["term"]) for r in some.select("number", "term").collect()]  # about ITEM_TERMS
        result = result.union(_one_pass(docs, rows, doc_id, doc_text, best_n))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    best = result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best_n)
    return best.join(names, "number").select(
        F.col("own").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score"
    )


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def search_sql(docs: str, items: str, best_n: int = BEST) -> str:
    """DuckDB SQL for ``search`` with the columns doc_id, item_id and text."""
    words = f"regexp_extract_all({_LOWERED}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
WITH t AS (SELECT doc_id, unnest({words}) AS term FROM {docs}),
q AS (SELECT DISTINCT item_id, unnest({words}) AS term FROM {items}),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM n),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, whole GROUP BY term),
s AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length)) AS part
  FROM f JOIN n USING (doc_id), whole
),
r AS (SELECT item_id, doc_id, sum(w * part)::BIGINT AS score FROM q JOIN w USING (term) JOIN s USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= {best_n}
"""
