"""Nearest neighbours by inner product: inverted lists scanned in column blocks, with early abandoning.

Vectors are dealt to the list of their nearest centroid. A query probes the lists whose centroids
are nearest to it. Within a list, vectors and queries are turned by one random rotation, so that a few
columns estimate a whole distance. Columns are read block by block; after each, a hypothesis test
drops every candidate whose partial distance makes it improbable to reach the query's threshold.
Survivors get their exact inner product from the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lamina.llm.common import map_batches
from lamina.session import cut_lineage

NEIGHBOURS = 20
SAMPLE_ROWS = 4096       # vectors that centroids, probes and first thresholds are fitted on
SAMPLE_VALUES = 4 << 20  # and the most numbers they may hold together
TARGET_RECALL = 0.95     # of the probes, measured on the sample
CONFIDENCE = 2.1         # of the test: larger drops less
COLUMN_BLOCKS = 4
VECTOR_BLOCK, QUERY_BLOCK = 2048, 1024  # most vectors and queries that meet in one group
PAIRS_AT_ONCE = 1 << 17
SEED = 20


@dataclass
class Index:
    """What is fitted on the sample: centroids, probes per query, and the sample itself."""

    ids: np.ndarray
    sample: np.ndarray
    centroids: np.ndarray
    probes: int

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector: smallest distance to its centroid."""
        return np.argmax(x @ self.centroids.T - 0.5 * (self.centroids**2).sum(axis=1), axis=1)


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision; equal rows give equal results."""
    return (a.astype(np.float64) * b.astype(np.float64)).sum(axis=1)


def fit(ids: np.ndarray, sample: np.ndarray, rows: int, neighbours: int = NEIGHBOURS) -> Index:
    """Centroids by Lloyd's iterations, and as many probes as reach TARGET_RECALL on the sample."""
    rng = np.random.default_rng(SEED)
    count = int(max(1, min(len(sample) // 8, np.sqrt(rows) / 4)))
    centroids = sample[rng.choice(len(sample), count, replace=False)].astype(np.float64)
    index = Index(ids, sample, centroids, count)
    for _ in range(12):
        own = index.lists(sample)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        sizes = np.bincount(own, minlength=count)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
    own = index.lists(sample)
    some = rng.choice(len(sample), min(256, len(sample)), replace=False)
    scores = sample[some].astype(np.float64) @ sample.T
    scores[np.arange(len(some)), some] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(neighbours, len(sample) - 1)]
    order = np.argsort(-(sample[some] @ centroids.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(count)[None, :], axis=1)
    if near.size:
        needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
        index.probes = int(needed[min(len(needed) - 1, int(np.ceil(TARGET_RECALL * len(needed))))]) + 1
    return index


def _usable(vector: Column, dim: int | None = None) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ok = vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)
    return ok if dim is None else ok & (F.size(vector) == dim)


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:n]


def _plan_queries(queries: DataFrame, index: Index, dim: int, neighbours: int) -> DataFrame:
    """(query_id, q, threshold, lists, near): the lists to probe, the neighbours within the sample and
    the score of the last of them, below which no candidate can be among the nearest."""
    kind = queries.schema["v"].dataType.simpleString()
    schema = (
        f"query_id long, q {kind}, threshold double, lists array<int>, "
        "near array<struct<vec_id:bigint,score:double>>"
    )

    def plan(batch):
        if not len(batch):
            return
        q = _matrix(batch.column(1), dim).astype(np.float64)
        own = batch.column(0).to_numpy()
        lists = np.argsort(-(q @ index.centroids.T), axis=1, kind="stable")[:, : index.probes].astype(np.int32)
        rough = q @ index.sample.T.astype(np.float64)
        keep = min(len(index.ids), neighbours + 1 + 16)  # a few more, as rounding may swap equals
        near, threshold = [], []
        for i in range(len(q)):
            last = np.partition(rough[i], -keep)[-keep]
            at = np.flatnonzero(rough[i] >= last - 1e-9)
            at = at[index.ids[at] != own[i]]
            scores = inner(index.sample[at], np.broadcast_to(q[i], (len(at), dim)))
            best = _best(index.ids[at], scores, neighbours)
            near.append([{"vec_id": int(index.ids[at][k]), "score": float(scores[k])} for k in best])
            threshold.append(float(scores[best[-1]]) if len(best) == neighbours else -np.inf)
        yield batch.column(0), batch.column(1), threshold, list(lists), near

    return map_batches(queries.select(F.col("id").alias("query_id"), "v"), plan, schema)


def scan(x: np.ndarray, q: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, vector row) that no test abandons; x and q are rotated.

    With squared lengths known, an inner product of at least t is a squared distance of at most
    |q|^2 + |x|^2 - 2 t. After d of D columns the partial distance times D / d estimates the whole;
    beyond (1 + CONFIDENCE / sqrt(d))^2 times that bound the candidate is abandoned.
    """
    dim = x.shape[1]
    edges = np.unique(np.linspace(0, dim, min(COLUMN_BLOCKS, dim) + 1).astype(int))
    bound = (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :] - 2 * threshold[:, None].astype(np.float32)

    def limit(d: int) -> float:
        return d / dim * (1 + CONFIDENCE / np.sqrt(d)) ** 2 if d < dim else 1 + 1e-4

    a, b = q[:, : edges[1]], x[:, : edges[1]]
    part = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)
    i, j = np.nonzero(part <= bound * limit(edges[1]) + 1e-4)
    kept = part[i, j]
    for lo, hi in zip(edges[1:], edges[2:]):
        stays = np.zeros(len(i), dtype=bool)
        for s in range(0, len(i), PAIRS_AT_ONCE):
            e = slice(s, s + PAIRS_AT_ONCE)
            kept[e] += ((q[i[e], lo:hi] - x[j[e], lo:hi]) ** 2).sum(axis=1)
            stays[e] = kept[e] <= bound[i[e], j[e]] * limit(hi) + 1e-4
        i, j, kept = i[stays], j[stays], kept[stays]
    return i, j


def _search_group(vectors: pa.Table, queries: pa.Table, dim: int, neighbours: int) -> pa.Table:
    found = {"query_id": [], "vec_id": [], "score": []}
    if len(vectors) and len(queries):
        turn = rotation(dim)
        x, q = _matrix(vectors["v"], dim), _matrix(queries["q"], dim)
        ids, own = vectors["id"].to_numpy(), queries["query_id"].to_numpy()
        threshold = queries["threshold"].to_numpy()
        i, j = scan(x.astype(np.float32) @ turn, q.astype(np.float32) @ turn, threshold)
        other = ids[j] != own[i]
        i, j = i[other], j[other]
        scores = np.concatenate(
            [inner(x[j[s : s + PAIRS_AT_ONCE]], q[i[s : s + PAIRS_AT_ONCE]]) for s in range(0, len(i), PAIRS_AT_ONCE)]
            or [np.zeros(0)]
        )
        order = np.lexsort((ids[j], -scores, i))
        i, j, scores = i[order], j[order], scores[order]
        first = np.searchsorted(i, i, side="left")
        top = (np.arange(len(i)) - first < neighbours) & (scores >= threshold[i])
        found = {"query_id": own[i[top]], "vec_id": ids[j[top]], "score": scores[top]}
    return pa.table({k: pa.array(v, pa.float64() if k == "score" else pa.int64()) for k, v in found.items()})


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for each row that ``is_query`` selects.

    Score is the inner product in double precision; ties go to the smaller id; a row is not its own
    neighbour. Vectors that are null, zero, or hold a null or non-finite component take no part,
    nor do rows without an id and vectors of another length than the commonest (the smaller in a
    tie). Ids are taken as distinct. Copies of one vector beyond the ``neighbours`` + 1 smallest
    ids cannot be among the nearest and are left out of the lists, not out of the queries. The index
    is fitted on SAMPLE_ROWS vectors with the smallest id hashes; every vector is indexed.
    """
    valid = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("asks")
    ).filter(F.col("id").isNotNull() & _usable(F.col("v")))
    size = valid.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size is None:
        return empty
    dim = size["d"]
    valid = valid.filter(F.size("v") == dim)
    copies = Window.partitionBy("v").orderBy("id")
    held = cut_lineage(
        valid.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= neighbours + 1).select("id", "v")
    )
    rows = held.count()
    most = min(SAMPLE_ROWS, max(256, SAMPLE_VALUES // dim))
    sample = held.orderBy(F.xxhash64("id"), "id").limit(most).toPandas()
    index = fit(sample["id"].to_numpy(np.int64), np.stack(sample["v"].to_list()), rows, neighbours)

    kind = held.schema["v"].dataType.simpleString()

    def deal(batch):
        if len(batch):
            yield index.lists(_matrix(batch.column(1), dim).astype(np.float64)).astype(np.int32), batch.column(0), batch.column(1)

    listed = cut_lineage(map_batches(held, deal, f"list int, id long, v {kind}"))
    planned = cut_lineage(_plan_queries(valid.filter("asks"), index, dim, neighbours))
    probing = planned.select("query_id", "q", "threshold", F.explode("lists").alias("list"))
    # One row per list: at most as many as the sample allows centroids.
    sizes = (
        listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / VECTOR_BLOCK).cast("int").alias("vector_blocks"))
        .join(
            probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("query_blocks")), "list"
        )
    )
    sizes = F.broadcast(cut_lineage(sizes))

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Rows with the block they fall into, once for each block of the other side."""
        return (
            df.join(sizes, "list")
            .withColumn(own[:-1], F.pmod(F.xxhash64(F.lit(own), key), F.col(own)).cast("int"))
            .withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("vector_blocks", "query_blocks")
        )

    keys = ["list", "vector_block", "query_block"]
    left = dealt(listed, "id", "vector_blocks", "query_blocks").groupBy(*keys)
    right = dealt(probing, "query_id", "query_blocks", "vector_blocks").groupBy(*keys)

    def search(vector_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        return _search_group(vector_rows, query_rows, dim, neighbours)

    found = left.cogroup(right).applyInArrow(search, "query_id long, vec_id long, score double")
    sampled = planned.select("query_id", F.explode("near").alias("s")).select("query_id", "s.vec_id", "s.score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.union(sampled).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )
