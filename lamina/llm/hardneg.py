"""Hard negatives by disjoint score slots.

Every positive of an anchor opens a window of scores for its negatives, from LOW to HIGH hundredths of
its own score. The windows overlap; their upper ends cut the scores into disjoint slots instead, so a
negative falls into one slot and is counted once. Blocks of rows meet blocks of anchors, and each
meeting keeps the best few of every slot; these are combined again before and after the shuffle. What a
window returns is the best few of its own slot and all slots below, so one descending pass over an
anchor's slots answers all of its windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lamina.session import cut_lineage

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90         # hundredths of the positive's score
SCALE = 256
ROW_VALUES, ANCHOR_VALUES = 1 << 20, 1 << 18  # components of the rows and anchors that meet in one task
CELLS_AT_ONCE = 1 << 21    # scores held at once
_LONG = np.int64(2**63 - 1)


def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.astype(np.float64) * SCALE).reshape(len(column), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a and b. Doubles are exact below 2 ** 53; beyond, Python's
    integers are used, and scores that do not fit 64 bits become the largest that do."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return np.rint(a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(a).dot(exact(b).T), -_LONG, _LONG).astype(np.int64)


def _top(scores: np.ndarray, wanted: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the n highest wanted scores of each row; of equal ones the first columns."""
    held = np.where(wanted, scores, -_LONG - 1)
    if scores.shape[1] > n:
        last = np.partition(held, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
        above = held > last[:, None]
        equal = wanted & (held == last[:, None])
        room = n - above.sum(axis=1)
        equal &= np.cumsum(equal, axis=1) <= room[:, None]
        wanted = (wanted & above) | equal
    return np.nonzero(wanted)


def _met(rows: pa.Table, anchors: pa.Table, dim: int):
    """Anchors in runs, with the scores of all rows (ordered by id) for each run."""
    rows = rows.sort_by("id")
    x, q = _matrix(rows["v"], dim), _matrix(anchors["q"], dim)
    step = max(1, CELLS_AT_ONCE // max(1, len(x)))
    for first in range(0, len(q), step):
        run = slice(first, first + step)
        yield run, rows["id"].to_numpy(), rows["label"].to_numpy(), products(q[run], x)


def _positive_cell(rows: pa.Table, anchors: pa.Table, dim: int, positives: int) -> pa.Table:
    own, own_label = anchors["anchor"].to_numpy(), anchors["anchor_label"].to_numpy()
    out = [[], [], []]
    if len(rows) and len(anchors):
        for run, ids, labels, scores in _met(rows, anchors, dim):
            wanted = (labels[None, :] == own_label[run, None]) & (ids[None, :] != own[run, None])
            i, j = _top(scores, wanted, positives)
            for held, values in zip(out, (own[run][i], ids[j], scores[i, j])):
                held.append(values)
    found = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    return pa.table(dict(zip(("anchor", "id", "score"), map(pa.array, found))))


def _slot_cell(rows: pa.Table, anchors: pa.Table, dim: int, negatives: int) -> pa.Table:
    """The best few negatives of each slot. Slot k holds scores up to the k-th upper end and above the next;
    scores below every window that reaches down to the slot are of no use."""
    out = [[], [], [], []]
    if len(rows) and len(anchors):
        own_label = anchors["anchor_label"].to_numpy()
        own = anchors["anchor"].to_numpy()
        ends = [np.array(x or [], dtype=np.int64) for x in anchors["highs"].to_pylist()]
        floors = [np.array(x or [], dtype=np.int64) for x in anchors["lows"].to_pylist()]
        most = max(map(len, ends), default=0)
        high = np.full((len(ends), most + 1), -_LONG)
        low = np.full((len(ends), most), _LONG)
        for k, (e, f) in enumerate(zip(ends, floors)):
            high[k, : len(e)], low[k, : len(f)] = e, f
        for run, ids, labels, scores in _met(rows, anchors, dim):
            other = labels[None, :] != own_label[run, None]
            for slot in range(most):
                bottom = np.maximum(low[run, slot], high[run, slot + 1] + 1)
                wanted = other & (scores <= high[run, slot, None]) & (scores >= bottom[:, None])
                i, j = _top(scores, wanted, negatives)
                for held, values in zip(out, (own[run][i], np.full(len(i), slot), ids[j], scores[i, j])):
                    held.append(values)
    found = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    return pa.table(dict(zip(("anchor", "slot", "id", "score"), (pa.array(x.astype(np.int64)) for x in found))))


def _blocks(df: DataFrame, values: int) -> int:
    size = df.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    return max(1, -(-size["n"] * (size["dim"] or 0) // values))


def _cells(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Both sides grouped by (length of the vectors, row block, anchor block): every row meets every anchor
    of its length once, in blocks dealt by hash, so neither a label nor a vector makes a block larger."""
    dealt = rows.withColumn("rb", F.pmod(F.xxhash64(F.lit("row"), "id"), F.lit(row_blocks)).cast("int")).withColumn(
        "ab", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)))
    )
    asked = anchors.withColumn(
        "ab", F.pmod(F.xxhash64(F.lit("anchor"), "anchor"), F.lit(anchor_blocks)).cast("int")
    ).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    keys = ["dim", "rb", "ab"]
    return dealt.groupBy(*keys).cogroup(asked.groupBy(*keys))


def _best(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n best of each key, with a limit in front of the shuffle as well."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n).drop("place")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the components' floor(256 x). An anchor's positives are its
    ``positives`` highest other rows of the same label; each positive's negatives are the
    ``negatives`` highest rows of another label with 30 * positive_score <= 100 * negative_score <= 90 *
    positive_score. Ties go to the smaller id, all rows that there are count if they are fewer, and a
    positive without negatives gives no row. Rows with a null id, label or vector or with a null or
    non-finite component take no part. Rows meet only anchors of equally long vectors; empty vectors
    score 0. Of rows that share an id one takes part, that of the smallest label, then vector. Scores
    beyond 64 bits count as the largest of 64 bits. An empty table gives no rows. Columns other
    than those named are not read.
    """
    label = F.col("label") if label is None else label
    valid = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).alias("v"),
        is_anchor.alias("asks"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & _finite(F.col("v")))
    one = F.min(F.struct("label", "v", "asks")).alias("one")
    rows = cut_lineage(valid.groupBy("id").agg(one).select("id", "one.*", F.size("one.v").alias("dim")))
    anchors = rows.filter("asks").select(F.col("id").alias("anchor"), F.col("label").alias("anchor_label"), F.col("v").alias("q"), F.col("dim").alias("dim"))
    rows = rows.select("id", "label", "v", "dim")
    row_blocks, anchor_blocks = _blocks(rows, ROW_VALUES), _blocks(anchors, ANCHOR_VALUES)

    def find_positives(key, held: pa.Table, asked: pa.Table) -> pa.Table:
        return _positive_cell(held, asked, key[0].as_py(), positives)

    def find_slots(key, held: pa.Table, asked: pa.Table) -> pa.Table:
        return _slot_cell(held, asked, key[0].as_py(), negatives)

    found = _cells(rows, anchors, row_blocks, anchor_blocks).applyInArrow(find_positives, "anchor long, id long, score long")
    near = cut_lineage(_best(found, ["anchor"], positives))

    # At most ``positives`` windows an anchor: their distinct upper ends, descending, are its slots.
    percent = lambda share: F.col("score").cast("decimal(38,0)") * share / 100
    windowed = near.withColumn("low", F.ceil(percent(LOW)).cast("long")).withColumn("high", F.floor(percent(HIGH)).cast("long"))
    useful = windowed.filter("low <= high").groupBy("anchor", "high").agg(F.min("low").alias("low"))
    ends = useful.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("high", "low")), asc=False).alias("ends"))
    ends = cut_lineage(ends.select("anchor", F.col("ends.high").alias("highs"), F.col("ends.low").alias("lows")))
    slots = _cells(rows, anchors.join(ends, "anchor"), row_blocks, anchor_blocks).applyInArrow(
        find_slots, "anchor long, slot long, id long, score long"
    )
    kept = _best(slots, ["anchor", "slot"], negatives)
    # Slots descend, so an anchor's rows in order are the merge of its slots; a window's rows begin at its slot.
    ranked = kept.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("slot")).alias("down"), "score", (-F.col("id")).alias("back"))), asc=False).alias("all")
    )
    asked = windowed.filter("low <= high").join(ends.select("anchor", "highs"), "anchor").join(ranked, "anchor")
    from_slot = F.filter("all", lambda r: -r["down"] >= F.array_position("highs", F.col("high")) - 1)
    best = F.filter(F.slice(from_slot, 1, negatives), lambda r: r["score"] >= F.col("low"))
    return asked.select("anchor", "id", "score", F.posexplode(best).alias("at", "r")).select(
        F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), (F.col("at") + 1).alias("rank"),
        (-F.col("r.back")).alias("negative_id"), F.col("score").alias("positive_score"), F.col("r.score").alias("negative_score"),
    )


def hard_negatives_sql(table: str, positives: int = POSITIVES, negatives: int = NEGATIVES) -> str:
    """DuckDB SQL for ``hard_negatives`` over ids, embeddings and labels as the query has them."""
    return f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
  FROM {table}
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
         list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives}
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY rank <= {negatives}
"""
