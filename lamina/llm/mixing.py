"""Sources interleaved to target weights by Pfair scheduling.

Only DataFrame functions on the data. Time runs in slots of one block. With weight w out of a
total of W, block j of a source (from 0) is released at floor(j W / w) and due at
ceil((j + 1) W / w); in every slot the released block with the earliest deadline runs. As the
weights add up to W, no slot is idle and no deadline is missed, so in every prefix each source is less
than one block from its share. The schedule repeats after W slots: one period, a table of W rows
made from the weights alone, places every block of any number of documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BLOCK_DOCS = 64
PARTS = 100  # parts of the mix that default targets give a source on average
BUCKET_ROWS = 20_000  # documents of one source that one task is meant to number


def period(weights: list[int]) -> list[tuple[int, int, int]]:
    """(source, block within the period, slot) by earliest deadline first; ties go to the lower source."""
    total = sum(weights)
    waiting = [(0, k, 0) for k, w in enumerate(weights) if w > 0]  # by release time
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[k]), k, j))
        _, k, j = heapq.heappop(ready)
        out.append((k, j, slot))
        if j + 1 < weights[k]:
            heapq.heappush(waiting, ((j + 1) * total // weights[k], k, j + 1))
    return out


def tempered(counts: Mapping, exponent: float = 0.5, parts: int = PARTS) -> dict:
    """Whole weights in proportion to size ** exponent: ``parts`` for each source on average, each
    rounded to the nearest whole, 1 at least. So sources due less than one part, however many they are,
    together take at most a ``parts``-th of the mix from the others."""
    share = {s: n**exponent for s, n in counts.items() if n > 0}
    whole = sum(share.values())
    return {s: max(1, int(parts * len(share) * x / whole + 0.5)) for s, x in share.items()}


def _order(id_col: str) -> Column:
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def _spread(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def mix(
    docs: DataFrame, weights: Mapping | None = None, id_col: str = "doc_id", source_col: str = "source",
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """The schedule: id, source, ``block`` within its source, ``slot`` in the mix, ``place`` in the block
    and ``on_target``.

    ``weights`` maps sources to whole numbers; without it sources weigh as the square root of their
    size. Every document is placed: a source that has run out leaves its slots empty, and from the
    first such slot on ``on_target`` is false. A source missing in ``weights`` or of weight 0 comes
    after all others, unscheduled: its slot is null. Documents of one source follow each other in
    the order of their id's MD5; repeated rows stay, null ids come in the order of the empty text,
    a null source is a source. Texts and other columns are not read: join the schedule by id.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    counts = {r["source"]: r["n"] for r in keyed.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    given = tempered(counts) if weights is None else {s: w for s, w in weights.items() if w > 0 and s in counts}
    sources = sorted(counts, key=lambda s: (s is not None, str(s)))
    chosen = [s for s in sources if s in given]
    slots = period([given[s] for s in chosen])
    total = len(slots)
    at = {(k, j): slot for k, j, slot in slots}

    def slot_of(k: int, block: int) -> int:
        w = given[chosen[k]]
        return block // w * total + at[k, block % w]

    horizon = min((slot_of(k, -(-counts[s] // block_docs)) for k, s in enumerate(chosen)), default=0)

    digits = 1  # documents are numbered within parts of a source, by leading digits of their order
    while max(counts.values(), default=0) > BUCKET_ROWS * 16**digits:
        digits += 1
    kind = docs.schema[source_col].dataType.simpleString()
    named = _spread(
        spark, [(s, k, given.get(s, 0), chosen.index(s) if s in given else -1) for k, s in enumerate(sources)],
        f"source {kind}, k int, weight int, rank int",
    )
    parts = (
        keyed.withColumn("order", _order("id")).withColumn("part", F.substring("order", 1, digits))
        .join(named.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    )
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("k", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "k", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    numbered = parts.join(offsets, ["k", "part"]).withColumn(
        "number", F.col("offset") + F.row_number().over(Window.partitionBy("k", "part").orderBy("order", "id")) - 1
    )
    blocks = numbered.withColumn("block", F.floor(F.col("number") / block_docs)).withColumn(
        "step", F.when(F.col("weight") > 0, F.col("block") % F.col("weight"))
    )
    table = _spread(spark, slots, "rank int, step long, first long")
    slot = F.floor(F.try_divide("block", "weight")) * total + F.col("first")
    return blocks.join(table, ["rank", "step"], "left").select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "block", slot.cast("long").alias("slot"),
        (F.col("number") % block_docs).cast("int").alias("place"),
        F.coalesce(slot < horizon, F.lit(False)).alias("on_target"),
    )


def mix_sql(table: str, block_docs: int = BLOCK_DOCS) -> str:
    """The same schedule in DuckDB's SQL, for the default weights and distinct ids."""
    return f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
weighed AS (
  SELECT source, n, greatest(1, CAST(floor({PARTS} * count(*) OVER () * sqrt(n) / sum(sqrt(n)) OVER () + 0.5) AS BIGINT)) AS w,
    row_number() OVER (ORDER BY source NULLS FIRST) AS k
  FROM sizes),
lists AS (SELECT list(w ORDER BY k) AS ws, CAST(sum(w) AS BIGINT) AS total, list(0::BIGINT ORDER BY k) AS zero FROM weighed),
edf(t, used, k) AS (
  SELECT 0::BIGINT, zero, 0::BIGINT FROM lists
  UNION ALL
  SELECT t + 1, list_transform(used, lambda u, i: u + CAST(i = pick AS BIGINT)), pick
  FROM (
    SELECT t, used, list_min(list_transform(ws, lambda w, i: CASE
      WHEN used[i] < w AND used[i] * total // w <= t
      THEN ((used[i] + 1) * total + w - 1) // w * 1000000 + i END)) % 1000000 AS pick
    FROM edf, lists WHERE t < total)),
slots AS (SELECT k, t - 1 AS first, row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS step FROM edf WHERE t > 0),
numbered AS (
  SELECT d.doc_id, d.source, s.k, s.w,
    row_number() OVER (PARTITION BY s.k ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id) - 1 AS number
  FROM {table} d JOIN weighed s ON d.source IS NOT DISTINCT FROM s.source),
ends AS (
  SELECT min(((n + {block_docs - 1}) // {block_docs}) // w * total + first) AS horizon
  FROM weighed JOIN slots USING (k), lists WHERE step = ((n + {block_docs - 1}) // {block_docs}) % w)
SELECT doc_id, source, number // {block_docs} AS block, number // {block_docs} // w * total + first AS slot,
  CAST(number % {block_docs} AS INTEGER) AS place, number // {block_docs} // w * total + first < horizon AS on_target
FROM numbered JOIN slots USING (k), lists, ends WHERE step = number // {block_docs} % w
"""
