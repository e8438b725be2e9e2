"""Rank, row number and neighbouring rows within groups of any size.

A plain window sorts each group in one task. Here the rows are range-partitioned by group *and*
order first, so that a group holding a third of all rows is cut into many consecutive chunks.
Windows run inside the chunks; what crosses a chunk border is carried by one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lamina.session import cut_lineage, estimated_bytes

CHUNK_BYTES = 32 << 20

_GROUP, _CHUNK, _AT = "__group", "__chunk", "__at"


def ordered_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] = (),
    values: Sequence[str] = (),
    chunks: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """``df`` with ``row_number``, ``rank`` and, per value column, ``previous_`` and ``next_``.

    Rows of a group are ordered by ``order_by``, then ``tie_break``, NULLs last; ``rank`` looks
    at ``order_by`` only. The order must be total for the other columns to be well defined.
    ``chunks`` is the number of pieces the whole table is cut into, by default one for each
    CHUNK_BYTES of its estimated size; one piece should fit a task.
    """
    if chunks is None:
        size = estimated_bytes(df)
        chunks = None if size is None else max(1, -(-size // CHUNK_BYTES))
    direction = F.desc_nulls_last if descending else F.asc_nulls_last
    order = [direction(c) for c in order_by] + [F.asc_nulls_last(c) for c in tie_break]
    group = [F.asc_nulls_last(k) for k in keys]
    split = [*group, *order]
    ranged = df.repartitionByRange(chunks, *split) if chunks else df.repartitionByRange(*split)
    # Written once: the chunk of a row must be the same in everything derived below.
    rows = cut_lineage(ranged.withColumn(_CHUNK, F.spark_partition_id()))

    # One struct column for the group: never NULL itself, equal also where its fields are NULL.
    rows = rows.withColumn(_GROUP, F.struct(*[F.col(k) for k in keys]))
    inside = Window.partitionBy(_GROUP, _CHUNK).orderBy(*order)
    by_rank = Window.partitionBy(_GROUP, _CHUNK).orderBy(*order[: len(order_by)])
    carried = F.struct(*[F.col(v) for v in values]) if values else F.lit(None)
    at = F.struct(*[F.col(c) for c in order_by])
    local = rows.select(
        "*",
        F.row_number().over(inside).alias("__rn"),
        F.rank().over(by_rank).alias("__rank"),
        F.lag(carried).over(inside).alias("__prev"),
        F.lead(carried).over(inside).alias("__next"),
        at.alias(_AT),
        carried.alias("__own"),
    )
    borders = local.groupBy(_GROUP, _CHUNK).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("__own", "__rn").alias("first"),
        F.max_by("__own", "__rn").alias("last"),
        F.max_by(_AT, "__rn").alias("last_at"),
        F.max("__rank").alias("last_rank"),
    )
    # One row per group and chunk: a group has no more of them than there are partitions.
    chain = Window.partitionBy(_GROUP).orderBy(_CHUNK)
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    borders = borders.select(
        _GROUP, _CHUNK, "last_rank", "last_at",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.lag("last").over(chain).alias("prev_last"),
        F.lead("first").over(chain).alias("next_first"),
        F.lag("last_at").over(chain).alias("prev_at"),
        F.lag(F.lit(True)).over(chain).isNotNull().alias("continued"),
    )
    # Rank of the run of equal values a chunk ends with, unless the run began in an earlier chunk.
    began_here = ~(F.col("continued") & F.col("last_at").eqNullSafe(F.col("prev_at")))
    run = F.when(began_here, F.col("before") + F.col("last_rank"))
    borders = borders.withColumn("__run", run)
    borders = borders.withColumn("run_rank", F.last("__run", ignorenulls=True).over(earlier))
    joined = local.join(borders, [_GROUP, _CHUNK])
    spans = F.col("continued") & F.col(_AT).eqNullSafe(F.col("prev_at"))
    return joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("before") + F.col("__rn")).cast("long").alias("row_number"),
        F.when(spans, F.col("run_rank")).otherwise(F.col("before") + F.col("__rank"))
        .cast("long").alias("rank"),
        *[
            F.coalesce(F.col("__prev"), F.col("prev_last"))[v].alias(f"previous_{v}") for v in values
        ],
        *[F.coalesce(F.col("__next"), F.col("next_first"))[v].alias(f"next_{v}") for v in values],
    )
