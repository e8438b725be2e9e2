"""Equi-joins that stay parallel when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lamina.session import fits_broadcast

ROWS_PER_TASK = 1_000_000  # rows of one key a single task is meant to take
NO_KEY_SALTS = 65_536      # rows without a key match nothing, so spreading them costs nothing

_HASH, _SALT, _SALTS = "__key_hash", "__salt", "__salts"


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key hash, salts) of all keys too large for one task.

    Every key is counted; counts are combined before their shuffle, and only key columns are
    read. At most one key in ``rows_per_task`` rows can be in the list, so it may be broadcast: a
    million million rows have at most a million hot keys, of twelve bytes each.
    """
    return (
        df.groupBy(_key_hash(keys).alias(_HASH))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > rows_per_task)
        .select(_HASH, F.ceil(F.col("n") / rows_per_task).cast("int").alias(_SALTS))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    counted_from: DataFrame | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` (left or inner), hot left keys spread over several tasks.

    A hot key gets as many salts as its rows fill tasks; rows of ``right`` under it are repeated
    once per salt, all other rows stay single. The salt is a pure function of the row and its
    input partition: a recomputed task assigns it again the same way, and exact copies of one
    row in different partitions still spread.
    Left rows with a NULL key can match nothing and are spread too.

    Keys are counted in ``left``, or in ``counted_from`` where that has the same keys and
    is cheaper to read, such as the table ``left`` was derived from.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"salted_join supports left and inner, not {how}")
    keys = list(on)
    source = left if counted_from is None else counted_from
    hot = F.broadcast(hot_keys(source, keys, rows_per_task))

    spread = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.spark_partition_id())
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(f"`{k}`").isNull()
    salts = F.when(no_key, F.lit(NO_KEY_SALTS)).otherwise(F.coalesce(_SALTS, F.lit(1)))
    left_side = (
        left.withColumn(_SALT, spread)
        .withColumn(_HASH, _key_hash(keys))
        .join(hot, _HASH, "left")
        .withColumn(_SALT, F.pmod(F.col(_SALT), salts).cast("int"))
        .drop(_HASH, _SALTS)
    )
    right_side = (
        right.withColumn(_HASH, _key_hash(keys))
        .join(hot, _HASH, "left")
        .withColumn(
            _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1))
        )
        .drop(_HASH, _SALTS)
    )
    return left_side.join(right_side, [*keys, _SALT], how).drop(_SALT)


def safe_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limit: int | None = None,
    counted_from: DataFrame | None = None,
) -> DataFrame:
    """Join with a lookup side of unknown size.

    Within the session's broadcast threshold the plain join is left to Catalyst, which then
    broadcasts ``right`` and shuffles nothing. Beyond it the join is salted. A ``limit`` takes the
    place of the threshold.
    """
    if fits_broadcast(right, limit):
        return left.join(right if limit is None else F.broadcast(right), list(on), how)
    return salted_join(left, right, on, how, counted_from=counted_from)
