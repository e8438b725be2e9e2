"""Keep one row per key.

``row_number() == 1`` lets Catalyst place a partial group limit in front of the shuffle: every
input task forwards at most one row per key, so a key holding a third of all rows never meets
in one task as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "__row_rank"


def _order_value(field: T.StructField) -> Column:
    """An orderable form of any column (maps and variants have none of their own)."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.MapType, T.StructType, T.ArrayType)):
        return F.to_json(column)
    if isinstance(field.dataType, T.VariantType):
        return column.cast("string")
    return column


def tie_breakers(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """Total order over the remaining columns, so that full ties have one fixed survivor."""
    return [
        F.asc_nulls_last(_order_value(f)) for f in df.schema.fields if f.name not in set(skip)
    ]


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str] = (),
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row per ``keys`` by ``newest_by`` (each descending, NULLs last).

    Rows equal in all ordering columns are told apart by ``tie_break`` (ascending), by default
    all other columns. NULL keys form a group of their own.
    """
    order = [F.desc_nulls_last(f"`{c}`") for c in newest_by]
    if tie_break is None:
        order += tie_breakers(df, [*keys, *newest_by])
    else:
        order += [F.asc_nulls_last(_order_value(df.schema[c])) for c in tie_break]
    if not order:
        order = [F.asc_nulls_last(f"`{keys[0]}`")]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def upsert(
    current: DataFrame | None,
    delta: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str],
) -> DataFrame:
    """Current table after ``delta``: union of both, newest row per key."""
    if current is None:
        return keep_latest(delta, keys, newest_by)
    return keep_latest(current.unionByName(delta, allowMissingColumns=True), keys, newest_by)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count; NULL counts as a value."""
    columns = [F.col(f"`{k}`") for k in keys]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
