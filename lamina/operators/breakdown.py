"""Per-group breakdown of a total by item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lamina.functions.exprs import money


def item_totals(df: DataFrame, keys: Sequence[str], item: str, value: str) -> DataFrame:
    """(keys, item, total): one row per group and item; NULL items count as ''."""
    return (
        df.groupBy(*keys, F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"))
        .agg(F.sum(money(df, value)).alias("total"))
    )


def json_breakdown(df: DataFrame, keys: Sequence[str], item: str, value: str) -> DataFrame:
    """``item_totals`` with each total as a JSON object ``{item: total}``.

    A group of any size is a set of rows; no text grows with the number of its items.
    """
    totals = item_totals(df, keys, item, value)
    return totals.select(*keys, "item", F.to_json(F.create_map("item", "total")).alias("breakdown"))
