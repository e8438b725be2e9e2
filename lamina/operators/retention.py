"""Relative-date retention and erasure filters."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F

from lamina.functions.exprs import as_of_date


def retained(
    df: DataFrame,
    created: str,
    deleted: str | None = None,
    years: int = 7,
    grace_days: int = 30,
    as_of: Any = None,
) -> DataFrame:
    """Rows created within ``years``; soft-deleted rows only within the grace period.

    The bounds are constants of the query, so the scan can skip files and row groups by them.
    """
    today = as_of_date(as_of)
    keep = F.col(created) >= F.add_months(today, -12 * years)
    if deleted is not None:
        gone = F.col(deleted)
        keep = keep & (gone.isNull() | (gone >= F.date_sub(today, grace_days)))
    return df.filter(keep)


def within_days(df: DataFrame, created: str, max_age_days: int, as_of: Any = None) -> DataFrame:
    """Rows not older than a contract's ``max_age_days``."""
    return df.filter(F.col(created) >= F.date_sub(as_of_date(as_of), max_age_days))


def _erasable(category: str, delete_after: str, as_of: Any):
    # NULL in either column is "not due": coalesce keeps both filters complementary.
    due = (F.col(category) == "to_delete") & (F.col(delete_after) < as_of_date(as_of))
    return F.coalesce(due, F.lit(False))


def erasure_due(
    df: DataFrame,
    category: str = "retention_category",
    delete_after: str = "gdpr_delete_after",
    as_of: Any = None,
) -> DataFrame:
    """Rows flagged for deletion whose deletion date has passed."""
    return df.filter(_erasable(category, delete_after, as_of))


def without_erased(
    df: DataFrame,
    category: str = "retention_category",
    delete_after: str = "gdpr_delete_after",
    as_of: Any = None,
) -> DataFrame:
    """All rows except those returned by :func:`erasure_due`."""
    return df.filter(~_erasable(category, delete_after, as_of))
