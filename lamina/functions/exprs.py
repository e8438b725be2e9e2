"""Column expressions used across the silver and gold plans.

All of them are built from built-in functions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T


def present(col: Column) -> Column:
    """Not NULL and not the empty string."""
    return col.isNotNull() & (col != F.lit(""))


def is_sha256(col: Column) -> Column:
    """A string with the length of a SHA-256 hex digest."""
    return F.length(col) == 64


def one_of(col: Column, values: Iterable[Any]) -> Column:
    return col.isin(list(values))


def none_of(col: Column, values: Iterable[Any]) -> Column:
    """A non-NULL value outside ``values`` (NULL is not counted as outside)."""
    return col.isNotNull() & ~col.isin(list(values))


def in_order(first: Column, second: Column) -> Column:
    """``second >= first``; an unknown bound does not exclude the row."""
    return first.isNull() | second.isNull() | (second >= first)


def between_open(col: Column, low: Any = None, high: Any = None) -> Column:
    """Range predicate where either bound may be missing; NULL values do not pass."""
    parts = []
    if low is not None:
        parts.append(col >= F.lit(low))
    if high is not None:
        parts.append(col <= F.lit(high))
    out = F.lit(True)
    for part in parts:
        out = out & part
    return out


def normalized(col: Column) -> Column:
    """Upper case without surrounding blanks."""
    return F.upper(F.trim(col))


def code2(col: Column) -> Column:
    """Two-letter upper-case code, such as an ISO country code."""
    return F.upper(F.substring(col, 1, 2))


def or_default(col: Column, value: Any) -> Column:
    return F.coalesce(col, F.lit(value))


def or_zero(col: Column, type_name: str) -> Column:
    """NULL becomes zero of the column's own type, so decimals stay decimals."""
    return F.coalesce(col, F.lit(0).cast(type_name))


def clamp_percent(col: Column) -> Column:
    """Value forced into 0..100, in its own scale; NULL counts as 0."""
    return F.least(F.lit(100), F.greatest(F.lit(0), F.coalesce(col, F.lit(0))))


def label(test: Column, yes: str, no: str) -> Column:
    """Flag to text; an unknown flag takes the second text."""
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def share_percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double, 0 where ``whole`` is not positive or unknown."""
    ratio = part.cast("double") / whole.cast("double") * F.lit(100.0)
    return F.when(whole > 0, ratio).otherwise(F.lit(0.0))


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0 where ``whole`` is not positive or unknown."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def mean_of(total: Column, n: Column) -> Column:
    """Mean from an exact sum and a count; NULL for no values."""
    return F.when(n > 0, total.cast("double") / n)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``; NULL when either is unknown."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("long")


def as_of_date(as_of: Any = None) -> Column:
    """The reporting date: a fixed date when given, else the current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


BINARY_AMOUNT = T.DecimalType(28, 8)  # what floating-point amounts are summed as


def money(df: DataFrame, name: str) -> Column:
    """A column in the exact form used before any sum, so that sums do not depend on row order.

    Decimals keep their own precision and scale and whole numbers stay whole; only floating-point
    amounts need a decimal type, of eight places.
    """
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    return column.cast(BINARY_AMOUNT) if isinstance(kind, (T.DoubleType, T.FloatType)) else column


def packed_text(col: Column) -> Column:
    """A text as bytes, a lower-case hex digest in half its length; ``unpacked_text`` gives it back.

    The last byte tells which it is. Digests do not compress, so rows that carry them shuffle in half the room.
    """
    raw = F.unhex(col)
    digest = F.coalesce(F.lower(F.hex(raw)) == col, F.lit(False))
    return F.when(digest, F.concat(raw, F.lit(bytearray(b"\0")))).otherwise(
        F.concat(col.cast("binary"), F.lit(bytearray(b"\1")))
    )


def unpacked_text(col: Column) -> Column:
    body = F.substring(col, F.lit(1), F.length(col) - 1)
    return F.when(F.substring(col, -1, 1) == F.lit(bytearray(b"\0")), F.lower(F.hex(body))).otherwise(body.cast("string"))
