"""Transformations derived from a contract."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lamina.contracts.model import ColumnSpec, Contract
from lamina.functions.exprs import between_open, code2
from lamina.functions.hashing import pseudonym
from lamina.operators.dedup import keep_latest


def _source_column(spec: ColumnSpec) -> Column:
    """The expression that fills a contract column, decided by its name and type."""
    name, lower = spec.name, spec.name.lower()
    if "email" in lower and "hash" in lower:
        filled = pseudonym(F.col(name.replace("_hash", "")))
    elif name.endswith("_code") and spec.type == "VARCHAR":
        filled = code2(F.col(name.replace("_code", "")))
    elif name == "processed_at" and spec.type == "TIMESTAMP":
        filled = F.current_timestamp().cast("timestamp_ntz")
    else:
        filled = F.col(f"`{name}`")
    return filled.alias(name)


def _row_condition(contract: Contract) -> Column | None:
    parts = []
    for spec in contract.columns:
        c = F.col(f"`{spec.name}`")
        if spec.not_null:
            parts.append(c.isNotNull())
        if spec.min_value is not None or spec.max_value is not None:
            parts.append(between_open(c, spec.min_value, spec.max_value))
    return reduce(lambda a, b: a & b, parts) if parts else None


def compile_contract(contract: Contract) -> Callable[[DataFrame], DataFrame]:
    """A function that shapes raw data into the contract: columns, row filters, one row per key.

    All ``unique`` columns together form the key. The newest row by the first DATE or TIMESTAMP
    column survives; without one the order is the key itself, with the other columns as tie-break.
    """
    keys = [c.name for c in contract.columns if c.unique]
    dated = [c.name for c in contract.columns if c.type in ("DATE", "TIMESTAMP")]
    # The processing time is the same for all rows and orders nothing.
    newest_by = [name for name in dated[:1] if name != "processed_at"]
    others = [
        c.name for c in contract.columns if c.name not in (*keys, *newest_by, "processed_at")
    ]
    condition = _row_condition(contract)

    def transform(df: DataFrame) -> DataFrame:
        out = df.select(*[_source_column(c) for c in contract.columns])
        if condition is not None:
            out = out.filter(condition)
        return keep_latest(out, keys, newest_by, others) if keys else out

    return transform
