"""Contracts from data: introspection, default rules, key profiling."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F, types as T

from lamina.contracts.checks import duplicate_counts
from lamina.contracts.model import ColumnSpec, Contract, Rule
from lamina.contracts.types import to_contract_type
from lamina.operators.skew import ROWS_PER_TASK, hot_keys

TRIED_VALUES = 1 << 14  # combinations of a set of columns that are tried before all of them are counted
COUNTED_PER_TASK = 1 << 20  # combinations, of all sets together, that one task is meant to count


def null_counts(df: DataFrame) -> DataFrame:
    """One row: total rows and NULLs per column, from one pass."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("__rows"), *counts)


def introspect(df: DataFrame) -> DataFrame:
    """Column definitions as rows: name, contract type, position, observed NULLs and rows.

    Parquet declares every column nullable, so nullability is taken from the data.
    """
    fields = df.schema.fields
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(to_contract_type(f.dataType)).alias("column_type"),
            F.lit(i).alias("position"),
            F.col(f"`{f.name}`").alias("null_rows"),
            F.col("__rows").alias("total_rows"),
        )
        for i, f in enumerate(fields)
    ]
    return null_counts(df).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def default_rules(columns: Sequence[ColumnSpec]) -> list[Rule]:
    """A not-null rule per NOT NULL column, and at least one row."""
    rules = [
        Rule(f"no_null_{c.name}", "not_null", column=c.name) for c in columns if not c.nullable
    ]
    return [*rules, Rule("minimum_rows", "volume", min_rows=1)]


def generate_contract(
    df: DataFrame,
    dataset: str,
    stage: str,
    owner: str = "data-team",
    description: str = "",
    version: str = "1.0.0",
) -> Contract:
    """A first contract for existing data, to be refined by hand."""
    found = null_counts(df).first()
    columns = []
    for f in df.schema.fields:
        nullable = found["__rows"] == 0 or found[f.name] > 0
        columns.append(
            ColumnSpec(
                f.name, to_contract_type(f.dataType), nullable, f"{f.name} column", not_null=not nullable
            )
        )
    return Contract(
        version, dataset, stage, owner,
        description or f"{dataset} dataset in {stage} stage",
        tuple(columns),
        tuple(default_rules(columns)),
        {"freshness": {"max_age_hours": 24, "schedule": "daily"}, "completeness": {"min_row_count": 1}},
        {"backward_compatible": True, "breaking_changes_allowed": False, "deprecation_notice_days": 30},
    )


def key_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Estimated distinct values per column and their share of the rows, from one pass."""
    chosen = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias(c) for c in chosen],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"`{c}`").alias("distinct_estimate"),
            F.col("__rows").alias("total_rows"),
        )
        for c in chosen
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def confirmed_keys(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """(column_name, duplicate_values) counted exactly; a key has no duplicate values."""
    columns = list(candidates)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("duplicate_values"))
        for i, c in enumerate(columns)
    ]
    counts = duplicate_counts(df, columns)
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def key_candidates(df: DataFrame, slack: float = 0.1) -> list[str]:
    """Columns that are unique: an estimate picks the candidates, an exact count confirms them."""
    estimates = key_profile(df).collect()
    likely = [
        r["column_name"] for r in estimates
        if r["total_rows"] and r["distinct_estimate"] >= (1 - slack) * r["total_rows"]
    ]
    if not likely:
        return []
    exact = confirmed_keys(df, likely).collect()
    return [r["column_name"] for r in exact if r["duplicate_values"] == 0]


def _refuted(df: DataFrame, sets: Sequence[tuple[str, ...]], total: int) -> set[tuple[str, ...]]:
    """Those of the sets, all of one size, that repeat a combination among about TRIED_VALUES of theirs.

    The combinations are chosen by their hash, each with all of its rows, so no key is refuted (but
    for two equal 64-bit hashes among so few).
    """
    columns = sorted({c for s in sets for c in s})
    at = {c: i for i, c in enumerate(columns)}
    hashes = df.select(F.array(*[F.xxhash64(F.col(f"`{c}`")) for c in columns]).alias("h"))
    members = F.array(*[F.array(*[F.lit(at[c]) for c in s]) for s in sets])
    placed = hashes.select("h", F.posexplode(members).alias("set", "of"))
    value = F.xxhash64(*[F.get("h", F.get("of", F.lit(k))) for k in range(len(sets[0]))])
    tried = placed.select("set", value.alias("value")).filter(F.pmod("value", F.lit(max(1, total // TRIED_VALUES))) == 0)
    repeated = tried.groupBy("set", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return {sets[r[0]] for r in repeated.select("set").distinct().collect()}


def _repeating(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Those sets of columns with a combination that occurs more than once, counted exactly in one pass."""
    columns = sorted({c for s in sets for c in s})
    keys = {c: F.col(f"`{c}`") for c in columns}
    grouped = df.groupingSets([[keys[c] for c in s] for s in sets], *keys.values()).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set")
    )
    repeated = {r[0] for r in grouped.filter("__n > 1").select("__set").distinct().collect()}
    bit = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    full = (1 << len(columns)) - 1
    return {s for s in sets if full - sum(bit[c] for c in s) in repeated}


def _by_pivot(sets: Sequence[tuple[str, ...]], values: Mapping[str, float]) -> dict[str, list[tuple[str, ...]]]:
    """The sets by that column of theirs which has the most values."""
    out: dict[str, list[tuple[str, ...]]] = {}
    for s in sets:
        out.setdefault(max(s, key=lambda c: values[c]), []).append(s)
    return out


def _repeating_within(
    df: DataFrame, pivot: str, sets: Sequence[tuple[str, ...]], total: int, rows_per_task: int = ROWS_PER_TASK
) -> set[tuple[str, ...]]:
    """``_repeating`` for sets that all hold the column ``pivot``: the rows are dealt out once, by that column.

    Equal combinations then lie in one task, which counts those of all sets by their hash; nothing is
    shuffled per set. One repeat a set, by hash, is looked up in the rows; were it two values of one
    hash, the set would be counted in full. Rows of a value of the pivot that would fill a task are counted apart, by
    whole combinations, which spread.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in sorted({c for s in sets for c in s})])
    hash_of = F.xxhash64(F.col(f"`{pivot}`"))
    hot = [r[0] for r in hot_keys(kept, [pivot], rows_per_task).select("__key_hash").collect()]
    found: set[tuple[str, ...]] = set()
    cold = kept
    if hot:
        listed = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hot], "h long"))
        found = _repeating(kept.join(listed, hash_of == F.col("h"), "left_semi"), sets)
        cold = kept.join(listed, hash_of == F.col("h"), "left_anti")
    open_sets = [s for s in sets if s not in found]
    if not open_sets:
        return found
    tasks = max(1, math.ceil(total * len(open_sets) / COUNTED_PER_TASK))
    rests = [
        F.struct(F.lit(i).alias("set"), F.xxhash64(*[F.col(f"`{c}`") for c in s if c != pivot]).alias("rest"))
        for i, s in enumerate(open_sets)
    ]
    dealt = cold.repartition(tasks, F.col(f"`{pivot}`")).select(
        F.col(f"`{pivot}`").alias("value"), F.explode(F.array(*rests)).alias("w")
    )
    counted = dealt.groupBy("value", "w.set", "w.rest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    seen = counted.groupBy("set").agg(F.min_by("value", F.struct("rest", F.xxhash64("value"))).alias("value")).collect()
    if not seen:
        return found
    suspects = [open_sets[r["set"]] for r in seen]
    at = df.sparkSession.createDataFrame([(r["value"],) for r in seen], T.StructType([T.StructField("v", df.schema[pivot].dataType)]))
    confirmed = _repeating(cold.join(F.broadcast(at.distinct()), F.col(f"`{pivot}`") == F.col("v"), "left_semi"), suspects)
    doubtful = [s for s in suspects if s not in confirmed]
    return found | confirmed | (_repeating(cold, doubtful) if doubtful else set())


def composite_keys(df: DataFrame, columns: Sequence[str] | None = None, width: int = 3) -> DataFrame:
    """(key_columns, n_columns): the smallest sets of up to ``width`` columns that identify a row.

    Sets grow by one column a level. A set that holds a key is no smallest one, and one whose columns
    have too few distinct values, multiplied, cannot be a key; neither is looked at. Of the others most
    are refuted by a repeated combination among a few; the rest are counted exactly, all sets of a level whose
    column of most values is the same in one pass, which deals the rows out by that column.
    As in a primary key, columns with NULLs take no part. Names are joined by commas in the order of the
    columns. An empty table has no keys.
    """
    chosen = list(dict.fromkeys(columns or df.columns))
    counts = df.agg(
        F.count(F.lit(1)),
        *[F.count_if(F.col(f"`{c}`").isNull()) for c in chosen],
        *[F.approx_count_distinct(F.col(f"`{c}`"), 0.02) for c in chosen],
    ).first()
    total, nulls, values = counts[0], counts[1 : len(chosen) + 1], counts[len(chosen) + 1 :]
    # Half as many again as estimated: twenty-five standard errors.
    most = {c: 1.5 * v for c, n, v in zip(chosen, nulls, values) if total and n == 0}
    keys: list[tuple[str, ...]] = []
    for n in range(1, width + 1):
        level = [
            s for s in combinations(most, n)
            if math.prod(most[c] for c in s) >= total and not any(set(k) <= set(s) for k in keys)
        ]
        refuted = _refuted(df, level, total) if level else set()
        left = [s for s in level if s not in refuted]
        repeating: set[tuple[str, ...]] = set()
        for pivot, own in _by_pivot(left, most).items():
            repeating |= _repeating(df, own) if n == 1 else _repeating_within(df, pivot, own, total)
        keys += [s for s in left if s not in repeating]
    rows = [(",".join(k), len(k)) for k in keys]
    return df.sparkSession.createDataFrame(rows, "key_columns string, n_columns int")


def contract_frame(df: DataFrame, contract: Contract) -> DataFrame:
    """A contract's columns and rules as rows: kind, name, detail, required."""
    rows = [("column", c.name, c.type, c.not_null) for c in contract.columns]
    rows += [("rule", r.name, r.type, True) for r in contract.rules]
    return df.sparkSession.createDataFrame(rows, "kind string, name string, detail string, required boolean")
