"""Contract evolution: differences, compatibility, version bumps, migration of data."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lamina.contracts.model import ColumnSpec, Contract
from lamina.contracts.types import same_type, to_spark_type

BREAKING, COMPATIBLE, PATCH = "breaking", "compatible", "patch"
_BUMP = {BREAKING: "major", COMPATIBLE: "minor", PATCH: "patch"}


@dataclass(frozen=True)
class Change:
    column: str | None
    change: str
    old: str | None
    new: str | None
    impact: str


def _limit(name: str, old, new, tighter) -> Iterable[tuple[str, object, object, str]]:
    if old == new:
        return
    if old is None:
        impact = BREAKING
    elif new is None:
        impact = COMPATIBLE
    else:
        impact = BREAKING if tighter(old, new) else COMPATIBLE
    yield name, old, new, impact


def _column_changes(old: ColumnSpec, new: ColumnSpec) -> Iterable[Change]:
    def change(kind, before, after, impact):
        return Change(new.name, kind, None if before is None else str(before),
                      None if after is None else str(after), impact)

    if to_spark_type(old.type) != to_spark_type(new.type):
        yield change("type", old.type, new.type, BREAKING)
    if old.nullable != new.nullable:
        yield change("nullable", old.nullable, new.nullable, COMPATIBLE if new.nullable else BREAKING)
    for name in ("unique", "not_null"):
        before, after = getattr(old, name), getattr(new, name)
        if before != after:
            yield change(name, before, after, BREAKING if after else COMPATIBLE)
    limits = [
        *_limit("min_value", old.min_value, new.min_value, lambda a, b: b > a),
        *_limit("max_value", old.max_value, new.max_value, lambda a, b: b < a),
        *_limit("pattern", old.pattern, new.pattern, lambda a, b: True),
        *_limit(
            "allowed_values", old.allowed_values, new.allowed_values,
            lambda a, b: not set(a) <= set(b),
        ),
    ]
    for name, before, after, impact in limits:
        yield change(name, before, after, impact)
    if old.deprecated != new.deprecated:
        yield change("deprecated", old.deprecated, new.deprecated, COMPATIBLE)
    if old.description != new.description:
        yield change("description", old.description, new.description, PATCH)


def diff(old: Contract, new: Contract) -> list[Change]:
    """All differences between two contracts, in the order of the new one."""
    found: list[Change] = []
    for spec in new.columns:
        before = old.column(spec.name)
        if before is None:
            impact = COMPATIBLE if spec.nullable and not spec.not_null else BREAKING
            found.append(Change(spec.name, "added", None, spec.type, impact))
        else:
            found += _column_changes(before, spec)
    for spec in old.columns:
        if new.column(spec.name) is None:
            found.append(Change(spec.name, "removed", spec.type, None, BREAKING))
    before, after = {r.name: r for r in old.rules}, {r.name: r for r in new.rules}
    for name in [*after, *(n for n in before if n not in after)]:
        if before.get(name) != after.get(name):
            kind = "rule added" if name not in before else "rule removed" if name not in after else "rule changed"
            found.append(Change(None, kind, name if name in before else None,
                                name if name in after else None, PATCH))
    if old.description != new.description or old.owner != new.owner:
        found.append(Change(None, "documentation", None, None, PATCH))
    return found


def diff_frame(spark: SparkSession, old: Contract, new: Contract) -> DataFrame:
    rows = [(c.column, c.change, c.old, c.new, c.impact) for c in diff(old, new)]
    return spark.createDataFrame(rows, "column_name string, change string, old string, new string, impact string")


def required_bump(changes: Iterable[Change]) -> str | None:
    """``major``, ``minor``, ``patch``, or None without changes."""
    impacts = {c.impact for c in changes}
    for impact in (BREAKING, COMPATIBLE, PATCH):
        if impact in impacts:
            return _BUMP[impact]
    return None


def _version(text: str) -> tuple[int, int, int]:
    major, minor, patch = (int(p) for p in text.split("."))
    return major, minor, patch


def bump_given(old: str, new: str) -> str | None:
    a, b = _version(old), _version(new)
    if b <= a:
        return None
    return "major" if b[0] > a[0] else "minor" if b[1] > a[1] else "patch"


@dataclass(frozen=True)
class Compatibility:
    backward: bool
    forward: bool
    required: str | None
    given: str | None
    allowed: bool
    problems: tuple[str, ...]


def check_compatibility(old: Contract, new: Contract) -> Compatibility:
    """Whether ``new`` may replace ``old`` under the evolution mode of ``new``.

    ``strict`` wants the version bump the changes call for and refuses breaking changes;
    ``lenient`` lets compatible changes pass without a bump; ``auto`` lets everything pass.
    """
    changes = diff(old, new)
    mode = new.evolution.get("migration_strategy", "strict")
    breaking = [c for c in changes if c.impact == BREAKING]
    required, given = required_bump(changes), bump_given(old.version, new.version)
    order = [None, "patch", "minor", "major"]
    problems = []
    if breaking and mode != "auto" and not new.evolution.get("breaking_changes_allowed", False):
        problems += [f"breaking change: {c.change} {c.column}" for c in breaking]
    enough = order.index(given) >= order.index(required)
    if not enough and (mode == "strict" or (mode == "lenient" and breaking)):
        problems.append(f"version {new.version} needs a {required} bump from {old.version}")
    forward = not any(c.change in ("added", "type", "removed") for c in changes)
    return Compatibility(not breaking, forward, required, given, not problems, tuple(problems))


def removable(old: Contract, new: Contract, as_of: date) -> list[str]:
    """Problems with columns removed before their deprecation notice has run out."""
    notice = int(old.evolution.get("deprecation_notice_days") or 0)
    problems = []
    for spec in old.columns:
        if new.column(spec.name) is not None:
            continue
        if not spec.deprecated:
            problems.append(f"column {spec.name} was removed without deprecation")
        elif spec.deprecation_date:
            due = date.fromisoformat(str(spec.deprecation_date))
            if as_of < due:
                problems.append(f"column {spec.name} may be removed from {due} ({notice} days notice)")
    return problems


def deprecation_date(contract: Contract, announced: date) -> date:
    """First day a column announced as deprecated on ``announced`` may be removed."""
    return announced + timedelta(days=int(contract.evolution.get("deprecation_notice_days") or 0))


class MigrationRefused(ValueError):
    pass


def _lost(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Per column that changes its type: whether a row's value would be lost."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return {
        s.name: F.col(f"`{s.name}`").isNotNull() & F.col(f"`{s.name}`").try_cast(to_spark_type(s.type)).isNull()
        for s in contract.columns
        if s.name in actual and not same_type(s.type, actual[s.name])
    }


def failed_casts(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, failed): per column that changes its type, the values that do not convert."""
    lost = _lost(df, contract)
    if not lost:
        return df.sparkSession.createDataFrame([], "column_name string, failed long")
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in lost.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("failed")) for n in lost])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def unconvertible(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows with a value that does not convert, and the names of those columns."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in _lost(df, contract).items()]))
    return df.withColumn("failed_columns", names.cast("array<string>")).filter(F.size("failed_columns") > 0)


def migrate(df: DataFrame, contract: Contract, mode: str | None = None, failed: str = "refuse") -> DataFrame:
    """``df`` in the shape of ``contract``: columns added as NULL, cast, dropped and reordered.

    ``strict`` refuses any difference; ``lenient`` adds nullable columns and refuses the rest;
    ``auto`` does everything. Values that do not convert are counted first, in one pass over the
    columns that change their type, and refuse the migration, unless ``failed="null"`` accepts them
    as NULL; ``unconvertible`` returns the rows that hold them.
    """
    mode = mode or contract.evolution.get("migration_strategy", "strict")
    if mode not in ("strict", "lenient", "auto"):
        raise ValueError(f"Unknown migration mode {mode}")
    actual = {f.name: f.dataType for f in df.schema.fields}
    refused, columns = [], []
    for spec in contract.columns:
        kind = to_spark_type(spec.type)
        if spec.name not in actual:
            if mode == "strict" or (mode == "lenient" and not spec.nullable):
                refused.append(f"missing {spec.name}")
            columns.append(F.lit(None).cast(kind).alias(spec.name))
        elif same_type(spec.type, actual[spec.name]):
            columns.append(F.col(f"`{spec.name}`"))
        else:
            if mode != "auto":
                refused.append(f"type of {spec.name}")
            columns.append(F.col(f"`{spec.name}`").try_cast(kind).alias(spec.name))
    extra = [n for n in actual if contract.column(n) is None]
    if extra and mode == "strict":
        refused.append(f"unexpected {extra}")
    if refused:
        raise MigrationRefused(f"{mode} migration of {contract.dataset} refused: {', '.join(refused)}")
    if failed != "null":
        bad = [f"{r['failed']} values of {r['column_name']}" for r in failed_casts(df, contract).filter("failed > 0").collect()]
        if bad:
            raise MigrationRefused(f"{contract.dataset}: {', '.join(bad)} do not convert")
    return df.select(*columns)
