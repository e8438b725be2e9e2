"""Contract checks as Spark aggregates.

All checks that look at one row at a time, whatever their number, are counted in a single pass
over the data. Uniqueness of all key columns shares one more pass. Free SQL rules are one query
each. The result is a small DataFrame with one row per check.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import (
    AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException,
    IllegalArgumentException, NumberFormatException, ParseException, PySparkException, SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lamina.contracts.model import ColumnSpec, Contract, Rule
from lamina.contracts.types import same_type
from lamina.functions.exprs import none_of
from lamina.operators.masking import column_catalogue, present_columns

RESULT = (
    "check string, kind string, severity string, passed boolean, "
    "observed string, expected string, message string"
)

# A rule that counts the rows meeting a condition needs no query of its own.
_COUNT_WHERE = re.compile(
    r"^\s*SELECT\s+COUNT\(\s*\*\s*\)\s+FROM\s+\{dataset\}\s+WHERE\s+(?P<where>.+?)\s*;?\s*$",
    re.IGNORECASE | re.DOTALL,
)


@dataclass(frozen=True)
class RowCheck:
    """Rows meeting ``violated`` are violations; the check passes at zero."""

    name: str
    kind: str
    severity: str
    violated: Column
    text: str


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- checks of one column


def column_checks(spec: ColumnSpec, email_like: bool = False) -> list[RowCheck]:
    """Row checks of a column's declaration. NULL passes all but the not-null checks."""
    c, found = _col(spec.name), []

    def add(kind: str, violated: Column, text: str, severity: str = "error") -> None:
        found.append(RowCheck(f"{spec.name}.{kind}", kind, severity, violated, text))

    if not spec.nullable:
        add("nullable", c.isNull(), "rows without a value that must be there")
    if spec.not_null:
        add("not_null", c.isNull(), "rows without a value")
    if spec.min_value is not None:
        add("min_value", c < F.lit(spec.min_value), f"rows under the lower limit {spec.min_value}")
    if spec.max_value is not None:
        add("max_value", c > F.lit(spec.max_value), f"rows over the upper limit {spec.max_value}")
    if spec.allowed_values is not None:
        allowed = list(spec.allowed_values)
        add("allowed_values", none_of(c, allowed), f"rows with anything but {allowed}")
    if spec.pattern is not None:
        if email_like:
            if "@" in spec.pattern:
                odd = c.isNotNull() & ~c.like("%@%.%")
                add("pattern", odd, "rows that look unlike the pattern", "warning")
        else:
            odd = c.isNotNull() & ~c.rlike(spec.pattern)
            add("pattern", odd, f"rows unlike {spec.pattern}", "warning")
    return found


def _rule_check(df: DataFrame, rule: Rule) -> RowCheck | None:
    """The rule as a row check, where it is one."""
    kind, text = rule.type, "rows against the rule"
    if rule.type == "not_null" and rule.column:
        violated, text = _col(rule.column).isNull(), f"rows without {rule.column}"
    elif rule.type == "pattern" and rule.column and rule.pattern:
        c = _col(rule.column)
        violated, text = c.isNotNull() & ~c.rlike(rule.pattern), f"rows unlike {rule.pattern}"
    elif rule.type == "violations" and rule.where:
        violated = F.expr(rule.where)
    elif rule.type == "custom_sql" and rule.query and rule.expected == 0:
        match = _COUNT_WHERE.match(rule.query)
        if match is None:
            return None
        try:
            violated = F.expr(match.group("where"))
            df.agg(F.count_if(violated))  # analysis only: refuses anything but a plain condition
        except PySparkException:
            return None
    else:
        return None
    return RowCheck(rule.name, kind, rule.severity, violated, text)


# ---------------------------------------------------------------- result rows


def _result(
    name: str, kind: str, severity: str, passed: Column, observed: Column, expected: Any, text: Column
) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(kind).alias("kind"),
        F.lit(severity).alias("severity"),
        passed.alias("passed"),
        observed.cast("string").alias("observed"),
        F.lit(None if expected is None else str(expected)).cast("string").alias("expected"),
        F.when(~passed, text).cast("string").alias("message"),
    )


def _rows(one_row: DataFrame, results: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def _static(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), RESULT)


def _schema_rows(df: DataFrame, contract: Contract) -> list[tuple]:
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = [c.name for c in contract.columns]
    missing = [n for n in expected if n not in actual]
    extra = [n for n in actual if n not in expected]
    rows = [
        ("missing_columns", "schema", "error", not missing, str(len(missing)), "0",
         f"the data lacks {missing}" if missing else None),
        ("extra_columns", "schema", "warning", not extra, str(len(extra)), "0",
         f"the contract does not know {extra}" if extra else None),
    ]
    for c in contract.columns:
        if c.name in actual:
            fits = same_type(c.type, actual[c.name])
            shown = actual[c.name].simpleString()
            rows.append(
                (f"{c.name}.type", "schema", "error", fits, shown, c.type,
                 None if fits else f"{c.name} has type {shown} where {c.type} is declared")
            )
        if c.deprecated:
            hint = f", use {c.replacement}" if c.replacement else ""
            due = f" until {c.deprecation_date}" if c.deprecation_date else ""
            gone = c.name not in actual
            rows.append(
                (f"{c.name}.deprecated", "schema", "warning", gone, str(int(not gone)), "0",
                 None if gone else f"{c.name} is on its way out{due}{hint}")
            )
    return rows


def _counted(
    df: DataFrame, checks: list[RowCheck], volumes: list[tuple], published_rows: int = 0
) -> DataFrame:
    """One aggregate for all row checks and row-count checks. ``volumes``: (name, kind,
    severity, minimum); rows published before count too."""
    counts = [(F.count(F.lit(1)) + published_rows).alias("rows")]
    counts += [F.count_if(c.violated).alias(f"c{i}") for i, c in enumerate(checks)]
    results = []
    for i, c in enumerate(checks):
        n = F.col(f"c{i}")
        message = F.concat(F.lit(f"{c.name}: "), n.cast("string"), F.lit(f" {c.text}"))
        results.append(_result(c.name, c.kind, c.severity, n == 0, n, 0, message))
    for name, kind, severity, minimum in volumes:
        n = F.col("rows")
        message = F.concat(
            F.lit(f"{name}: rows: "), n.cast("string"), F.lit(f", at least {minimum} wanted")
        )
        results.append(_result(name, kind, severity, n >= minimum, n, minimum, message))
    return _rows(df.agg(*counts), results)


def duplicate_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: per column, how many of its values (NULL included) occur more than once.

    Several columns share one scan through grouping sets; counts are combined before the
    shuffle, so a value on a third of all rows costs no more than any other.
    """
    if len(columns) == 1:
        grouped = df.groupBy(_col(columns[0])).agg(F.count(F.lit(1)).alias("__n"))
        return grouped.agg(F.count_if(F.col("__n") > 1).alias("d0"))
    keys = [_col(c) for c in columns]
    grouped = df.groupingSets([[k] for k in keys], *keys).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set")
    )
    # grouping_id has one bit per column, set where the column is not part of the group.
    full = (1 << len(columns)) - 1
    return grouped.agg(
        *[
            F.count_if((F.col("__n") > 1) & (F.col("__set") == full ^ (1 << (len(columns) - 1 - i))))
            .alias(f"d{i}")
            for i in range(len(columns))
        ]
    )


def _with_published(df: DataFrame, published: DataFrame, column: str) -> DataFrame:
    """The column's new values, and once more those that are published already."""
    new = df.select(_col(column))
    return new.union(published.select(_col(column)).join(new.distinct(), column, "left_semi"))


def _uniqueness(
    df: DataFrame, wanted: list[tuple[str, str, str, str]], published: DataFrame | None = None
) -> DataFrame:
    """``wanted``: (check, kind, severity, column)."""
    columns = list(dict.fromkeys(column for *_, column in wanted))
    results = []
    for name, kind, severity, column in wanted:
        n = F.col(f"d{columns.index(column)}")
        message = F.concat(F.lit(f"{name}: "), n.cast("string"), F.lit(f" values of {column} come more than once"))
        results.append(_result(name, kind, severity, n == 0, n, 0, message))
    if published is None:
        return _rows(duplicate_counts(df, columns), results)
    each = [
        duplicate_counts(_with_published(df, published, c), [c]).withColumnRenamed("d0", f"d{i}")
        for i, c in enumerate(columns)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)
    return _rows(stacked.agg(*[F.max(f"d{i}").alias(f"d{i}") for i in range(len(columns))]), results)


def _custom_sql(df: DataFrame, rule: Rule, view: str) -> DataFrame:
    """Scalar query over the data. ``{dataset}`` is the data, ``{columns}`` its schema as rows;
    ``(DESCRIBE {dataset})`` means the latter."""
    spark = df.sparkSession
    described = f"{view}_columns"
    query = rule.query.replace("(DESCRIBE {dataset})", described).replace("{columns}", described)
    query = query.replace("{dataset}", view)
    df.createOrReplaceTempView(view)
    column_catalogue(df).createOrReplaceTempView(described)
    answer = spark.sql(query)
    value = F.first(answer.columns[0]).alias("value")
    observed = F.col("value")
    expected = rule.expected
    if expected is None:
        equal = F.lit(True)
    elif isinstance(expected, bool):
        equal = observed.cast("boolean") == F.lit(expected)
    elif isinstance(expected, str):
        equal = observed.cast("string") == F.lit(expected)
    else:
        equal = observed.cast("double") == F.lit(float(expected))
    passed = F.coalesce(equal, F.lit(False))
    message = F.concat(
        F.lit(f"{rule.name}: the query gave "),
        F.coalesce(observed.cast("string"), F.lit("NULL")),
        F.lit(f" instead of {rule.expected}"),
    )
    result = _result(rule.name, rule.type, rule.severity, passed, observed, rule.expected, message)
    return _rows(answer.agg(value), [result])


# ---------------------------------------------------------------- service levels


def newest_file(spark: SparkSession, path: str) -> DataFrame:
    """One row with the youngest modification time below ``path``; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if not path.rstrip("/").endswith(".parquet"):
        reader = reader.option("pathGlobFilter", "*.parquet")
    return reader.load(path).agg(F.max("modificationTime").alias("newest"))


def freshness(spark: SparkSession, path: str, max_age_hours: float, as_of: Any = None) -> DataFrame:
    """Age of the data in hours against the allowed age; missing data is a failure."""
    name = "freshness"
    try:
        newest = newest_file(spark, path)
    except PySparkException:
        newest = spark.range(1).select(F.lit(None).cast("timestamp").alias("newest"))
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    age = (now.cast("double") - F.col("newest").cast("double")) / 3600.0
    passed = F.coalesce(age <= F.lit(float(max_age_hours)), F.lit(False))
    message = F.coalesce(
        F.concat(
            F.lit("newest file is "), F.format_number(age, 1),
            F.lit(f" hours old; {max_age_hours} are allowed"),
        ),
        F.lit(f"no file below {path}"),
    )
    result = _result(name, "sla", "error", passed, F.format_number(age, 1), max_age_hours, message)
    return _rows(newest, [result])


def data_freshness(df: DataFrame, column: str, max_age_hours: float, as_of: Any = None) -> DataFrame:
    """Age in hours of the newest value of a time column against the allowed age; no value fails."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    newest = df.agg(F.max(_col(column)).cast("timestamp").alias("newest"))
    age = F.round((now.cast("double") - F.col("newest").cast("double")) / 3600.0, 1)
    passed = F.coalesce(age <= F.lit(float(max_age_hours)), F.lit(False))
    message = F.concat(F.lit(f"newest {column} is "), F.coalesce(age.cast("string"), F.lit("unknown")), F.lit(" hours back"))
    result = _result(f"{column}.freshness", "sla", "error", passed, age, float(max_age_hours), message)
    return _rows(newest, [result])


def _growth(df: DataFrame, rate: float, previous_rows: int) -> DataFrame:
    """Warns when the row count grew by less than the expected rate since the last load."""
    n = F.col("rows")
    needed = F.lit(previous_rows * (1 + rate))
    message = F.concat(
        n.cast("string"), F.lit(f" rows, {previous_rows} before; growth by {rate} was planned")
    )
    result = _result("expected_growth", "sla", "warning", n >= needed, n, rate, message)
    return _rows(df.agg(F.count(F.lit(1)).alias("rows")), [result])


# ---------------------------------------------------------------- whole contract


@dataclass(frozen=True)
class Piece:
    """Checks computed together. ``parts`` are the same checks one by one, for when the whole
    cannot run."""

    label: str
    severity: str
    build: Callable[[], DataFrame]
    parts: tuple["Piece", ...] = ()


def plan_checks(
    df: DataFrame,
    contract: Contract,
    path: str | None = None,
    as_of: Any = None,
    load_mode: str = "full_load",
    previous_rows: int | None = None,
    validate_sla: bool = True,
    email_like: bool = False,
    published: DataFrame | None = None,
    published_rows: int = 0,
) -> list[Piece]:
    """The contract's checks as pieces that can run independently.

    ``published`` are the rows an increment is added to, ``published_rows`` their number: a key must
    not be there already, and row counts are those of the whole.
    """
    spark, present = df.sparkSession, set(df.columns)
    rules = [r for r in contract.rules if r.applies(load_mode)]
    columns = [c for c in contract.columns if c.name in present]
    row_checks = [check for c in columns for check in column_checks(c, email_like)]
    unique = [(f"{c.name}.unique", "unique", "error", c.name) for c in columns if c.unique]
    volumes: list[tuple] = []
    static = _schema_rows(df, contract)
    pieces: list[Piece] = []

    def failed(rule: Rule, text: str, severity: str | None = None) -> None:
        static.append(
            (rule.name, rule.type, severity or rule.severity, False, None, None, f"{rule.name}: {text}")
        )

    for rule in rules:
        check = _rule_check(df, rule) if rule.column is None or rule.column in present else None
        if rule.type in ("uniqueness", "not_null", "pattern") and not rule.column:
            failed(rule, f"a {rule.type} rule names its column")
        elif rule.column is not None and rule.column not in present:
            failed(rule, f"there is no {rule.column}")
        elif check is not None:
            try:
                df.agg(F.count_if(check.violated))
                row_checks.append(check)
            except PySparkException as wrong:
                failed(rule, f"could not be evaluated: {wrong}")
        elif rule.type == "uniqueness":
            unique.append((rule.name, rule.type, rule.severity, rule.column))
        elif rule.type == "volume":
            if rule.min_rows is not None:
                volumes.append((rule.name, rule.type, rule.severity, rule.min_rows))
        elif rule.type == "absent_columns":
            found = present_columns(df, rule.columns)
            static.append(
                (rule.name, rule.type, rule.severity, not found, str(len(found)), "0",
                 f"{rule.name}: {found} may not be in the data" if found else None)
            )
        elif rule.type == "custom_sql":
            if not rule.query:
                failed(rule, "a custom_sql rule has a query")
            else:
                view = f"contract_{uuid.uuid4().hex}"
                build = lambda r=rule, v=view: _custom_sql(df, r, v)
                pieces.append(Piece(rule.name, rule.severity, build))
        else:
            failed(rule, f"{rule.type} is no rule type", "warning")

    if validate_sla:
        complete = contract.sla.get("completeness") or {}
        if "min_row_count" in complete:
            volumes.append(("completeness", "sla", "error", complete["min_row_count"]))
        if "expected_growth_rate" in complete and previous_rows is not None:
            rate = complete["expected_growth_rate"]
            growth = lambda: _growth(df, rate, previous_rows)
            pieces.append(Piece("expected_growth", "warning", growth))
        fresh = contract.sla.get("freshness") or {}
        if path is not None and "max_age_hours" in fresh:
            hours = fresh["max_age_hours"]
            pieces.append(Piece("freshness", "error", lambda: freshness(spark, path, hours, as_of)))

    if row_checks or volumes:
        parts = [Piece(c.name, c.severity, lambda c=c: _counted(df, [c], [])) for c in row_checks] + [
            Piece(v[0], v[2], lambda v=v: _counted(df, [], [v], published_rows)) for v in volumes
        ]
        pieces.append(
            Piece("row checks", "error", lambda: _counted(df, row_checks, volumes, published_rows), tuple(parts))
        )
    if unique:
        pieces.append(Piece("uniqueness", "error", lambda: _uniqueness(df, unique, published)))
    pieces.append(Piece("schema", "error", lambda: _static(spark, static)))
    return pieces


def validate(df: DataFrame, contract: Contract, **options: Any) -> DataFrame:
    """All checks of a contract as one lazy DataFrame; options as in :func:`plan_checks`."""
    built = [piece.build() for piece in plan_checks(df, contract, **options)]
    return reduce(DataFrame.unionByName, built)


@dataclass(frozen=True)
class Outcome:
    """Collected check results (one small row per check)."""

    dataset: str
    rows: tuple

    @property
    def errors(self) -> list[str]:
        return [r["message"] for r in self.rows if not r["passed"] and r["severity"] == "error"]

    @property
    def warnings(self) -> list[str]:
        return [r["message"] for r in self.rows if not r["passed"] and r["severity"] != "error"]

    @property
    def passed(self) -> bool:
        return not self.errors

    def summary(self) -> str:
        state = "PASSED" if self.passed else "FAILED"
        return f"{self.dataset}: {state} ({len(self.errors)} errors, {len(self.warnings)} warnings)"


# Errors of a rule or of the data it meets. Anything else, such as a lost cluster, is raised.
RULE_ERRORS = (
    AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException,
    IllegalArgumentException, NumberFormatException, ParseException, SparkRuntimeException,
)


def evaluate(df: DataFrame, contract: Contract, **options: Any) -> Outcome:
    """Run all checks together; if one cannot run, one by one, so that it fails by itself."""
    pieces = plan_checks(df, contract, **options)
    rows: list = []

    def attempt(piece: Piece) -> None:
        try:
            rows.extend(piece.build().collect())
        except RULE_ERRORS as wrong:
            if len(piece.parts) > 1:
                for part in piece.parts:
                    attempt(part)
                return
            rows.append(
                dict(check=piece.label, kind="error", severity=piece.severity, passed=False,
                     observed=None, expected=None, message=f"{piece.label} could not be evaluated: {wrong}")
            )

    try:
        return Outcome(contract.dataset, tuple(reduce(DataFrame.unionByName, [p.build() for p in pieces]).collect()))
    except RULE_ERRORS:
        for piece in pieces:
            attempt(piece)
    return Outcome(contract.dataset, tuple(rows))


def verdict(results: DataFrame) -> DataFrame:
    """One row: whether the contract holds, with the number of failed errors and warnings."""
    bad, err = ~F.col("passed"), F.col("severity") == "error"
    return results.agg(
        F.bool_and(F.col("passed") | ~err).alias("passed"),
        F.count_if(bad & err).alias("errors"),
        F.count_if(bad & ~err).alias("warnings"),
    )


def quarantine(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows violating any error-level row check, with the names of the checks they fail."""
    checks = [c for spec in contract.columns if spec.name in df.columns for c in column_checks(spec)]
    for rule in contract.rules:
        if rule.column is None or rule.column in df.columns:
            check = _rule_check(df, rule)
            if check is not None:
                checks.append(check)
    checks = [c for c in checks if c.severity == "error"]
    names = F.array(*[F.when(c.violated, F.lit(c.name)) for c in checks])
    return df.withColumn("failed_checks", F.array_compact(names)).filter(F.size("failed_checks") > 0)


def changed_since(df: DataFrame, column: str, last_check: Any) -> DataFrame:
    """Only rows changed after the last validation, as input for :func:`validate`."""
    kind = df.schema[column].dataType
    return df.filter(_col(column) > F.lit(last_check).cast(kind))


def drift_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Schema expected by the contract against the schema of the data, one row per column."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for c in contract.columns:
        found = actual.get(c.name)
        if found is None:
            state = "missing"
        else:
            state = "ok" if same_type(c.type, df.schema[c.name].dataType) else "type"
        rows.append((c.name, c.type, found, state))
    known = {c.name for c in contract.columns}
    rows += [(n, None, t, "unexpected") for n, t in actual.items() if n not in known]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected string, actual string, state string"
    )


__all__ = [
    "validate", "evaluate", "verdict", "quarantine", "freshness", "drift_report",
    "changed_since", "duplicate_counts", "column_checks", "Outcome", "newest_file",
]
