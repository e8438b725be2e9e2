import json
import random
from datetime import date, datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F, types as T

from lamina.contracts import checks, evolve, generate, shipped
from lamina.contracts.compile import compile_contract
from lamina.contracts.gate import ContractViolation, enforce, require, run_gate
from lamina.contracts.model import ColumnSpec, Contract, ContractStore, Rule
from lamina.contracts.types import same_type, to_contract_type, to_spark_type


def contract(columns, rules=(), sla=None, evolution=None, version="1.0.0"):
    return Contract(version, "t", "silver", "me", "test", tuple(columns), tuple(rules), sla or {}, evolution or {})


def results(df, c, **options):
    return {r["check"]: r for r in checks.validate(df, c, **options).collect()}


# ---------------------------------------------------------------- model and types


def test_types(spark):
    assert to_spark_type("DECIMAL") == T.DecimalType(18, 2)
    assert to_spark_type("decimal(10, 4)") == T.DecimalType(10, 4)
    assert to_spark_type("VARCHAR(255)") == T.StringType()
    with pytest.raises(ValueError):
        to_spark_type("whatever")
    assert to_spark_type("array<int>") == T.ArrayType(T.IntegerType())
    assert to_spark_type("TIMESTAMP") == T.TimestampNTZType()
    assert to_contract_type(T.DecimalType(10, 4)) == "DECIMAL(10,4)"
    assert to_contract_type(T.ShortType()) == "SMALLINT"
    assert to_contract_type(T.MapType(T.StringType(), T.IntegerType())) == "map<string,int>"
    for name in ("BIGINT", "INTEGER", "DOUBLE", "REAL", "BOOLEAN", "DATE", "BLOB", "TIMESTAMP", "TINYINT"):
        assert to_contract_type(to_spark_type(name)) == name
    assert same_type("DECIMAL", T.DecimalType(38, 6)) and same_type("DECIMAL", T.DoubleType())
    assert not same_type("DECIMAL(10,2)", T.DecimalType(10, 3)) and not same_type("DECIMAL", T.LongType())
    assert same_type("TIMESTAMP", T.TimestampType()) and not same_type("INTEGER", T.LongType())


def test_contract_round_trip_and_store(tmp_path):
    for original in shipped.CONTRACTS.values():
        assert Contract.from_dict(original.to_dict()) == original
    (tmp_path / "mine.json").write_text(json.dumps(shipped.PARTNERS.to_dict()))
    pytest.importorskip("yaml")
    text = """
version: "1.0.0"
dataset: y
stage: silver
owner: o
description: d
schema:
  columns:
    - {name: id, type: VARCHAR, nullable: false, constraints: [{unique: true}, {not_null: true}]}
    - {name: v, type: INTEGER, constraints: [{min_value: 0}, {max_value: 9}]}
quality_rules:
  - {name: r, type: custom_sql, query: "SELECT COUNT(*) FROM {dataset} WHERE v > 5", expected: 0}
sla: {}
evolution: {}
"""
    (tmp_path / "y.yml").write_text(text)
    store = ContractStore(str(tmp_path), {"given": shipped.PROJECTS})
    assert store.names() == ["given", "mine", "y"]
    assert store.load("mine.yml") == shipped.PARTNERS
    loaded = store.load("y")
    assert loaded.columns[0].unique and loaded.columns[1].max_value == 9
    assert store.load("y") is loaded
    with pytest.raises(FileNotFoundError):
        store.load("none")
    with pytest.raises(ValueError, match="missing required fields"):
        Contract.from_dict({"version": "1"})
    with pytest.raises(ValueError, match="empty"):
        Contract.from_dict({})


def test_shipped_contracts():
    assert len(shipped.CONTRACTS) == 7
    assert sum(len(c.rules) for c in shipped.CONTRACTS.values()) == 59
    absent = shipped.PARTNERS.absent_personal_columns()
    assert "Phone1" in absent and "CardName" in absent and "Fax" in absent


# ---------------------------------------------------------------- checks


DDL = "id string, n int, kind string, mail string, d decimal(18,2)"
ROWS = [
    ("a", 1, "x", "a@b.de", 1), ("a", -1, "y", "bad", 2), (None, 50, None, None, 3), (None, None, "z", "c@d.e", 4),
]


def sample(spark):
    return spark.createDataFrame([(i, n, k, m, d and __import__("decimal").Decimal(d)) for i, n, k, m, d in ROWS], DDL)


COLUMNS = [
    ColumnSpec("id", "VARCHAR", False, unique=True, not_null=True),
    ColumnSpec("n", "INTEGER", min_value=0, max_value=10),
    ColumnSpec("kind", "VARCHAR", unique=True, allowed_values=("x", "y")),
    ColumnSpec("mail", "VARCHAR", pattern="^[^@]+@[^@]+[.][a-z]{2}$"),
    ColumnSpec("d", "DECIMAL"),
]


def test_every_constraint(spark):
    got = results(sample(spark), contract(COLUMNS))
    observed = {k: (r["passed"], r["observed"], r["severity"]) for k, r in got.items() if r["kind"] != "schema"}
    assert observed == {
        "id.nullable": (False, "2", "error"),
        "id.not_null": (False, "2", "error"),
        "id.unique": (False, "2", "error"),  # NULL counts as a value
        "n.min_value": (False, "1", "error"),
        "n.max_value": (False, "1", "error"),
        "kind.allowed_values": (False, "1", "error"),  # NULL passes
        "kind.unique": (True, "0", "error"),
        "mail.pattern": (False, "2", "warning"),
    }
    assert got["n.min_value"]["message"] == "n.min_value: 1 rows under the lower limit 0"
    assert got["kind.unique"]["message"] is None
    mail = results(sample(spark), contract(COLUMNS), email_like=True)["mail.pattern"]
    assert mail["observed"] == "1"


def test_all_row_checks_share_one_scan(spark, folder):
    sample(spark).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    plan = checks.validate(df, contract(COLUMNS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # row checks, uniqueness


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, 2)], "a int, extra long")
    c = contract([ColumnSpec("a", "VARCHAR"), ColumnSpec("b", "DATE"),
                  ColumnSpec("old", "INTEGER", deprecated=True, replacement="a", deprecation_date="2025-01-05")])
    got = results(df, c)
    assert not got["missing_columns"]["passed"] and got["missing_columns"]["observed"] == "2"
    assert got["extra_columns"]["severity"] == "warning" and not got["extra_columns"]["passed"]
    assert got["a.type"]["message"] == "a has type int where VARCHAR is declared"
    assert got["old.deprecated"]["passed"]
    still = results(df.withColumn("old", F.lit(1)), c)["old.deprecated"]
    assert still["message"] == "old is on its way out until 2025-01-05, use a"
    drift = {r["column_name"]: r["state"] for r in checks.drift_report(df, c).collect()}
    assert drift == {"a": "type", "b": "missing", "old": "missing", "extra": "unexpected"}


def test_rules_and_severity(spark):
    rules = [
        Rule("u", "uniqueness", column="id"),
        Rule("nn", "not_null", "warning", column="n"),
        Rule("vol", "volume", min_rows=5),
        Rule("sql", "custom_sql", query="SELECT COUNT(*) FROM {dataset} WHERE n < 0 OR kind RLIKE '^[a-z]{1}$'", expected=0),
        Rule("scalar", "custom_sql", "warning", query="SELECT MAX(n) FROM {dataset}", expected=49),
        Rule("always", "custom_sql", query="SELECT COUNT(*) FROM {dataset}"),
        Rule("described", "custom_sql", query="SELECT COUNT(*) FROM (DESCRIBE {dataset}) WHERE column_name = 'mail'", expected=0),
        Rule("odd", "mystery"),
        Rule("nocol", "uniqueness"),
        Rule("noquery", "custom_sql", "warning"),
        Rule("wrongcol", "not_null", column="zz"),
        Rule("absent", "absent_columns", columns=("mail",)),
        Rule("viol", "violations", where="n > 10"),
        Rule("badexpr", "violations", where="no_such_column > 10"),
        Rule("pat", "pattern", column="kind", pattern="^x$"),
    ]
    outcome = checks.evaluate(sample(spark), contract([], rules), load_mode="full_load")
    got = {r["check"]: (r["passed"], r["severity"], r["observed"]) for r in outcome.rows if r["kind"] != "schema"}
    assert got == {
        "u": (False, "error", "2"), "nn": (False, "warning", "1"), "vol": (False, "error", "4"),
        "sql": (False, "error", "3"), "scalar": (False, "warning", "50"), "always": (True, "error", "4"),
        "described": (False, "error", "1"), "odd": (False, "warning", None), "nocol": (False, "error", None),
        "noquery": (False, "warning", None), "wrongcol": (False, "error", None), "absent": (False, "error", "1"),
        "viol": (False, "error", "1"), "badexpr": (False, "error", None), "pat": (False, "error", "2"),
    }
    assert not outcome.passed and any("mystery is no rule type" in w for w in outcome.warnings)


def test_a_rule_that_cannot_run_fails_alone(spark):
    rules = [
        Rule("syntax", "custom_sql", query="SELEC 1"),
        Rule("runtime", "custom_sql", "warning", query="SELECT SUM(CAST(kind AS INT)) FROM {dataset}", expected=0),
        Rule("row by row", "violations", "warning", where="CAST(kind AS INT) > 1"),
        Rule("found", "not_null", column="n"),
        Rule("fine", "violations", where="n > 1000"),
        Rule("many", "volume", min_rows=1),
    ]
    outcome = checks.evaluate(sample(spark), contract([], rules))
    got = {r["check"]: (r["passed"], r["observed"]) for r in outcome.rows if r["kind"] != "schema"}
    assert got == {
        "syntax": (False, None), "runtime": (False, None), "row by row": (False, None),
        "found": (False, "1"), "fine": (True, "0"), "many": (True, "4"),
    }
    assert len(outcome.errors) == 2 and len(outcome.warnings) == 3  # extra columns and two rules


def test_load_mode_and_every_row(spark):
    df = spark.range(1000).select("id")
    rules = [
        Rule("full", "not_null", column="id", run_on="full_load"),
        Rule("skip", "not_null", column="id", skip_if="incremental"),
        Rule("always", "violations", where="id < 0"),
    ]
    got = results(df, contract([ColumnSpec("id", "BIGINT")], rules), load_mode="incremental")
    assert "full" not in got and "skip" not in got
    assert got["always"]["observed"] == "0"


def test_increment_against_what_is_published(spark):
    new, old = spark.createDataFrame([(1,), (2,), (None,)], "id long"), spark.createDataFrame([(2,), (2,), (3,), (None,)], "id long")
    rules = [Rule("once", "uniqueness", column="id"), Rule("many", "volume", min_rows=7)]
    c = contract([ColumnSpec("id", "BIGINT", unique=True)], rules)
    got = results(new, c, published=old, published_rows=4)
    assert not got["id.unique"]["passed"] and got["once"]["observed"] == "1" and got["many"]["passed"]
    assert results(new, c)["id.unique"]["passed"] and not results(new, c)["many"]["passed"]


def test_sla(spark, folder):
    spark.range(10).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    sla = {"freshness": {"max_age_hours": 24}, "completeness": {"min_row_count": 20, "expected_growth_rate": 0.5}}
    c = contract([ColumnSpec("id", "BIGINT")], sla=sla)
    got = results(df, c, path=f"{folder}/t", previous_rows=8)
    assert got["freshness"]["passed"]
    assert not got["completeness"]["passed"] and got["completeness"]["observed"] == "10"
    assert got["expected_growth"]["severity"] == "warning" and not got["expected_growth"]["passed"]
    old = results(df, c, path=f"{folder}/t", as_of=datetime(2100, 1, 1))
    assert not old["freshness"]["passed"] and "expected_growth" not in old
    gone = checks.evaluate(df, c, path=f"{folder}/nothing")
    assert any("no file below" in e for e in gone.errors)
    assert "completeness" not in results(df, c, validate_sla=False)


def test_verdict_and_quarantine(spark):
    c = contract(COLUMNS, [Rule("big", "violations", where="d > 3")])
    row = checks.verdict(checks.validate(sample(spark), c)).first()
    assert (row["passed"], row["errors"], row["warnings"]) == (False, 7, 1)
    bad = {(r["id"], r["n"]): r["failed_checks"] for r in checks.quarantine(sample(spark), c).collect()}
    assert bad == {
        ("a", -1): ["n.min_value"],
        (None, 50): ["id.nullable", "id.not_null", "n.max_value"],
        (None, None): ["id.nullable", "id.not_null", "kind.allowed_values", "big"],
    }


def test_changed_since(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),), (None,)], "d date")
    assert checks.changed_since(df, "d", "2024-01-01").count() == 1


# ---------------------------------------------------------------- gate


def test_gate(spark):
    df = spark.range(5)
    good = contract([ColumnSpec("id", "BIGINT", False, unique=True)])
    bad = contract([ColumnSpec("id", "BIGINT", max_value=1), *[ColumnSpec(f"c{i}", "DATE") for i in range(2)]],
                   [Rule(f"r{i}", "violations", where="id > 2") for i in range(4)])
    store = ContractStore(None, {"good": good, "bad": bad})
    functions = {
        "yes": lambda d: True, "pair": lambda d: (d.count() == 4, "five rows"),
        "text": lambda d: "ok", "boom": lambda d: 1 / 0,
    }
    got = {r.check: r for r in run_gate(df, ["contract:good.yml", "contract:bad", "contract:none", "yes", "pair", "text", "boom", "who"], store, functions)}
    assert got["contract:good"].passed and got["yes"].passed
    assert got["contract:bad"].message.count(";") == 5  # all of them
    assert "Contract not found" in got["contract:none"].message
    assert got["pair"].message == "five rows" and not got["pair"].passed
    assert "must return bool" in got["text"].message
    assert "division by zero" in got["boom"].message
    assert got["who"].message == "Quality check not found: who"
    assert enforce("t", df, ["contract:good", "yes"], store=store, functions=functions)
    with pytest.raises(ContractViolation, match="1 of 2 checks failed"):
        enforce("t", df, ["contract:good", "pair"], store=store, functions=functions)
    assert require(df, good).passed
    with pytest.raises(ContractViolation, match="FAILED"):
        require(df, bad)


# ---------------------------------------------------------------- generation and compilation


def test_generate_contract(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "a", "y")], "id long, v string, w string")
    c = generate.generate_contract(df, "t", "bronze")
    assert [(s.name, s.type, s.nullable, s.not_null) for s in c.columns] == [
        ("id", "BIGINT", False, True), ("v", "VARCHAR", True, False), ("w", "VARCHAR", False, True),
    ]
    assert [r.name for r in c.rules] == ["no_null_id", "no_null_w", "minimum_rows"]
    assert c.description == "t dataset in bronze stage" and c.sla["freshness"]["max_age_hours"] == 24
    assert checks.evaluate(df, c).passed
    empty = generate.generate_contract(df.filter("id > 5"), "t", "bronze")
    assert all(s.nullable for s in empty.columns)


def test_key_candidates(spark):
    df = spark.range(2000).select("id", (F.col("id") % 10).alias("ten"), F.when(F.col("id") < 1999, F.col("id")).otherwise(3).alias("near"))
    assert generate.key_candidates(df) == ["id"]


def test_compiled_contract(spark):
    c = contract([
        ColumnSpec("id", "VARCHAR", unique=True, not_null=True), ColumnSpec("work_email_hash", "VARCHAR"),
        ColumnSpec("land_code", "VARCHAR"), ColumnSpec("zip_code", "INTEGER"),
        ColumnSpec("n", "INTEGER", min_value=1, max_value=5), ColumnSpec("day", "DATE"),
        ColumnSpec("processed_at", "TIMESTAMP"),
    ])
    rows = [("a", "m", "deu", 1, 3, date(2024, 1, 1)), ("a", "m2", "fra", 1, 4, date(2024, 1, 2)),
            (None, "x", "de", 1, 3, None), ("b", None, "de", 1, None, None), ("c", None, None, 1, 9, None), ("d", None, "x", 2, 5, None)]
    df = spark.createDataFrame(rows, "id string, work_email string, land string, zip_code int, n int, day date")
    out = compile_contract(c)(df)
    assert out.columns == [s.name for s in c.columns] and dict(out.dtypes)["processed_at"] == "timestamp_ntz"
    got = {r["id"]: (r["land_code"], r["zip_code"], r["n"]) for r in out.collect()}
    assert got == {"a": ("FR", 1, 4), "d": ("X", 2, 5)}


# ---------------------------------------------------------------- evolution


BASE = [ColumnSpec("id", "VARCHAR", False, not_null=True), ColumnSpec("amount", "DECIMAL", min_value=0),
        ColumnSpec("kind", "VARCHAR", allowed_values=("a", "b", "c"))]


def changed(**swap):
    return [swap.get(c.name, c) for c in BASE if swap.get(c.name, c) is not None]


@pytest.mark.parametrize("columns,bump", [
    (BASE, None),
    ([*BASE, ColumnSpec("new", "VARCHAR")], "minor"),
    ([*BASE, ColumnSpec("new", "VARCHAR", False)], "major"),
    (changed(amount=None), "major"),
    (changed(amount=ColumnSpec("amount", "INTEGER", min_value=0)), "major"),
    (changed(amount=ColumnSpec("amount", "DECIMAL", min_value=-100)), "minor"),
    (changed(amount=ColumnSpec("amount", "DECIMAL", min_value=10)), "major"),
    (changed(amount=ColumnSpec("amount", "DECIMAL", min_value=0, max_value=9)), "major"),
    (changed(amount=ColumnSpec("amount", "DECIMAL", False, min_value=0)), "major"),
    (changed(id=ColumnSpec("id", "VARCHAR")), "minor"),
    (changed(kind=ColumnSpec("kind", "VARCHAR", allowed_values=("a", "b", "c", "d"))), "minor"),
    (changed(kind=ColumnSpec("kind", "VARCHAR", allowed_values=("a", "b"))), "major"),
    (changed(kind=ColumnSpec("kind", "VARCHAR", deprecated=True, allowed_values=("a", "b", "c"))), "minor"),
    (changed(kind=ColumnSpec("kind", "VARCHAR", description="x", allowed_values=("a", "b", "c"))), "patch"),
])
def test_required_bump(columns, bump):
    assert evolve.required_bump(evolve.diff(contract(BASE), contract(columns))) == bump


def test_rule_changes_are_patches(spark):
    new = contract(BASE, [Rule("r", "volume", min_rows=1)])
    assert evolve.required_bump(evolve.diff(contract(BASE), new)) == "patch"
    frame = evolve.diff_frame(spark, contract(BASE), new).collect()
    assert [(r["change"], r["new"], r["impact"]) for r in frame] == [("rule added", "r", "patch")]


def test_compatibility_modes():
    old = contract(BASE)
    added = [*BASE, ColumnSpec("new", "VARCHAR")]

    def check(columns, version, mode, allowed=False):
        evolution = {"migration_strategy": mode, "breaking_changes_allowed": allowed}
        return evolve.check_compatibility(old, contract(columns, evolution=evolution, version=version))

    assert not check(added, "1.0.0", "strict").allowed
    good = check(added, "1.1.0", "strict")
    assert good.allowed and good.backward and not good.forward
    assert check(added, "1.0.0", "lenient").allowed
    assert not check(changed(amount=None), "2.0.0", "lenient").allowed
    assert check(changed(amount=None), "2.0.0", "strict", True).allowed
    assert not check(changed(amount=None), "1.1.0", "strict", True).allowed
    assert check(changed(amount=None), "1.0.0", "auto").allowed


def test_removal_needs_notice():
    old = contract([*BASE, ColumnSpec("x", "DATE", deprecated=True, deprecation_date="2025-01-05"), ColumnSpec("y", "DATE")],
                   evolution={"deprecation_notice_days": 30})
    new = contract(BASE)
    assert len(evolve.removable(old, new, date(2025, 1, 1))) == 2
    assert evolve.removable(old, new, date(2025, 1, 6)) == ["column y was removed without deprecation"]
    assert evolve.deprecation_date(old, date(2024, 12, 6)) == date(2025, 1, 5)


def test_migrate(spark):
    df = spark.createDataFrame([("1", "x", 5), ("z", "y", 6)], "n string, gone string, v int")
    target = contract([ColumnSpec("v", "INTEGER"), ColumnSpec("n", "INTEGER"), ColumnSpec("added", "DATE")])
    with pytest.raises(evolve.MigrationRefused, match="1 values of n"):
        evolve.migrate(df, target, "auto")
    assert [tuple(r) for r in evolve.failed_casts(df, target).collect()] == [("n", 1)]
    assert [r["failed_columns"] for r in evolve.unconvertible(df, target).collect()] == [["n"]]
    out = evolve.migrate(df, target, "auto", failed="null")
    assert out.dtypes == [("v", "int"), ("n", "int"), ("added", "date")]
    assert sorted(tuple(r) for r in out.collect()) == [(5, 1, None), (6, None, None)]
    with pytest.raises(evolve.MigrationRefused, match="type of n"):
        evolve.migrate(df, target, "lenient")
    with pytest.raises(evolve.MigrationRefused, match="unexpected"):
        evolve.migrate(df, target)
    lenient = evolve.migrate(df, contract([ColumnSpec("n", "VARCHAR"), ColumnSpec("added", "DATE")]), "lenient")
    assert lenient.columns == ["n", "added"]
    with pytest.raises(ValueError):
        evolve.migrate(df, target, "odd")


def test_composite_keys_against_all_sets(spark):
    rng = random.Random(3)
    names = ["a", "b", "c", "d", "e.f"]
    for rows in (1, 12, 300):
        data = [tuple(rng.randint(0, k) for k in (3, 9, 30, 200, 1)) for _ in range(rows)]
        df = spark.createDataFrame(data, "a int, b long, c int, d int, `e.f` int").withColumn("gap", F.expr("nullif(a, a)"))
        want = []
        for n in (1, 2, 3):
            for s in combinations(range(5), n):
                if len({tuple(r[i] for i in s) for r in data}) == rows and not any(k <= set(s) for k in want):
                    want.append(set(s))
        got = generate.composite_keys(df).collect()
        assert {r["key_columns"] for r in got} == {",".join(names[i] for i in sorted(k)) for k in want}
        assert all(len(r["key_columns"].split(",")) == r["n_columns"] for r in got)
    assert generate.composite_keys(df.limit(0)).count() == 0
    doubled = df.union(df)  # repeated rows: nothing identifies one
    assert generate.composite_keys(doubled).count() == 0


def test_composite_keys_deal_rows_out_once(spark):
    # All sets of a level hold "a", so the rows are dealt out by it once, not once a set.
    rng = random.Random(5)
    rows = [(i // 4, rng.randint(0, 60), rng.randint(0, 900), rng.randint(0, 900), rng.randint(0, 900)) for i in range(2000)]
    names = "abcde"
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    sets = [s for s in combinations(names, 3) if "a" in s] + [("a", "b"), ("a", "c")]
    for n in (2, 3):
        level = [s for s in sets if len(s) == n]
        want = {s for s in level if len({tuple(r[names.index(c)] for c in s) for r in rows}) < len(rows)}
        for limit in (3, 10_000):  # at 3 rows a task every value of "a" is hot
            assert generate._repeating_within(df, "a", level, len(rows), limit) == want
    assert generate._by_pivot([("a", "b"), ("b", "c")], {"a": 9.0, "b": 5.0, "c": 2.0}) == {"a": [("a", "b")], "b": [("b", "c")]}
