import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lamina.functions import exprs
from lamina.contracts import checks, shipped
from lamina.contracts.gate import ContractViolation, DatasetsRefused
from lamina.operators import linkage
from lamina.plans import gold, jobs, kpi, silver
from lamina.plans.transforms import Input, Transform, map_batches, run_transform
from lamina.session import cut_lineage, drop_steps, step_copies
from lamina.sources import files
from lamina.sources.landing import Source

HASH = "a" * 64
TODAY = date(2024, 6, 30)
D = Decimal

OCRD = (
    "CardCode string, CardName_Hash string, CardType string, GroupCode int, Territory int, SlpCode int, "
    "Currency string, CreateDate date, UpdateDate date, Balance decimal(18,2), CreditLine decimal(18,2), "
    "frozenFor string, FrozenFrom date, FrozenTo date, DebPayAcct string, Discount decimal(18,2), "
    "ValidFrom date, ValidTo date"
)
OINV = "DocEntry long, DocNum long, CardCode string, SlpCode int, DocDate date, DocTotal decimal(18,2), DocStatus string"
LINE = "DocEntry long, ItemCode string, Project string, LineTotal decimal(18,2)"
OPRJ = (
    "PrjCode string, PrjName_Hash string, CardCode string, Active string, ValidFrom date, ValidTo date, "
    "DueDate date, ClosingDate date, CreateDate date, UpdateDate date, FinncPriod int"
)


def partner(code="c1", hash_=HASH, kind="C", updated=None, created=None, balance=None, credit=None, frozen=None):
    return (code, hash_, kind, 1, 1, 7, " usd ", created, updated, balance, credit, frozen,
            None, None, None, None, None, None)


def project(code="p1", hash_=HASH, active="Y", start=None, end=None, due=None, closing=None, updated=None):
    return (code, hash_, "c1", active, start, end, due, closing, None, updated, 1)


# ---------------------------------------------------------------- silver


def test_partners(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    rows = [
        partner("c1", updated=d1, balance=D(1)), partner("c1", updated=d2, balance=D(2)),
        partner("c1", updated=None, balance=D(3)), partner("C1", kind="S"), partner("c2", kind="c"),
        partner("c3", kind="X"), partner("", kind="C"), partner(None), partner("c4", hash_="short"),
        partner("c5", hash_=None), partner("c6", kind=None), partner("c7", kind=" C"),
    ]
    out = silver.partners(spark.createDataFrame(rows, OCRD))
    got = {r["CardCode"]: r for r in out.collect()}
    assert set(got) == {"c1", "C1"}
    assert got["c1"]["Balance"] == 2 and got["C1"]["Balance"] == 0
    assert (got["C1"]["CreditLine"], got["C1"]["frozenFor"], got["C1"]["DebPayAcct"], got["C1"]["Currency"]) == (0, "N", "", "USD")
    outcome = checks.evaluate(out, shipped.PARTNERS)
    assert outcome.passed, outcome.errors


def test_projects(spark):
    a, b = date(2024, 1, 1), date(2024, 2, 1)
    rows = [
        project("ok", start=a, end=b), project("bad range", start=b, end=a), project("open", start=a),
        project("closed early", start=b, due=b, closing=a), project("no start", due=b, closing=b),
        project("no due", start=b, closing=a), project(""), project(None), project("h", hash_="x"),
    ]
    out = silver.projects(spark.createDataFrame(rows, OPRJ))
    assert {r["PrjCode"] for r in out.collect()} == {"ok", "open", "no due"}
    assert checks.evaluate(out, shipped.PROJECTS).passed


def test_employees(spark):
    rows = [(1, HASH, "Y", None, 1), (2, HASH, "N", D(-5), 2), (3, HASH, None, D(0), 3), (4, HASH, "Y", D(100), 4),
            (5, HASH, "Y", D(120), 5), (5, HASH, "Y", D(120), 6), (6, "x", "Y", D(1), 7), (None, HASH, "Y", D(1), 8)]
    df = spark.createDataFrame(rows, "SlpCode int, SlpName_Hash string, Active string, Commission decimal(18,2), EmployeeID int")
    for n in (1, 7):
        out = silver.employees(df.repartition(n))
        got = {r["SlpCode"]: (r["Commission"], r["EmployeeID"]) for r in out.collect()}
        assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (100, 4), 5: (100, 5)}
    assert checks.evaluate(silver.employees(df), shipped.EMPLOYEES).passed


# ---------------------------------------------------------------- gold


def invoices(spark, *rows):
    return spark.createDataFrame(rows, OINV)


def lines(spark, *rows):
    return spark.createDataFrame(rows, LINE)


def test_revenue_metrics_fan_out(spark):
    day = date(2024, 1, 1)
    inv = invoices(
        spark, (1, 1, "c1", 7, day, D(100), "C"), (2, 2, "c1", 7, day, D(50), "O"),
        (3, 3, "c9", 7, day, D(10), "O"), (4, 4, "c1", 7, None, D(5), "O"), (5, 5, "c1", 8, day, D(-9), "O"),
        (6, 6, "c1", 9, day, None, "O"), (7, 7, None, 7, day, D(1), "O"), (1, 1, "c1", 7, day, D(100), "C"),
    )
    det = lines(
        spark, (1, "i", "p1", D(1)), (1, "j", "p1", D(1)), (1, "k", None, D(1)), (1, "k", "", D(1)),
        (3, "i", "p9", D(1)), (99, "i", "p1", D(1)),
    )
    partners = silver.partners(spark.createDataFrame([partner("c1")], OCRD))
    projects = silver.projects(spark.createDataFrame([project("p1")], OPRJ))
    out = gold.revenue_metrics(inv, det, partners, projects)
    got = {(r["customer_code"], r["project_code"], r["sales_employee_code"]):
           (r["total_revenue"], r["invoice_count"], r["avg_invoice_value"], r["customer_name_hash"], r["project_name_hash"])
           for r in out.collect()}
    # Invoice 1 is delivered twice; each copy meets each of its lines.
    assert got == {
        ("c1", "p1", 7): (400, 1, 100.0, HASH, HASH),
        ("c1", "", 7): (450, 2, 90.0, HASH, None),
        ("c9", "p9", 7): (10, 1, 10.0, None, None),
        (None, "", 7): (1, 1, 1.0, None, None),
    }
    assert dict(out.dtypes)["revenue_by_service"] == "string"
    outcome = checks.evaluate(out, shipped.REVENUE)
    assert outcome.passed and any("valid_avg" in w for w in outcome.warnings)
    once = gold.revenue_metrics(inv.distinct(), det, partners, projects, "invoice")
    totals = {(r["customer_code"], r["project_code"], r["sales_employee_code"]): r["total_revenue"] for r in once.collect()}
    assert totals[("c1", "p1", 7)] == 100 and totals[("c1", "", 7)] == 150
    with pytest.raises(ValueError):
        gold.revenue_metrics(inv, det, partners, projects, "week")


def test_revenue_metrics_without_broadcast(spark):
    """The salted plan gives the same rows as the broadcast plan."""
    inv = spark.range(600).select(
        "id", F.col("id").alias("DocNum"), F.when(F.col("id") % 3 == 0, "c1").otherwise((F.col("id") % 20).cast("string")).alias("CardCode"),
        (F.col("id") % 3).cast("int").alias("SlpCode"), F.lit(date(2024, 1, 1)).alias("DocDate"),
        F.col("id").cast("decimal(18,2)").alias("DocTotal"), F.lit("C").alias("DocStatus"),
    ).withColumnRenamed("id", "DocEntry")
    det = spark.range(2000).select(
        (F.col("id") % 500).alias("DocEntry"), F.lit("i").alias("ItemCode"),
        F.when(F.col("id") % 3 > 0, "p1").alias("Project"), F.lit(1).cast("decimal(18,2)").alias("LineTotal"),
    )
    partners = silver.partners(spark.createDataFrame([partner("c1"), partner("4")], OCRD))
    projects = silver.projects(spark.createDataFrame([project("p1")], OPRJ))
    want = sorted(map(str, gold.revenue_metrics(inv, det, partners, projects).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(map(str, gold.revenue_metrics(inv, det, partners, projects).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want


def test_revenue_metrics_deals_out_by_invoice_once(spark, monkeypatch):
    """Lines and headers are shuffled by their invoice, and not a second time to be counted or folded."""
    inv = spark.createDataFrame(
        [(1, date(2024, 1, 1), "C1", 7, D(10)), (1, date(2024, 1, 1), "C1", 7, D(10)), (None, date(2024, 1, 1), "C2", 7, D(5))],
        "DocEntry int, DocDate date, CardCode string, SlpCode int, DocTotal decimal(18,2)",
    )
    det = spark.createDataFrame([(1, "A"), (1, "A"), (1, None), (None, "A")], "DocEntry int, Project string")
    partners = spark.createDataFrame([("C1", "aa" * 32)], "CardCode string, CardName_Hash string")
    projects = spark.createDataFrame([("A", "bb" * 32)], "PrjCode string, PrjName_Hash string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = gold.revenue_metrics(inv, det, partners, projects)
        plan = out._jdf.queryExecution().executedPlan().toString()
        keyed = [line for line in plan.splitlines() if "hashpartitioning(DocEntry" in line and "DocDate" not in line]
        rows = {(r["customer_code"], r["project_code"]): (float(r["total_revenue"]), r["invoice_count"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == {("C1", "A"): (40.0, 1), ("C1", ""): (20.0, 1), ("C2", ""): (5.0, 0)}
    assert len(keyed) == 2 and not any("project_code" in line for line in keyed)


def test_revenue_metrics_moves_rows_once_for_names(spark):
    """Beyond the session's threshold the names of projects still go to all tasks, up to a bound; a staged run
    sorts what it has read back, so earlier shuffles have ended, and gives the same rows."""
    inv = invoices(spark, *[(i, i, f"c{i % 3}", 7, date(2024, 1, 1 + i % 9), D(10 * i), "C") for i in range(40)])
    det = lines(spark, *[(i % 40, "i", ("p1", "p2", None)[i % 3], D(1)) for i in range(100)])
    partners = silver.partners(spark.createDataFrame([partner("c1"), partner("c2")], OCRD))
    projects = silver.projects(spark.createDataFrame([project("p1"), project("p2")], OPRJ))
    want = sorted(map(str, gold.revenue_metrics(inv, det, partners, projects).collect()))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before, copies = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), step_copies()
    partners, projects = cut_lineage(partners), cut_lineage(projects)
    made = step_copies()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        out = gold.revenue_metrics(inv, det, partners, projects)
        staged = gold.revenue_metrics(inv, det, partners, projects, stage=cut_lineage)
        assert "hashpartitioning(PrjCode" not in plan(out) and "hashpartitioning(customer_code" in plan(out)
        assert "hashpartitioning" not in plan(staged) and len(step_copies() - made) == 1
        assert sorted(map(str, out.collect())) == sorted(map(str, staged.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        drop_steps(spark, copies)


def test_layers_are_written_with_zstd(spark, folder):
    files.write_parquet(spark.range(10), f"{folder}/a")
    files.write_parquet(spark.range(10), f"{folder}/b", compression="snappy")
    for name, codec in (("a", "zstd"), ("b", "snappy")):
        assert all(f".{codec}." in f for f in os.listdir(f"{folder}/{name}") if f.endswith(".parquet"))


def test_customer_analytics(spark):
    rows = [partner("c1", balance=D(50), credit=D(200), frozen="Y"), partner("c2", credit=D(0), balance=D(5)), partner("s1", kind="S")]
    partners = silver.partners(spark.createDataFrame(rows, OCRD))
    inv = invoices(
        spark, (1, 1, "c1", 7, date(2024, 6, 1), D(10), "C"), (2, 2, "c1", 7, date(2024, 6, 20), None, "C"),
        (3, 3, "c1", 7, None, D(5), "C"), (4, 4, "zz", 7, date(2024, 6, 1), D(1), "C"), (5, 5, None, 7, date(2024, 6, 1), D(1), "C"),
    )
    out = gold.customer_analytics(partners, inv, TODAY)
    got = [(r["customer_code"], r["lifetime_revenue"], r["credit_utilization_pct"], r["days_since_last_invoice"], r["is_frozen"]) for r in out.collect()]
    assert got == [("c1", 15, 25.0, 10, True), ("c2", 0, 0.0, None, False)]
    assert checks.evaluate(out, shipped.CUSTOMER_ANALYTICS).passed


def test_project_profitability(spark):
    rows = [project("p1", start=date(2024, 6, 1), end=date(2024, 6, 11)), project("p2", active="N", start=date(2024, 6, 20)), project("p3", active=None)]
    projects = silver.projects(spark.createDataFrame(rows, OPRJ))
    out = gold.project_profitability(
        projects, lines(spark, (1, "i", "p1", D(100)), (1, "i", "p1", None), (1, "i", None, D(9)), (1, "i", "", D(9))),
        lines(spark, (1, "i", "p1", D(25)), (1, "i", "p2", D(5))), TODAY,
    )
    got = {r["project_code"]: (r["project_status"], r["total_revenue"], r["total_cost"], r["gross_profit"], r["gross_margin_pct"], r["duration_days"]) for r in out.collect()}
    assert got == {
        "p1": ("Active", 100, 25, 75, 75.0, 10), "p2": ("Closed", 0, 5, -5, 0.0, 10), "p3": ("Closed", 0, 0, 0, 0.0, None),
    }
    assert checks.evaluate(out, shipped.PROFITABILITY).passed


def test_kpis_on_empty_and_small_inputs(spark):
    none, some = invoices(spark), invoices(
        spark, (1, 1, "a", 1, date(2024, 1, 1), D(10), "C"), (2, 2, "a", 1, date(2024, 1, 1), D(20), "C"),
        (3, 3, "b", 1, date(2024, 1, 2), D(70), "C"),
    )
    assert kpi.gross_margin(none, none).first()["gross_margin"] == 0.0
    assert kpi.dso_dpo(none, none, none, none).first()["dso"] == 0.0
    assert kpi.deal_size(none).first()["avg_deal_size"] is None
    assert kpi.customer_concentration(none).first()["concentration"] == 0.0
    assert kpi.customer_concentration(some, 1).first()["concentration"] == 0.7
    assert {r["kind"]: (r["invoices"], r["revenue"]) for r in kpi.new_vs_repeat(some).collect()} == {"new": (2, 80), "repeat": (1, 20)}
    assert {r["kind"]: (r["invoices"], r["revenue"]) for r in kpi.new_vs_repeat(none).collect()} == {"new": (0, 0), "repeat": (0, 0)}
    assert kpi.dso_dpo(some, some.limit(1), some, none, 100).first()["dpo"] == 100.0


# ---------------------------------------------------------------- transformations and the job


def test_transforms(spark):
    data = {"numbers": spark.range(5)}
    sql = Transform("t", sql="SELECT sum(id) AS s FROM numbers WHERE id > :low", parameters={"low": 2})
    assert run_transform(spark, sql, data).first()["s"] == 7
    text = Transform("t", function=lambda s, t: "SELECT count(*) AS n FROM numbers")
    assert run_transform(spark, text, data).first()["n"] == 5
    frame = Transform("t", function=lambda s, t: t["numbers"].filter("id > 3"))
    assert run_transform(spark, frame, data).count() == 1
    with pytest.raises(TypeError, match="must return"):
        run_transform(spark, Transform("t", function=lambda s, t: 1), data)
    with pytest.raises(ValueError):
        run_transform(spark, Transform("t"), data)
    doubled = map_batches(spark.range(3), lambda b: b.assign(id=b["id"] * 2), "id long")
    assert sorted(r["id"] for r in doubled.collect()) == [0, 2, 4]


def test_transform_config(tmp_path):
    (tmp_path / "a.sql").write_text("SELECT 1 AS x")
    config = {"name": "a", "type": "sql", "quality_checks": ["contract:a"],
              "inputs": [{"alias": "b", "stage": "bronze", "source_path": "crm/customers.parquet"}]}
    made = Transform.from_config(config, {}, str(tmp_path))
    assert made.sql == "SELECT 1 AS x" and made.inputs[0].dataset() == ("crm", "customers")
    assert Transform.from_config({"name": "f"}, {"f": len}).function is len
    with pytest.raises(ValueError, match="Unknown transformation type"):
        Transform.from_config({"name": "f", "type": "odd"}, {})
    with pytest.raises(KeyError):
        Transform.from_config({"name": "f"}, {})


def test_execution_order():
    assert jobs.execution_order() == jobs.execution_order("all") == ["bronze", "silver", "gold"]
    assert jobs.execution_order("Silver") == ["silver", "gold"]
    with pytest.raises(ValueError):
        jobs.execution_order("copper")


def erp_lake(spark, raw):
    """Raw extracts of all delivered tables."""
    day = date(2024, 1, 1)
    ocrd = spark.createDataFrame(
        [(f"c{i}", f"name {i}", "C", 1, 1, 1, "eur", day, day, D(10), D(100), "N", "555", "x@y.z") for i in range(20)],
        "CardCode string, CardName string, CardType string, GroupCode int, Territory int, SlpCode int, Currency string, "
        "CreateDate date, UpdateDate date, Balance decimal(18,2), CreditLine decimal(18,2), frozenFor string, Phone1 string, E_Mail string",
    )
    for c in ("FrozenFrom", "FrozenTo", "ValidFrom", "ValidTo"):
        ocrd = ocrd.withColumn(c, F.lit(None).cast("date"))
    ocrd = ocrd.withColumn("DebPayAcct", F.lit(None).cast("string")).withColumn("Discount", F.lit(None).cast("decimal(18,2)"))
    oprj = spark.createDataFrame(
        [(f"p{i}", f"project {i}", "c1", "Y", day, None, None, None, day, day, 1) for i in range(5)],
        "PrjCode string, PrjName string, CardCode string, Active string, ValidFrom date, ValidTo date, DueDate date, "
        "ClosingDate date, CreateDate date, UpdateDate date, FinncPriod int",
    )
    oslp = spark.createDataFrame(
        [(1, "sam", "Y", D(5), 1, "s@x.y", day)],
        "SlpCode int, SlpName string, Active string, Commission decimal(18,2), EmployeeID int, Email string, UpdateDate date",
    )
    inv = invoices(spark, *[(i, i, f"c{i % 20}", 1, day, D(100 + i), "C") for i in range(100)]).withColumn("UpdateDate", F.lit(day))
    det = lines(spark, *[(i % 100, "i", f"p{i % 5}", D(i)) for i in range(300)]).withColumn("UpdateDate", F.lit(day))
    det = det.withColumn("LineNum", F.col("LineTotal").cast("int"))
    tables = {"OCRD": ocrd, "OPRJ": oprj, "OSLP": oslp, "OINV": inv, "INV1": det, "PCH1": det.filter("LineTotal < 50")}
    for name, df in tables.items():
        df.write.parquet(f"{raw}/{name.lower()}/{name}.parquet")
    return Source("erp", "sap_b1", {"source_storage_path": raw}, [{"name": n, "incremental_column": "UpdateDate"} for n in tables])


def test_whole_pipeline(spark, folder):
    source = erp_lake(spark, f"{folder}/raw")
    pipe = jobs.Pipeline(
        spark, f"{folder}/lake", [source], jobs.delivered_silver("erp"), jobs.delivered_gold(TODAY), shipped.store()
    )
    done = pipe.run()
    assert [len(done[s]) for s in ("bronze", "silver", "gold")] == [6, 6, 3]
    assert "CardName" not in pipe.dataset("bronze", "OCRD", "erp").columns
    assert pipe.dataset("gold", "sap_customer_analytics_gold").count() == 20
    revenue = pipe.dataset("gold", "sap_revenue_metrics_gold").agg(F.sum("invoice_count")).first()[0]
    assert revenue == 100
    counts = {(r["stage"], r["dataset"]): (r["rows_in"], r["rows_out"]) for r in pipe.metrics().collect()}
    assert counts[("silver", "sap_ocrd_silver")] == (20, 20)
    assert counts[("gold", "sap_project_profitability_gold")] == (5 + 300 + 50, 5)
    # Nothing new: increments are empty, derived datasets are rebuilt with the same rows.
    again = pipe.run()
    assert {c.rows_out for c in again["bronze"]} == {0}
    assert {c.rows_out for c in again["silver"] if c.dataset.startswith("silver_")} == {0}
    assert pipe.dataset("silver", "silver_oinv").count() == 100
    assert pipe.dataset("gold", "sap_customer_analytics_gold").count() == 20


def test_rejected_load_is_not_published(spark, folder):
    good, bad = spark.range(5), spark.range(5).union(spark.range(1))
    pipe = jobs.Pipeline(spark, folder, checks={"unique": lambda d: (d.distinct().count() == d.count(), "duplicates")})
    pipe.publish("silver", "t", good, ["unique"])
    with pytest.raises(ContractViolation, match="duplicates"):
        pipe.publish("silver", "t", bad, ["unique"])
    assert pipe.dataset("silver", "t").count() == 5
    pipe.publish("silver", "t", spark.range(7), ["unique"])
    assert pipe.dataset("silver", "t").count() == 7


def test_linkage_runs_before_the_gate(spark, folder):
    people = spark.createDataFrame([(1, "b", "anna"), (2, "b", "anna"), (3, "b", "otto")], "id long, block string, name string")
    people.write.parquet(f"{folder}/in")
    settings = linkage.LinkageSettings("id", [["block"]], [linkage.Comparison("name")], 0.2, 0.9)
    step = Transform(
        "people", [Input("p", f"{folder}/in", None)], lambda s, t: t["p"], linkage=settings,
        checks=["names are unique"],
    )
    pipe = jobs.Pipeline(
        spark, f"{folder}/lake", silver=[step],
        checks={"names are unique": lambda d: d.select("name").distinct().count() == d.count()},
    )
    assert [c.rows_out for c in pipe.run("silver")["silver"]] == [2]


def test_pipeline_from_config(spark, folder):
    erp_lake(spark, f"{folder}/raw")
    config = {
        "sources": [{"name": "erp", "type": "sap_b1", "connection": {"source_storage_path": f"{folder}/raw"},
                     "tables": [{"name": "OINV", "incremental_column": "UpdateDate"}]}],
        "silver": [{"name": "orders_clean", "type": "sql", "sql": "SELECT * FROM o WHERE DocStatus IS NOT NULL",
                    "inputs": [{"alias": "o", "stage": "bronze", "source_path": "erp/OINV.parquet"}],
                    "linkage": {"link_type": "dedupe_only", "unique_id_column_name": "DocEntry",
                                "blocking_rules_to_generate_predictions": ["l.CardCode = r.CardCode AND l.SlpCode = r.SlpCode"],
                                "comparisons": ["DocDate", "DocStatus"], "prior": 0.2, "min_probability": 0.99}}],
        "gold": [{"name": "daily_sales", "type": "sql", "quality_checks": ["some"],
                  "sql": "SELECT DocDate AS order_date, sum(DocTotal) AS total_revenue, count(*) AS orders_count FROM c GROUP BY DocDate",
                  "inputs": [{"alias": "c", "stage": "silver", "source_path": "refined/orders_clean.parquet"}]}],
    }
    pipe = jobs.pipeline_from_config(spark, f"{folder}/lake", config, checks={"some": lambda d: d.count() == 1})
    pipe.run()
    assert pipe.dataset("gold", "daily_sales").first()["orders_count"] == 20  # one per customer
    with pytest.raises(ValueError, match="itself"):
        linkage.LinkageSettings.from_config({"unique_id_column_name": "i", "blocking_rule": "l.a = r.b", "comparisons": ["c"]})
    with pytest.raises(ValueError, match="dedupe_only"):
        linkage.LinkageSettings.from_config({"link_type": "link_only"})


def test_incremental_transformation(spark, folder):
    from lamina.sources.landing import land_table

    step = Transform("t", [Input("rows", "s/T")], lambda s, t: t["rows"].filter("id < 100"), incremental=True)
    pipe = jobs.Pipeline(spark, folder, silver=[step], checks={"few": lambda d: d.count() < 4})
    source, table = Source("s", "sap_b1", {"source_storage_path": ""}), {"name": "T", "incremental_column": "id"}

    def land(n):
        land_table(spark, source, table, folder, pipe.log, spark.range(n))

    land(3)
    first = pipe.run("silver")["silver"]
    assert [(c.mode, c.rows_in, c.rows_out, c.watermark_value) for c in first] == [("full", 3, 3, "1")]
    assert pipe.run("silver")["silver"] == []  # nothing new
    land(5)
    land(6)
    more = pipe.run("silver")["silver"]
    assert [(c.mode, c.rows_in, c.rows_out, c.watermark_value) for c in more] == [("incremental", 3, 3, "3")]
    assert sorted(r["id"] for r in pipe.dataset("silver", "t").collect()) == list(range(6))
    pipe.log.reset("bronze", "s", "T")
    land(2)
    again = pipe.run("silver")["silver"]
    assert [(c.mode, c.rows_out) for c in again] == [("full", 2)]
    assert pipe.dataset("silver", "t").count() == 2
    with pytest.raises(ValueError, match="one input"):
        Transform("t", [], incremental=True)


def test_refused_datasets_do_not_stop_the_others(spark, folder):
    spark.range(5).write.parquet(f"{folder}/in")
    made = lambda name, checks=(), item=Input("p", f"{folder}/in", None): Transform(
        name, [item], lambda s, t: t["p"], checks=list(checks)
    )
    fails = {"no": lambda d: (False, "never"), "yes": lambda d: True}
    silver = [made("a", ["no"]), made("b", ["yes"]), made("c", ["no"])]
    gold = [made("g", ["yes"], Input("p", "refined/b", "silver")), made("h", [], Input("p", "refined/a", "silver"))]
    pipe = jobs.Pipeline(spark, f"{folder}/lake", silver=silver, gold=gold, checks=fails)
    with pytest.raises(DatasetsRefused) as stopped:
        pipe.run("silver")
    assert [(r.stage, r.dataset) for r in stopped.value.refusals] == [("silver", "a"), ("silver", "c")]
    assert pipe.dataset("silver", "b").count() == 5 and not pipe.log.live("gold", "analytics", "g")
    with pytest.raises(DatasetsRefused, match="not published"):
        pipe.run("silver", keep_going=True)
    verdicts = {(r["stage"], r["dataset"]): (r["published"], r["rows_out"]) for r in pipe.verdicts().collect()}
    assert verdicts == {
        ("silver", "a"): (False, None), ("silver", "b"): (True, 5), ("silver", "c"): (False, None),
        ("gold", "g"): (True, 5), ("gold", "h"): (False, None),
    }


def test_packed_text_round_trip(spark):
    digest = "ab" * 32
    texts = [digest, digest.upper(), digest[1:], "", "0", "00", "zz", "Ünïcode", None, "ab\x00", "ab\x01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", exprs.packed_text(F.col("t")).alias("p")).withColumn("back", exprs.unpacked_text(F.col("p"))).collect()
    assert [r["back"] for r in out] == [r["t"] for r in out] and len(out) == len(texts)
    assert len(out[0]["p"]) == 33
