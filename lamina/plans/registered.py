"""Every operator as a query over the supplied tables, with an equivalent ANSI SQL text.

A query reads whole tables. Money leaves as double, because the two engines print decimals
differently; all sums are done on decimals before that.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lamina.contracts import checks, generate
from lamina.contracts.compile import compile_contract
from lamina.contracts.evolve import diff_frame, failed_casts, migrate
from lamina.contracts.model import ColumnSpec, Contract, Rule
from lamina.contracts.gate import DatasetsRefused
from lamina.contracts.shipped import CUSTOMER_ANALYTICS, CUSTOMERS, PARTNERS, store
from lamina.functions import exprs
from lamina.operators import agreement, breakdown, dedup, linkage, masking, ordered, retention
from lamina.operators.skew import safe_join
from lamina.plans import gold, jobs, kpi, silver, transforms
from lamina.plans.star_inputs import shape_sql, shaped, table
from lamina.session import fresh_dir
from lamina.sources import catalogue, files, keyed, landing
from lamina.sources.commitlog import CommitLog
from lamina.streaming.landing import land_new_files

AS_OF = date(2002, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------- inputs shared by the queries


def _masked(spark: SparkSession, sf: str, shape: str, erp: str) -> DataFrame:
    return masking.apply_masking(shaped(spark, sf, shape), catalogue.masking_rule(erp))


def _partners(spark, sf, shape="ocrd"):
    return silver.partners(_masked(spark, sf, shape, "OCRD"))


def _projects(spark, sf):
    return silver.projects(_masked(spark, sf, "oprj", "OPRJ"))


def _employees(spark, sf):
    return silver.employees(_masked(spark, sf, "oslp", "OSLP"))


def _partner_sql(shape: str) -> str:
    return f"""silver_ocrd AS (
SELECT CardCode, sha256(CardName) AS CardName_Hash, upper(trim(CardType)) AS CardType, GroupCode,
  Territory, SlpCode, upper(trim(Currency)) AS Currency, CreateDate, UpdateDate,
  coalesce(Balance, 0) AS Balance, coalesce(CreditLine, 0) AS CreditLine,
  coalesce(frozenFor, 'N') AS frozenFor, FrozenFrom, FrozenTo,
  coalesce(DebPayAcct, '') AS DebPayAcct, coalesce(Discount, 0) AS Discount, ValidFrom, ValidTo
FROM (SELECT *, row_number() OVER (PARTITION BY CardCode
        ORDER BY UpdateDate DESC NULLS LAST, CreateDate DESC NULLS LAST, DebPayAcct ASC NULLS LAST) AS rn
      FROM {shape}
      WHERE CardCode IS NOT NULL AND CardCode <> '' AND CardName IS NOT NULL
        AND CardType IN ('C', 'S', 'L')) x
WHERE rn = 1)"""


_PROJECT_SQL = """silver_oprj AS (
SELECT PrjCode, sha256(PrjName) AS PrjName_Hash, CardCode, Active, ValidFrom, ValidTo, DueDate,
  ClosingDate, CreateDate, UpdateDate, FinncPriod
FROM oprj
WHERE PrjCode <> '' AND PrjName IS NOT NULL
  AND (ValidTo IS NULL OR ValidFrom IS NULL OR ValidTo >= ValidFrom)
  AND (ClosingDate IS NULL OR DueDate IS NULL OR ClosingDate >= ValidFrom))"""

_EMPLOYEE_SQL = """silver_oslp AS (
SELECT SlpCode, SlpName_Hash, Active,
  CASE WHEN Commission IS NULL OR Commission < 0 THEN 0 WHEN Commission > 100 THEN 100
       ELSE Commission END AS Commission, EmployeeID
FROM (SELECT *, row_number() OVER (PARTITION BY SlpCode ORDER BY SlpName_Hash, Active,
        Commission NULLS LAST, EmployeeID) AS rn
      FROM (SELECT *, sha256(SlpName) AS SlpName_Hash FROM oslp) h) x
WHERE rn = 1)"""

_CUSTOMER_360_SQL = f"""WITH {shape_sql("ocrd", "oinv")},
{_partner_sql("ocrd")},
history AS (SELECT CardCode, coalesce(sum(DocTotal), 0) AS earned, max(DocDate) AS latest FROM oinv GROUP BY 1),
customer_360 AS (
SELECT CardCode AS customer_code, CardName_Hash AS customer_name_hash, CardType AS customer_type,
  coalesce(earned, 0)::DOUBLE AS lifetime_revenue, Balance::DOUBLE AS current_balance,
  CreditLine::DOUBLE AS credit_limit,
  if(CreditLine > 0, Balance::DOUBLE / CreditLine::DOUBLE * 100.0e0, 0.0e0) AS credit_utilization_pct,
  (DATE '2002-01-01' - latest)::INTEGER AS days_since_last_invoice,
  frozenFor = 'Y' AS is_frozen, SlpCode AS primary_sales_employee
FROM silver_ocrd LEFT JOIN history USING (CardCode) WHERE CardType = 'C')"""

# ---------------------------------------------------------------- silver and gold datasets


@query("customer_360", f"{_CUSTOMER_360_SQL} SELECT * FROM customer_360")
def customer_360(spark, sf):
    return plain(gold.customer_analytics(_partners(spark, sf), shaped(spark, sf, "oinv"), AS_OF))


def _revenue_sql(times: str) -> str:
    """An invoice counts ``times`` for each project on it; the names are looked up by the groups."""
    return f"""WITH {shape_sql("ocrd", "oinv", "inv1", "oprj")},
{_partner_sql("ocrd")},
{_PROJECT_SQL},
share AS (SELECT DocEntry, coalesce(Project, '') AS code, count(*) AS n FROM inv1 GROUP BY ALL),
part AS (SELECT o.*, coalesce(code, '') AS code, {times} AS times FROM oinv o LEFT JOIN share USING (DocEntry)),
grouped AS (
  SELECT DocDate, CardCode, code, SlpCode, sum(DocTotal * times) AS total,
    sum(times) FILTER (DocTotal IS NOT NULL) AS known, count(DISTINCT DocEntry) AS invoices
  FROM part WHERE DocDate IS NOT NULL GROUP BY ALL)
SELECT DocDate AS metric_date, CardCode AS customer_code,
  (SELECT any_value(CardName_Hash) FROM silver_ocrd c WHERE c.CardCode = g.CardCode) AS customer_name_hash,
  code AS project_code,
  (SELECT any_value(PrjName_Hash) FROM silver_oprj p WHERE p.PrjCode = g.code) AS project_name_hash,
  SlpCode AS sales_employee_code, total::DOUBLE AS total_revenue, invoices::INTEGER AS invoice_count,
  total::DOUBLE / known AS avg_invoice_value, NULL::VARCHAR AS revenue_by_service
FROM grouped g WHERE total >= 0"""


def _revenue(spark, sf, grain):
    parts = (shaped(spark, sf, "oinv"), shaped(spark, sf, "inv1"))
    return plain(gold.revenue_metrics(*parts, _partners(spark, sf), _projects(spark, sf), grain))


@query("revenue_metrics", _revenue_sql("coalesce(n, 1)"))
def revenue_metrics(spark, sf):
    return _revenue(spark, sf, "line")


@query("revenue_metrics_invoice_grain", _revenue_sql("1"))
def revenue_metrics_invoice_grain(spark, sf):
    return _revenue(spark, sf, "invoice")


_PROFIT_SQL = f"""WITH {shape_sql("oprj", "inv1", "pch1")},
{_PROJECT_SQL},
flow AS (
  SELECT Project, LineTotal AS earned, 0 AS spent FROM inv1
  UNION ALL SELECT Project, 0, LineTotal FROM pch1),
figures AS (
  SELECT PrjCode, coalesce(sum(earned), 0) AS revenue, coalesce(sum(spent), 0) AS cost
  FROM silver_oprj LEFT JOIN flow ON PrjCode = Project GROUP BY PrjCode)
SELECT PrjCode AS project_code, PrjName_Hash AS project_name_hash, CardCode AS customer_code,
  if(Active = 'Y', 'Active', 'Closed') AS project_status, revenue::DOUBLE AS total_revenue,
  cost::DOUBLE AS total_cost, (revenue - cost)::DOUBLE AS gross_profit,
  if(revenue > 0, (revenue - cost)::DOUBLE / revenue::DOUBLE * 100.0e0, 0.0e0) AS gross_margin_pct,
  ValidFrom AS project_start_date, ValidTo AS project_end_date,
  (coalesce(ValidTo, DATE '2002-01-01') - ValidFrom)::INTEGER AS duration_days
FROM silver_oprj JOIN figures USING (PrjCode)"""


@query("project_profitability", _PROFIT_SQL)
def project_profitability(spark, sf):
    lines, costs = shaped(spark, sf, "inv1"), shaped(spark, sf, "pch1")
    return plain(gold.project_profitability(_projects(spark, sf), lines, costs, AS_OF))


@query(
    "silver_partners",
    f"WITH {shape_sql('ocrd_feed')}, {_partner_sql('ocrd_feed')} SELECT * REPLACE ("
    "CAST(Balance AS DOUBLE) AS Balance, CAST(CreditLine AS DOUBLE) AS CreditLine,"
    "CAST(Discount AS DOUBLE) AS Discount) FROM silver_ocrd",
)
def silver_partners(spark, sf):
    return plain(_partners(spark, sf, "ocrd_feed"))


@query("silver_projects", f"WITH {shape_sql('oprj')}, {_PROJECT_SQL} SELECT * FROM silver_oprj")
def silver_projects(spark, sf):
    return _projects(spark, sf)


@query(
    "silver_employees",
    f"WITH {shape_sql('oslp')}, {_EMPLOYEE_SQL} "
    "SELECT * REPLACE (CAST(Commission AS DOUBLE) AS Commission) FROM silver_oslp",
)
def silver_employees(spark, sf):
    return plain(_employees(spark, sf))


_CRM_ORDER = """email NULLS LAST, country NULLS LAST, consent_marketing NULLS LAST,
  consent_analytics NULLS LAST, consent_timestamp NULLS LAST, retention_category NULLS LAST,
  created_at NULLS LAST, gdpr_delete_after NULLS LAST"""


_CUSTOMERS_SQL = f"""SELECT customer_id, sha256(email) AS email_hash, upper(substr(country, 1, 2)) AS country_code,
  consent_marketing, consent_analytics, consent_timestamp, data_subject_rights_exercised,
  retention_category, created_at, updated_at, gdpr_delete_after
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY updated_at DESC NULLS LAST, {_CRM_ORDER}) AS rn
      FROM crm WHERE customer_id IS NOT NULL) x
WHERE rn = 1"""


@query("silver_customers", f"WITH {shape_sql('crm')} {_CUSTOMERS_SQL}")
def silver_customers(spark, sf):
    return silver.customers(shaped(spark, sf, "crm"))


@query("silver_pass_through", f"""WITH {shape_sql("inv1")}
SELECT * REPLACE (CAST(LineTotal AS DOUBLE) AS LineTotal) FROM inv1""")
def silver_pass_through(spark, sf):
    return plain(silver.pass_through(shaped(spark, sf, "inv1")))


@query("daily_sales", """SELECT CAST(o_orderdate AS DATE) AS order_date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(*) AS orders_count
FROM orders GROUP BY 1""")
def daily_sales(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return plain(gold.daily_sales(orders, "day", "o_totalprice"))


@query("orders_clean", """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_totalprice
FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL""")
def orders_clean(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice"
    )
    return silver.orders_clean(orders)


@query("monthly_revenue", f"""WITH {shape_sql("ocrd", "oinv")}, {_partner_sql("ocrd")},
recent AS (
  SELECT make_date(year(DocDate), month(DocDate), 1) AS revenue_month, DocNum, DocTotal,
    if(DocStatus = 'C', DocTotal, 0) AS closed, CardCode
  FROM oinv WHERE DocDate >= DATE '2000-06-30')
SELECT revenue_month, p.CardCode AS customer_code, CardName_Hash AS customer_hash,
  count(DISTINCT DocNum) AS invoice_count, sum(DocTotal)::DOUBLE AS total_revenue,
  sum(closed)::DOUBLE AS closed_revenue, sum(DocTotal)::DOUBLE / nullif(count(DocTotal), 0) AS avg_invoice_value
FROM recent LEFT JOIN silver_ocrd p USING (CardCode) GROUP BY ALL""")
def monthly_revenue(spark, sf):
    invoices = shaped(spark, sf, "oinv")
    return plain(gold.monthly_revenue(invoices, _partners(spark, sf), date(2001, 6, 30)))


@query("customer_summary", """SELECT o_custkey AS customer_id, count(*) AS total_orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
  min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_order_value
FROM orders GROUP BY o_custkey HAVING count(*) > 0""")
def customer_summary(spark, sf):
    orders = table(spark, sf, "orders")
    return plain(gold.customer_summary(orders, "o_custkey", "o_totalprice", "o_orderdate"))


# ---------------------------------------------------------------- key figures


def _kpi(name: str, build: Callable, inputs: list, sql: str) -> None:
    shapes = [i for i in inputs if isinstance(i, str)]

    def run(spark, sf):
        found = [shaped(spark, sf, i) if isinstance(i, str) else i(spark, sf) for i in inputs]
        return plain(build(*found))

    extra = {_partners: ("ocrd", _partner_sql("ocrd")), _projects: ("oprj", _PROJECT_SQL),
             _employees: ("oslp", _EMPLOYEE_SQL)}
    derived = [extra[i] for i in inputs if not isinstance(i, str)]
    ctes = shape_sql(*shapes, *(s for s, _ in derived))
    query(name, f"WITH {',\n'.join([ctes, *(text for _, text in derived)])}\n{sql}")(run)


def _sum(name: str, source: str, column: str = "DocTotal") -> str:
    return f"(SELECT coalesce(sum({column}), 0) FROM {source}) AS {name}"


_kpi("kpi_total_revenue", kpi.total_revenue, ["oinv"],
     "SELECT CAST(sum(DocTotal) AS DOUBLE) AS total_revenue FROM oinv")
_kpi("kpi_revenue_by_service", kpi.revenue_by_service, ["inv1", "oitm"], """
SELECT l.ItemCode, i.ItemName, CAST(sum(l.LineTotal) AS DOUBLE) AS revenue
FROM inv1 l LEFT JOIN oitm i ON l.ItemCode = i.ItemCode GROUP BY l.ItemCode, i.ItemName""")
_kpi("kpi_revenue_by_customer", kpi.revenue_by_customer, ["oinv", _partners], """
SELECT i.CardCode, c.CardName_Hash, CAST(sum(i.DocTotal) AS DOUBLE) AS revenue
FROM oinv i LEFT JOIN silver_ocrd c ON i.CardCode = c.CardCode GROUP BY i.CardCode, c.CardName_Hash""")
_kpi("kpi_revenue_by_project", kpi.revenue_by_project, ["inv1", _projects], """
SELECT l.Project, p.PrjName_Hash, CAST(sum(l.LineTotal) AS DOUBLE) AS revenue
FROM inv1 l LEFT JOIN silver_oprj p ON l.Project = p.PrjCode GROUP BY l.Project, p.PrjName_Hash""")
_kpi("kpi_deal_size", kpi.deal_size, ["oinv"], """
SELECT CAST(sum(DocTotal) AS DOUBLE) AS total_revenue, count(DocTotal) AS invoices,
  CAST(sum(DocTotal) AS DOUBLE) / count(DocTotal) AS avg_deal_size FROM oinv""")
_kpi("kpi_gross_margin", kpi.gross_margin, ["oinv", "opch"], f"""
SELECT CAST(revenue AS DOUBLE) AS revenue, CAST(costs AS DOUBLE) AS costs,
  CASE WHEN revenue > 0 THEN CAST(revenue - costs AS DOUBLE) / CAST(revenue AS DOUBLE) ELSE 0.0e0 END
    AS gross_margin
FROM (SELECT {_sum("revenue", "oinv")}, {_sum("costs", "opch")}) s""")
_kpi("kpi_service_margin", kpi.service_margin, ["inv1", "pch1", "oitm"], """
, r AS (SELECT ItemCode, sum(LineTotal) AS v FROM inv1 GROUP BY ItemCode)
, c AS (SELECT ItemCode, sum(LineTotal) AS v FROM pch1 GROUP BY ItemCode)
SELECT coalesce(r.ItemCode, c.ItemCode) AS ItemCode, i.ItemName,
  CAST(coalesce(r.v, 0) AS DOUBLE) AS revenue, CAST(coalesce(c.v, 0) AS DOUBLE) AS cost,
  CASE WHEN coalesce(r.v, 0) > 0 THEN CAST(r.v - coalesce(c.v, 0) AS DOUBLE) / CAST(r.v AS DOUBLE)
       ELSE 0.0e0 END AS margin
FROM r FULL JOIN c ON r.ItemCode = c.ItemCode
LEFT JOIN oitm i ON coalesce(r.ItemCode, c.ItemCode) = i.ItemCode""")
_kpi("kpi_cost_center_pnl", kpi.cost_center_pnl, ["jdt1", "oact", "oocr"], """
SELECT j.OcrCode, o.OcrName, a.AcctName, CAST(sum(Credit) AS DOUBLE) AS credit,
  CAST(sum(Debit) AS DOUBLE) AS debit, CAST(sum(Credit) - sum(Debit) AS DOUBLE) AS result
FROM jdt1 j LEFT JOIN oact a ON j.Account = a.AcctCode LEFT JOIN oocr o ON j.OcrCode = o.OcrCode
GROUP BY j.OcrCode, o.OcrName, a.AcctName""")
_kpi("kpi_dso_dpo", kpi.dso_dpo, ["oinv", "orct", "opch", "ovpm"], f"""
SELECT CAST(invoiced AS DOUBLE) AS invoiced, CAST(received AS DOUBLE) AS received,
  CAST(purchased AS DOUBLE) AS purchased, CAST(paid AS DOUBLE) AS paid,
  CAST(invoiced - received AS DOUBLE) / CAST(invoiced AS DOUBLE) * 365.0e0 AS dso,
  CAST(purchased - paid AS DOUBLE) / CAST(purchased AS DOUBLE) * 365.0e0 AS dpo
FROM (SELECT {_sum("invoiced", "oinv")}, {_sum("received", "orct")},
        {_sum("purchased", "opch")}, {_sum("paid", "ovpm")}) s""")
_kpi("kpi_cash_collected", kpi.cash_collected, ["orct"],
     "SELECT CAST(sum(DocTotal) AS DOUBLE) AS cash_collected FROM orct")
_kpi("kpi_collection_rate", kpi.collection_rate, ["oinv", "orct"], f"""
SELECT CAST(invoiced AS DOUBLE) AS invoiced, CAST(received AS DOUBLE) AS received,
  CAST(received AS DOUBLE) / CAST(invoiced AS DOUBLE) AS collection_rate
FROM (SELECT {_sum("invoiced", "oinv")}, {_sum("received", "orct")}) s""")
_kpi("kpi_active_projects", kpi.active_projects, [_projects],
     "SELECT count(*) AS active_projects FROM silver_oprj WHERE Active = 'Y'")
_kpi("kpi_revenue_per_employee", kpi.revenue_per_employee, ["oinv", _employees], f"""
SELECT CAST(revenue AS DOUBLE) AS revenue, headcount,
  CAST(revenue AS DOUBLE) / CAST(headcount AS DOUBLE) AS revenue_per_employee
FROM (SELECT {_sum("revenue", "oinv")},
        (SELECT count(DISTINCT SlpCode) FROM silver_oslp) AS headcount) s""")
_kpi("kpi_top_customers", kpi.top_customers, ["oinv"], """
SELECT CardCode, CAST(sum(DocTotal) AS DOUBLE) AS revenue FROM oinv GROUP BY CardCode
ORDER BY sum(DocTotal) DESC NULLS LAST, CardCode LIMIT 10""")
_kpi("kpi_concentration", kpi.customer_concentration, ["oinv"], f"""
, c AS (SELECT CardCode, sum(DocTotal) AS v FROM oinv GROUP BY CardCode)
, t AS (SELECT v FROM c ORDER BY v DESC NULLS LAST, CardCode LIMIT 10)
SELECT CAST(top_revenue AS DOUBLE) AS top_revenue, CAST(revenue AS DOUBLE) AS revenue,
  CAST(top_revenue AS DOUBLE) / CAST(revenue AS DOUBLE) AS concentration
FROM (SELECT {_sum("top_revenue", "t", "v")}, {_sum("revenue", "oinv")}) s""")
_kpi("kpi_new_vs_repeat", kpi.new_vs_repeat, ["oinv"], """
SELECT CASE WHEN rn = 1 THEN 'new' ELSE 'repeat' END AS kind, count(*) AS invoices,
  CAST(coalesce(sum(DocTotal), 0) AS DOUBLE) AS revenue
FROM (SELECT *, row_number() OVER (PARTITION BY CardCode ORDER BY DocDate, DocEntry) AS rn FROM oinv) x
GROUP BY 1""")


@query("revenue_json_breakdown", f"""WITH {shape_sql("inv1")}
SELECT Project, ItemCode AS item,
  '{{"' || ItemCode || '":' || CAST(sum(LineTotal) AS VARCHAR) || '}}' AS breakdown
FROM inv1 GROUP BY Project, ItemCode""")
def revenue_json_breakdown(spark, sf):
    return breakdown.json_breakdown(shaped(spark, sf, "inv1"), ["Project"], "ItemCode", "LineTotal")


@query("revenue_item_totals", f"""WITH {shape_sql("oinv", "inv1")}
SELECT DocDate, CardCode, ItemCode AS item, CAST(sum(LineTotal) AS DOUBLE) AS total
FROM oinv i JOIN inv1 l ON i.DocEntry = l.DocEntry GROUP BY DocDate, CardCode, ItemCode""")
def revenue_item_totals(spark, sf):
    lines = shaped(spark, sf, "inv1").select("DocEntry", "ItemCode", "LineTotal")
    headers = shaped(spark, sf, "oinv").select("DocEntry", "DocDate", "CardCode")
    detail = safe_join(lines, headers, ["DocEntry"], "inner")
    return plain(breakdown.item_totals(detail, ["DocDate", "CardCode"], "ItemCode", "LineTotal"))


@query("sales_six_decimals", """SELECT CAST(l_shipdate AS DATE) AS order_date,
  CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))
    * CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue, count(*) AS orders_count
FROM lineitem GROUP BY 1""")
def sales_six_decimals(spark, sf):
    """Amounts keep all their decimals until they are summed."""
    exact = [F.col(c).cast("decimal(12,2)") for c in ("l_quantity", "l_extendedprice", "l_discount")]
    lines = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("day"), (exact[0] * exact[1] * exact[2]).alias("amount")
    )
    return plain(gold.daily_sales(lines, "day", "amount"))


@query("range_filter", """SELECT l_returnflag, count(*) AS n FROM lineitem
WHERE l_quantity >= 10 AND l_quantity <= 20 AND l_discount <= 0.05 GROUP BY l_returnflag""")
def range_filter(spark, sf):
    wanted = exprs.between_open(F.col("l_quantity"), 10, 20) & exprs.between_open(F.col("l_discount"), high=0.05)
    return table(spark, sf, "lineitem").filter(wanted).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- masking


@query("mask_sha256", f"""WITH {shape_sql("ocrd")}
SELECT CardCode, sha256(CardName) AS CardName_Hash, CardType, GroupCode, Territory, SlpCode, Currency,
  CreateDate, UpdateDate, CAST(Balance AS DOUBLE) AS Balance, CAST(CreditLine AS DOUBLE) AS CreditLine,
  frozenFor, FrozenFrom, FrozenTo, DebPayAcct, CAST(Discount AS DOUBLE) AS Discount, ValidFrom, ValidTo
FROM ocrd""")
def mask_sha256(spark, sf):
    return plain(_masked(spark, sf, "ocrd", "ocrd"))


@query("mask_md5", "SELECT c_custkey, md5(c_name) AS c_name_Hash FROM customer")
def mask_md5(spark, sf):
    rule = masking.MaskingRule.of(hash=["c_name"], keep=["c_custkey"], algorithm="md5")
    return masking.apply_masking(table(spark, sf, "customer"), rule)


@query("mask_sha512")
def mask_sha512(spark, sf):
    rule = masking.MaskingRule.of(hash=["c_name"], keep=["c_custkey"], algorithm="sha512")
    return masking.apply_masking(table(spark, sf, "customer"), rule)


@query("mask_retain", f"""WITH {shape_sql("oslp")}
SELECT SlpCode, sha256(SlpName) AS SlpName_Hash, Active, CAST(Commission AS DOUBLE) AS Commission,
  EmployeeID FROM oslp""")
def mask_retain(spark, sf):
    return plain(_masked(spark, sf, "oslp", "OSLP"))


@query("mask_exclude", "SELECT c_custkey, c_nationkey, sha256(CAST(c_custkey % 7 AS VARCHAR)) AS grp_Hash, "
       "c_mktsegment FROM customer")
def mask_exclude(spark, sf):
    rule = masking.MaskingRule.of(drop=["c_name", "c_acctbal"], hash=["grp", "c_name"])
    customers = table(spark, sf, "customer").withColumn("grp", F.col("c_custkey") % 7)
    return masking.apply_masking(customers, rule)


@query("mask_empty_as_null", """SELECT l_orderkey, l_linenumber, sha256(nullif(project, '')) AS project_Hash
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 6 THEN ''
        ELSE CAST(l_suppkey AS VARCHAR) END AS project FROM lineitem) x""")
def mask_empty_as_null(spark, sf):
    project = F.when(F.col("l_linenumber") == 6, "").otherwise(F.col("l_suppkey").cast("string"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", project.alias("project"))
    return masking.apply_masking(lines, masking.MaskingRule.of(hash=["project"], empty_as_null=True))


# ---------------------------------------------------------------- dedup, windows, filters


@query("dedup_latest_events", """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn
  FROM events) x WHERE rn = 1""")
def dedup_latest_events(spark, sf):
    return dedup.keep_latest(table(spark, sf, "events"), ["user_id"], ["ts"], ["event_id"])


@query("dedup_lineitem_composite", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem) x WHERE rn = 1""")
def dedup_lineitem_composite(spark, sf):
    return dedup.keep_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("dedup_single_key", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_partkey, p_brand, p_type, p_size, p_retailprice) AS rn
  FROM part) x WHERE rn = 1""")
def dedup_single_key(spark, sf):
    return dedup.keep_latest(table(spark, sf, "part"), ["p_name"])


@query("duplicate_groups", """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_groups(spark, sf):
    return dedup.duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("rank_lag_lead", """SELECT o_custkey, o_orderkey,
  row_number() OVER w AS row_number,
  rank() OVER (PARTITION BY o_custkey ORDER BY day DESC NULLS LAST) AS rank,
  lag(o_totalprice) OVER w AS previous_o_totalprice, lead(o_totalprice) OVER w AS next_o_totalprice
FROM (SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders) x
WINDOW w AS (PARTITION BY o_custkey ORDER BY day DESC NULLS LAST, o_orderkey)""")
def rank_lag_lead(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day")
    )
    ranked = ordered.ordered_rows(
        orders, ["o_custkey"], ["day"], ["o_orderkey"], ["o_totalprice"], descending=True
    )
    return ranked.drop("o_totalprice", "day")


@query("stats", """SELECT event_type, count(*) AS n, min(value) AS low, max(value) AS high,
  round(stddev_samp(value), 4) AS deviation, round(corr(value, user_id), 6) AS correlation,
  round(quantile_cont(value, 0.5), 6) AS median
FROM events GROUP BY event_type""")
def stats(spark, sf):
    events = table(spark, sf, "events")
    plainly = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.round(F.stddev_samp("value"), 4).alias("deviation"),
        F.round(F.corr("value", "user_id"), 6).alias("correlation"), F.count("value").alias("known"),
    )
    # The middle rows by number, so that no task holds all values of a group.
    values = events.select("event_type", "value", "event_id").filter(F.col("value").isNotNull())
    numbered = ordered.ordered_rows(values, ["event_type"], ["value"], ["event_id"])
    middle = F.col("row_number").isin(F.floor((F.col("known") + 1) / 2), F.ceil((F.col("known") + 1) / 2))
    medians = (
        numbered.join(plainly.select("event_type", "known"), "event_type").filter(middle)
        .groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("median"))
    )
    return plainly.drop("known").join(medians, "event_type", "left")


@query("text_json_nested", """SELECT event_id, lower(event_type) AS kind,
  CAST(length(event_type) AS INTEGER) AS n,
  regexp_matches(event_type, '^s') AS starts_with_s, event_type LIKE '%ic%' AS has_ic,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CAST(date_trunc('month', ts) AS DATE) AS month, abs(value - 100) AS distance,
  upper(event_type) AS first_of_pair
FROM events""")
def text_json_nested(spark, sf):
    kind = F.col("event_type")
    pair = F.struct(F.array(F.upper(kind), F.lower(kind)).alias("names"))
    return table(spark, sf, "events").withColumn("pair", pair).select(
        "event_id", F.lower(kind).alias("kind"), F.length(kind).alias("n"),
        kind.rlike("^s").alias("starts_with_s"), kind.like("%ic%").alias("has_ic"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.trunc("ts", "month").alias("month"), F.abs(F.col("value") - 100).alias("distance"),
        F.get("pair.names", F.lit(0)).alias("first_of_pair"),
    )


@query("retention_filter", """SELECT o_orderkey, o_orderdate, deleted_at FROM (
  SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END
    AS deleted_at FROM orders) x
WHERE o_orderdate >= DATE '2002-01-01' - INTERVAL '5 years'
  AND (deleted_at IS NULL OR deleted_at >= DATE '2002-01-01' - INTERVAL '300 days')""")
def retention_filter(spark, sf):
    deleted = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", deleted.alias("deleted_at"))
    return retention.retained(orders, "o_orderdate", "deleted_at", 5, 300, AS_OF)


@query("erasure_due", f"""WITH {shape_sql("crm")} SELECT customer_id, updated_at, gdpr_delete_after FROM crm
WHERE retention_category = 'to_delete' AND gdpr_delete_after < DATE '2024-01-20'""")
def erasure_due(spark, sf):
    due = retention.erasure_due(shaped(spark, sf, "crm"), as_of=date(2024, 1, 20))
    return due.select("customer_id", "updated_at", "gdpr_delete_after")


@query("without_erased", f"""WITH {shape_sql("crm")} SELECT customer_id, updated_at, gdpr_delete_after FROM crm
WHERE NOT coalesce(retention_category = 'to_delete' AND gdpr_delete_after < DATE '2024-01-20', FALSE)""")
def without_erased(spark, sf):
    kept = retention.without_erased(shaped(spark, sf, "crm"), as_of=date(2024, 1, 20))
    return kept.select("customer_id", "updated_at", "gdpr_delete_after")


# ---------------------------------------------------------------- sources and landing


@query("incremental_delta", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-30 00:00:00'")
def incremental_delta(spark, sf):
    orders = table(spark, sf, "orders")
    return landing.delta_since(orders, "o_orderdate", ("2000-06-30 00:00:00", "timestamp_ntz"))


@query("incremental_delta_inclusive",
       "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-30 00:00:00'")
def incremental_delta_inclusive(spark, sf):
    orders = table(spark, sf, "orders")
    return landing.delta_since(orders, "o_orderdate", ("2000-06-30 00:00:00", "timestamp_ntz"), True)


@query("watermark_max", "SELECT max(ts) AS watermark FROM events")
def watermark_max(spark, sf):
    return landing.watermark_of(table(spark, sf, "events"), "ts")


@query("upsert_current", """SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id, value) AS rn
  FROM events) x WHERE rn = 1""")
def upsert_current(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    split = F.lit("2024-01-20").cast("timestamp_ntz")
    keys, order = ["user_id", "event_type"], ["ts"]
    current = dedup.upsert(None, events.filter(F.col("ts") < split), keys, order)
    return dedup.upsert(current, events.filter(F.col("ts") >= split), keys, order)


@query("csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf):
    path = fresh_dir(spark, "csv") + "/customer.tsv"
    writer = table(spark, sf, "customer").write.option("header", "true").option("sep", "\t")
    writer.csv(path)
    return files.read_any(spark, path).select(
        F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


@query("partitioned_scan", """SELECT event_id, user_id, CAST(ts AS DATE) AS dt FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-15'""")
def partitioned_scan(spark, sf):
    path = fresh_dir(spark, "events")
    events = table(spark, sf, "events").withColumn("dt", F.col("ts").cast("date"))
    files.write_parquet(events, path, partition_by=["dt"])
    return files.read_raw(spark, path).filter(F.col("dt") >= F.lit(date(2024, 1, 15))).select(
        "event_id", "user_id", "dt"
    )


@query("landing_two_loads", f"""WITH {shape_sql("oslp", "ocrd_feed")}
SELECT CardCode, sha256(CardName) AS CardName_Hash, UpdateDate, DebPayAcct FROM ocrd_feed""")
def landing_two_loads(spark, sf):
    root = fresh_dir(spark, "landing")
    log = CommitLog(spark, f"{root}/_commits")
    source = landing.Source("erp", "sap_b1", {"source_storage_path": sf})
    spec = {"name": "OCRD", "incremental_column": "UpdateDate"}
    feed = shaped(spark, sf, "ocrd_feed")
    early = feed.filter(F.col("UpdateDate") <= F.lit(date(1998, 6, 30)))
    landing.land_table(spark, source, spec, root, log, early)
    landing.land_table(spark, source, spec, root, log, feed)
    landing.land_table(spark, source, spec, root, log, feed)
    landed = landing.read_dataset(spark, root, log, "bronze", "erp", "OCRD")
    return landed.select("CardCode", "CardName_Hash", "UpdateDate", "DebPayAcct")


@query("stream_landing", "SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS user_id_Hash, ts, value FROM events")
def stream_landing(spark, sf):
    root = fresh_dir(spark, "stream")
    schema = table(spark, sf, "events").schema
    rule = masking.MaskingRule.of(hash=["user_id"], keep=["event_id", "ts", "value"])
    log = CommitLog(spark, f"{root}/_commits")
    for _ in range(2):  # the second call finds nothing new
        land_new_files(
            spark, sf, schema, root, "app", "events", f"{root}/checkpoint", log, rule, "events.parquet"
        )
    landed = landing.read_dataset(spark, root, log, "bronze", "app", "events")
    return landed.select("event_id", "user_id_Hash", "ts", "value")


_LANDED = ("OPRJ", "INV1", "PCH1", "OINV")
_REFINED = ("sap_oprj_silver", "silver_inv1", "silver_pch1", "silver_oinv")


def _pipeline(spark: SparkSession, sf: str) -> jobs.Pipeline:
    """Bronze from the shapes, written as a raw lake; then silver and the gold project dataset."""
    root = fresh_dir(spark, "medallion")
    for name in _LANDED:
        files.write_parquet(shaped(spark, sf, name.lower()), f"{root}/raw/{name.lower()}/{name}.parquet")
    tables = [catalogue.table_config(name) for name in _LANDED]
    source = landing.Source("erp", "sap_b1", {"source_storage_path": f"{root}/raw"}, tables)
    pipeline = jobs.Pipeline(
        spark, f"{root}/lake", [source],
        [t for t in jobs.delivered_silver("erp") if t.name in _REFINED],
        [t for t in jobs.delivered_gold(AS_OF) if t.name == "sap_project_profitability_gold"],
        store(),
    )
    pipeline.run()
    return pipeline


@query("medallion_run", _PROFIT_SQL)
def medallion_run(spark, sf):
    return plain(_pipeline(spark, sf).dataset("gold", "sap_project_profitability_gold"))


@query("medallion_metrics", f"""WITH {shape_sql("oprj", "inv1", "pch1", "oinv")}, {_PROJECT_SQL}
SELECT 'bronze' AS stage, 'OPRJ' AS dataset, count(*) AS rows_out FROM oprj
UNION ALL SELECT 'bronze', 'INV1', count(*) FROM inv1
UNION ALL SELECT 'bronze', 'PCH1', count(*) FROM pch1
UNION ALL SELECT 'bronze', 'OINV', count(*) FROM oinv
UNION ALL SELECT 'silver', 'sap_oprj_silver', count(*) FROM silver_oprj
UNION ALL SELECT 'silver', 'silver_inv1', count(*) FROM inv1
UNION ALL SELECT 'silver', 'silver_pch1', count(*) FROM pch1
UNION ALL SELECT 'silver', 'silver_oinv', count(*) FROM oinv
UNION ALL SELECT 'gold', 'sap_project_profitability_gold', count(*) FROM silver_oprj""")
def medallion_metrics(spark, sf):
    return _pipeline(spark, sf).metrics().select("stage", "dataset", "rows_out")


# Dataset, its rows in SQL, and what its contract refuses (where the data can come to that).
_VERDICTS = [
    ("silver", "gdpr_customers", _CUSTOMERS_SQL,
     "(consent_marketing OR consent_analytics) AND consent_timestamp IS NULL OR updated_at < created_at "
     "OR length(country_code) <> 2 OR email_hash IS NOT NULL AND length(email_hash) <> 64"),
    ("silver", "sap_ocrd_silver", "SELECT * FROM silver_ocrd", "UpdateDate < CreateDate OR length(CardName_Hash) <> 64"),
    ("silver", "sap_oprj_silver", "SELECT * FROM silver_oprj", "ValidTo < ValidFrom OR length(PrjName_Hash) <> 64"),
    ("silver", "sap_oslp_silver", "SELECT * FROM silver_oslp", "Commission < 0 OR Commission > 100"),
    *[("silver", f"silver_{t}", f"SELECT * FROM {t}", "false") for t in ("inv1", "pch1", "oinv")],
    ("gold", "sap_customer_analytics_gold", "SELECT * FROM customer_360",
     "lifetime_revenue < 0 OR credit_limit < 0 OR days_since_last_invoice < 0 "
     "OR credit_utilization_pct < 0 OR credit_utilization_pct > 200"),
    ("gold", "sap_project_profitability_gold", _PROFIT_SQL,
     "total_revenue < 0 OR total_cost < 0 OR duration_days < 0 OR gross_margin_pct < -100 OR gross_margin_pct > 100"),
    ("gold", "sap_revenue_metrics_gold", _revenue_sql("coalesce(n, 1)"),
     "total_revenue < 0 OR avg_invoice_value < 0 OR invoice_count < 0"),
]
_VERDICT_SQL = f"""{_CUSTOMER_360_SQL}, {shape_sql("oslp", "oprj", "inv1", "pch1", "crm")},
{_PROJECT_SQL}, {_EMPLOYEE_SQL}
SELECT *, CASE WHEN published THEN n END AS rows_out FROM (
{" UNION ALL ".join(
    f"SELECT '{stage}' AS stage, '{name}' AS dataset, count(*) > 0 AND count_if({bad}) = 0 AS published, count(*) AS n FROM ({sql}) x"
    for stage, name, sql, bad in _VERDICTS)}) v"""


@query("medallion_full", f"SELECT stage, dataset, published, rows_out FROM ({_VERDICT_SQL})")
def medallion_full(spark, sf):
    """All datasets of the silver and gold layers, each behind its contract: which are published, which refused."""
    root = fresh_dir(spark, "full")
    names = ("OCRD", "OSLP", "OPRJ", "INV1", "PCH1", "OINV")
    for name in names:
        files.write_parquet(shaped(spark, sf, name.lower()), f"{root}/raw/{name.lower()}/{name}.parquet")
    files.write_parquet(shaped(spark, sf, "crm"), f"{root}/raw/customers/customers.parquet")
    raw = {"source_storage_path": f"{root}/raw"}
    sources = [
        landing.Source("erp", "sap_b1", raw, [catalogue.table_config(name) for name in names]),
        landing.Source("crm", "sap_b1", raw | {"apply_gdpr": False}, [{"name": "customers"}]),
    ]
    pipeline = jobs.Pipeline(
        spark, f"{root}/lake", sources, jobs.delivered_silver("erp", "crm"), jobs.delivered_gold(AS_OF), store()
    )
    try:
        pipeline.run(keep_going=True)
    except DatasetsRefused:
        pass  # the verdicts tell
    return pipeline.verdicts().filter("stage <> 'bronze'").drop("reason")


@query("bucketed_upsert", f"""WITH {shape_sql("oinv")}
SELECT DocEntry, CardCode, CAST(CASE WHEN DocEntry % 5 = 0 THEN coalesce(DocTotal, 0) + 100 ELSE DocTotal END AS DOUBLE) AS total,
  CASE WHEN DocEntry % 5 = 0 THEN DATE '2002-01-01' ELSE UpdateDate END AS UpdateDate FROM oinv""")
def bucketed_upsert(spark, sf):
    """Invoices merged load by load into key buckets: changes, then older versions that came late."""
    invoices = shaped(spark, sf, "oinv").select("DocEntry", "CardCode", F.col("DocTotal").alias("total"), "UpdateDate")
    found = keyed.KeyedTable(spark, fresh_dir(spark, "buckets"), ["DocEntry"], ["UpdateDate"], buckets=16)
    changed = F.col("DocEntry") % 5 == 0
    found.upsert(invoices.filter(F.col("UpdateDate") < F.lit(date(1997, 1, 1))))
    found.upsert(invoices.filter(changed).withColumn("total", (F.coalesce("total", F.lit(0)) + 100).cast("decimal(18,2)"))
                 .withColumn("UpdateDate", F.lit(date(2002, 1, 1))))
    found.upsert(invoices)
    return plain(found.read())


@query("erase_due", f"""WITH {shape_sql("crm")}, customers AS ({_CUSTOMERS_SQL})
SELECT customer_id, retention_category, updated_at FROM customers
WHERE gdpr_delete_after IS NULL OR gdpr_delete_after > DATE '2024-01-15'""")
def erase_due(spark, sf):
    """Customers whose time is over, erased from a stored table; only their buckets are rewritten."""
    found = keyed.KeyedTable(spark, fresh_dir(spark, "erase"), ["customer_id"], ["updated_at"], buckets=16)
    found.upsert(silver.customers(shaped(spark, sf, "crm")))
    found.erase(found.read().filter(F.col("gdpr_delete_after") <= F.lit(date(2024, 1, 15))))
    return found.read().select("customer_id", "retention_category", "updated_at")


_CHANGED = """SELECT * REPLACE (
  CASE WHEN DocEntry % 5 = 0 AND UpdateDate < DATE '1998-06-30' THEN DocTotal + 100 ELSE DocTotal END AS DocTotal,
  CASE WHEN DocEntry % 5 = 0 AND UpdateDate < DATE '1998-06-30' THEN DATE '2002-01-01' ELSE UpdateDate END
    AS UpdateDate) FROM oinv"""


@query("medallion_two_loads", f"""WITH {shape_sql("oinv")}, newest AS ({_CHANGED})
SELECT CardCode, count(*) AS invoices, CAST(sum(DocTotal) AS DOUBLE) AS total FROM newest GROUP BY CardCode""")
def medallion_two_loads(spark, sf):
    """Two runs: in between, invoices changed, and others came in on the day of the watermark."""
    day, root = F.lit(date(1998, 6, 30)), fresh_dir(spark, "two-loads")
    raw = f"{root}/raw/oinv/OINV.parquet"
    invoices = shaped(spark, sf, "oinv")
    late = (F.col("UpdateDate") == day) & (F.col("DocEntry") % 2 == 0)
    changed = (F.col("DocEntry") % 5 == 0) & (F.col("UpdateDate") < day)
    pipeline = jobs.Pipeline(
        spark, f"{root}/lake",
        [landing.Source("erp", "sap_b1", {"source_storage_path": f"{root}/raw"}, [catalogue.table_config("OINV")])],
        [t for t in jobs.delivered_silver("erp") if t.name == "silver_oinv"], [], store(),
    )
    files.write_parquet(invoices.filter((F.col("UpdateDate") <= day) & ~late), raw)
    pipeline.run()
    newest = invoices.select(
        *[c for c in invoices.columns if c not in ("DocTotal", "UpdateDate")],
        F.when(changed, F.col("DocTotal") + 100).otherwise(F.col("DocTotal")).cast("decimal(18,2)").alias("DocTotal"),
        F.when(changed, F.lit(AS_OF)).otherwise(F.col("UpdateDate")).alias("UpdateDate"),
    ).select(*invoices.columns)
    files.write_parquet(newest, raw)
    pipeline.run()
    pipeline.compact("bronze", "OINV", "erp")
    return plain(
        pipeline.dataset("silver", "silver_oinv").groupBy("CardCode")
        .agg(F.count(F.lit(1)).alias("invoices"), F.sum("DocTotal").alias("total"))
    )


@query("sql_transform", """SELECT o_orderpriority, count(*) AS n FROM orders
WHERE o_totalprice >= 200000 GROUP BY o_orderpriority""")
def sql_transform(spark, sf):
    text = "SELECT o_orderpriority, count(*) AS n FROM o WHERE o_totalprice >= :low GROUP BY o_orderpriority"
    job = transforms.Transform("by_priority", sql=text, parameters={"low": 200000})
    return transforms.run_transform(spark, job, {"o": table(spark, sf, "orders")})


def _word_count(batch):
    return batch.assign(words=batch["text"].str.split().str.len().astype("int64"))[["doc_id", "words"]]


@query("batch_transform", """SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\\s+'),
  lambda x: x <> '')) AS BIGINT) AS words FROM documents""")
def batch_transform(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return transforms.map_batches(documents, _word_count, "doc_id long, words long")


# ---------------------------------------------------------------- contracts


def _check_rows(*rows: tuple) -> str:
    """(check, kind, severity, count or pass expression, observed, expected) as SQL."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"check\", '{kind}' AS kind, '{severity}' AS severity, ({passed}) AS passed,"
        f" CAST(({observed}) AS VARCHAR) AS observed, '{expected}' AS expected"
        for name, kind, severity, passed, observed, expected in rows
    )


def _zero(name: str, kind: str, severity: str, source: str, where: str) -> tuple:
    count = f"SELECT count(*) FROM {source} WHERE {where}"
    return name, kind, severity, f"({count}) = 0", count, 0


_ANALYTICS_CHECKS = _check_rows(
    ("missing_columns", "schema", "error", "TRUE", "SELECT 0", 0),
    ("extra_columns", "schema", "warning", "TRUE", "SELECT 0", 0),
    *[
        (f"{c.name}.type", "schema", "error", "TRUE", f"SELECT '{shown}'", c.type)
        for c, shown in zip(
            CUSTOMER_ANALYTICS.columns,
            ["string"] * 3 + ["double"] * 4 + ["int", "boolean", "int"],
        )
    ],
    *[
        _zero(f"{c}.nullable", "nullable", "error", "customer_360", f"{c} IS NULL")
        for c in ("customer_code", "customer_name_hash", "customer_type", "lifetime_revenue",
                  "current_balance", "credit_limit", "is_frozen")
    ],
    *[
        _zero(f"{c}.not_null", "not_null", "error", "customer_360", f"{c} IS NULL")
        for c in ("customer_code", "customer_name_hash")
    ],
    _zero("customer_name_hash.pattern", "pattern", "warning", "customer_360",
          "NOT regexp_full_match(customer_name_hash, '[a-f0-9]{64}')"),
    _zero("customer_type.allowed_values", "allowed_values", "error", "customer_360",
          "customer_type NOT IN ('C', 'S', 'L')"),
    *[
        _zero(f"{c}.min_value", "min_value", "error", "customer_360", f"{c} < 0")
        for c in ("lifetime_revenue", "credit_limit", "credit_utilization_pct", "days_since_last_invoice")
    ],
    _zero("credit_utilization_pct.max_value", "max_value", "error", "customer_360",
          "credit_utilization_pct > 200"),
    _zero("no_null_customer_codes", "not_null", "error", "customer_360", "customer_code IS NULL"),
    _zero("gdpr_customer_hash_valid", "violations", "error", "customer_360",
          "length(customer_name_hash) <> 64"),
    _zero("no_negative_lifetime_revenue", "violations", "error", "customer_360", "lifetime_revenue < 0"),
    _zero("no_negative_credit_limit", "violations", "error", "customer_360", "credit_limit < 0"),
    _zero("valid_credit_utilization", "violations", "warning", "customer_360",
          "credit_utilization_pct < 0 OR credit_utilization_pct > 200"),
    _zero("valid_customer_types", "violations", "error", "customer_360",
          "customer_type NOT IN ('C', 'S', 'L')"),
    ("minimum_customers", "volume", "warning", "(SELECT count(*) FROM customer_360) >= 1",
     "SELECT count(*) FROM customer_360", 1),
    ("completeness", "sla", "error", "(SELECT count(*) FROM customer_360) >= 1",
     "SELECT count(*) FROM customer_360", 1),
    ("customer_code.unique", "unique", "error", "TRUE", "SELECT 0", 0),
    ("no_duplicate_customers", "uniqueness", "error", "TRUE", "SELECT 0", 0),
)

_RESULT_COLUMNS = ["check", "kind", "severity", "passed", "observed", "expected"]


@query("contract_checks", f"{_CUSTOMER_360_SQL}\n{_ANALYTICS_CHECKS}")
def contract_checks(spark, sf):
    return checks.validate(customer_360(spark, sf), CUSTOMER_ANALYTICS).select(*_RESULT_COLUMNS)


@query("contract_verdict", f"""{_CUSTOMER_360_SQL}, results AS ({_ANALYTICS_CHECKS})
SELECT bool_and(passed OR severity <> 'error') AS passed,
  count(*) FILTER (WHERE NOT passed AND severity = 'error') AS errors,
  count(*) FILTER (WHERE NOT passed AND severity <> 'error') AS warnings FROM results""")
def contract_verdict(spark, sf):
    return checks.verdict(checks.validate(customer_360(spark, sf), CUSTOMER_ANALYTICS))


_LINES = Contract(
    "1.0.0", "lines", "silver", "data-team", "Order lines",
    (
        ColumnSpec("l_orderkey", "BIGINT", False, unique=True, not_null=True),
        ColumnSpec("l_linenumber", "INTEGER", False, unique=True, min_value=1, max_value=6),
        ColumnSpec("l_quantity", "DOUBLE", min_value=2),
        ColumnSpec("l_returnflag", "VARCHAR", allowed_values=("A", "N")),
        ColumnSpec("l_linestatus", "VARCHAR", pattern="^O$"),
    ),
    (
        Rule("late_or_large", "custom_sql", query="SELECT COUNT(*) FROM {dataset} WHERE l_quantity > 49", expected=0),
        Rule("mean_quantity", "custom_sql", "warning",
             query="SELECT CAST(SUM(l_quantity) AS BIGINT) FROM {dataset}", expected=1),
        Rule("few_columns", "custom_sql", query="SELECT COUNT(*) FROM (DESCRIBE {dataset}) "
             "WHERE column_name IN ('l_tax', 'l_comment')", expected=0),
        Rule("one_line_number", "uniqueness", "warning", column="l_linenumber"),
        Rule("many", "volume", min_rows=1_000_000_000),
        Rule("full_only", "not_null", column="l_orderkey", run_on="full_load"),
        Rule("skipped", "not_null", column="l_orderkey", skip_if="incremental"),
    ),
)


def _dups(name: str, kind: str, severity: str, column: str) -> tuple:
    count = (f"SELECT count(*) FROM (SELECT {column} FROM lineitem GROUP BY {column} "
             "HAVING count(*) > 1) d")
    return name, kind, severity, f"({count}) = 0", count, 0


@query("contract_rules", _check_rows(
    ("missing_columns", "schema", "error", "TRUE", "SELECT 0", 0),
    ("extra_columns", "schema", "warning", "FALSE", "SELECT 1", 0),
    ("l_orderkey.type", "schema", "error", "TRUE", "SELECT 'bigint'", "BIGINT"),
    ("l_linenumber.type", "schema", "error", "TRUE", "SELECT 'int'", "INTEGER"),
    ("l_quantity.type", "schema", "error", "TRUE", "SELECT 'double'", "DOUBLE"),
    ("l_returnflag.type", "schema", "error", "TRUE", "SELECT 'string'", "VARCHAR"),
    ("l_linestatus.type", "schema", "error", "TRUE", "SELECT 'string'", "VARCHAR"),
    _zero("l_orderkey.nullable", "nullable", "error", "lineitem", "l_orderkey IS NULL"),
    _zero("l_orderkey.not_null", "not_null", "error", "lineitem", "l_orderkey IS NULL"),
    _zero("l_linenumber.nullable", "nullable", "error", "lineitem", "l_linenumber IS NULL"),
    _zero("l_linenumber.min_value", "min_value", "error", "lineitem", "l_linenumber < 1"),
    _zero("l_linenumber.max_value", "max_value", "error", "lineitem", "l_linenumber > 6"),
    _zero("l_quantity.min_value", "min_value", "error", "lineitem", "l_quantity < 2"),
    _zero("l_returnflag.allowed_values", "allowed_values", "error", "lineitem",
          "l_returnflag NOT IN ('A', 'N')"),
    _zero("l_linestatus.pattern", "pattern", "warning", "lineitem", "l_linestatus <> 'O'"),
    _zero("late_or_large", "custom_sql", "error", "lineitem", "l_quantity > 49"),
    ("mean_quantity", "custom_sql", "warning", "FALSE",
     "SELECT CAST(sum(l_quantity) AS BIGINT) FROM lineitem", 1),
    ("few_columns", "custom_sql", "error", "FALSE", "SELECT 1", 0),
    _dups("l_orderkey.unique", "unique", "error", "l_orderkey"),
    _dups("l_linenumber.unique", "unique", "error", "l_linenumber"),
    _dups("one_line_number", "uniqueness", "warning", "l_linenumber"),
    ("many", "volume", "error", "FALSE", "SELECT count(*) FROM lineitem", 1_000_000_000),
))
def contract_rules(spark, sf):
    lines = table(spark, sf, "lineitem").select(*[c.name for c in _LINES.columns], "l_tax")
    return checks.validate(lines, _LINES, load_mode="incremental").select(*_RESULT_COLUMNS)


@query("quarantine_rows", """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
  concat_ws(',', CASE WHEN l_linenumber > 6 THEN 'l_linenumber.max_value' END,
    CASE WHEN l_quantity < 2 THEN 'l_quantity.min_value' END,
    CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag.allowed_values' END,
    CASE WHEN l_quantity > 49 THEN 'late_or_large' END) AS failed
FROM lineitem WHERE l_linenumber > 6 OR l_quantity < 2 OR l_returnflag NOT IN ('A', 'N') OR l_quantity > 49""")
def quarantine_rows(spark, sf):
    bad = checks.quarantine(table(spark, sf, "lineitem"), _LINES)
    return bad.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
        F.concat_ws(",", "failed_checks").alias("failed"),
    )


@query("changed_rows_check", _check_rows(
    _zero("o_totalprice.max_value", "max_value", "error",
          "(SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00') n",
          "o_totalprice > 400000"),
    _zero("o_orderstatus.allowed_values", "allowed_values", "error",
          "(SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00') n",
          "o_orderstatus NOT IN ('F', 'O')"),
))
def changed_rows_check(spark, sf):
    contract = Contract(
        "1.0.0", "orders", "silver", "data-team", "Orders",
        (ColumnSpec("o_totalprice", "DOUBLE", max_value=400000),
         ColumnSpec("o_orderstatus", "VARCHAR", allowed_values=("F", "O"))),
    )
    changed = checks.changed_since(table(spark, sf, "orders"), "o_orderdate", "2000-01-01 00:00:00")
    results = checks.validate(changed, contract).filter("kind <> 'schema'")
    return results.select(*_RESULT_COLUMNS)


@query("freshness_check", """SELECT 'l_shipdate.freshness' AS "check", 'error' AS severity, age <= 24 AS passed,
  CAST(age AS VARCHAR) AS observed
FROM (SELECT round((epoch(TIMESTAMP '2002-01-01 00:00:00') - epoch(max(l_shipdate))) / 3600.0, 1) AS age
      FROM lineitem) x""")
def freshness_check(spark, sf):
    found = checks.data_freshness(table(spark, sf, "lineitem"), "l_shipdate", 24, AS_OF)
    return found.select("check", "severity", "passed", "observed")


@query("growth_check", """SELECT 'expected_growth' AS "check", 'warning' AS severity, count(*) >= 1100 AS passed,
  CAST(count(*) AS VARCHAR) AS observed, '0.1' AS expected FROM orders""")
def growth_check(spark, sf):
    contract = Contract(
        "1.0.0", "orders", "silver", "data-team", "Orders", (ColumnSpec("o_orderkey", "BIGINT"),),
        sla={"completeness": {"expected_growth_rate": 0.1}},
    )
    results = checks.validate(table(spark, sf, "orders"), contract, previous_rows=1000)
    return results.filter("kind = 'sla'").select("check", "severity", "passed", "observed", "expected")


@query("unique_across_loads", """SELECT 'o_orderkey.unique' AS "check", FALSE AS passed, count(*) > 0 AS repeated
FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0""")
def unique_across_loads(spark, sf):
    """Keys of an increment that are published already."""
    contract = Contract(
        "1.0.0", "orders", "silver", "data-team", "Orders", (ColumnSpec("o_orderkey", "BIGINT", unique=True),),
    )
    orders = table(spark, sf, "orders")
    results = checks.validate(
        orders.filter("o_orderkey % 3 = 0"), contract, published=orders.filter("o_orderkey % 2 = 0")
    )
    return results.filter("kind = 'unique'").select("check", "passed", (F.col("observed").cast("long") > 0).alias("repeated"))


@query("migrate_failed_casts", """SELECT 'o_orderpriority' AS column_name, count(*) FILTER (
  o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL) AS failed FROM orders
UNION ALL SELECT 'o_orderkey', 0""")
def migrate_failed_casts(spark, sf):
    contract = Contract(
        "2.0.0", "orders", "silver", "data-team", "Orders",
        (ColumnSpec("o_orderkey", "VARCHAR"), ColumnSpec("o_orderpriority", "INTEGER")),
    )
    return failed_casts(table(spark, sf, "orders"), contract)


@query("schema_migrate", """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CAST(NULL AS VARCHAR) AS channel, CAST(o_totalprice AS BIGINT) AS o_totalprice_whole, o_orderdate
FROM (SELECT o_orderkey, o_custkey, floor(o_totalprice) AS o_totalprice, o_orderdate FROM orders) x""")
def schema_migrate(spark, sf):
    contract = Contract(
        "2.0.0", "orders", "silver", "data-team", "Orders",
        (ColumnSpec("o_orderkey", "BIGINT"), ColumnSpec("o_custkey", "VARCHAR"),
         ColumnSpec("channel", "VARCHAR"), ColumnSpec("o_totalprice_whole", "BIGINT"),
         ColumnSpec("o_orderdate", "TIMESTAMP")),
    )
    orders = table(spark, sf, "orders").withColumn(
        "o_totalprice_whole", F.floor("o_totalprice").cast("double")
    )
    return migrate(orders, contract, "auto")


@query("compiled_contract", f"""WITH {shape_sql("crm")},
shaped AS (SELECT customer_id, sha256(email) AS email_hash, upper(substr(country, 1, 2)) AS country_code,
  consent_marketing, consent_analytics, consent_timestamp, data_subject_rights_exercised,
  retention_category, created_at, updated_at, gdpr_delete_after FROM crm)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY consent_timestamp DESC NULLS LAST,
    email_hash, country_code, consent_marketing, consent_analytics, data_subject_rights_exercised,
    retention_category, created_at, updated_at, gdpr_delete_after NULLS LAST) AS rn
  FROM shaped WHERE customer_id IS NOT NULL AND country_code IS NOT NULL AND consent_marketing IS NOT NULL
    AND consent_analytics IS NOT NULL AND created_at IS NOT NULL AND updated_at IS NOT NULL) x
WHERE rn = 1""")
def compiled_contract(spark, sf):
    return compile_contract(CUSTOMERS)(shaped(spark, sf, "crm"))


@query("introspect", f"""WITH {shape_sql("inv1")}
SELECT 'DocEntry' AS column_name, 'BIGINT' AS column_type, CAST(0 AS INTEGER) AS position,
  count(*) FILTER (WHERE DocEntry IS NULL) AS null_rows, count(*) AS total_rows FROM inv1
UNION ALL SELECT 'LineNum', 'INTEGER', 1, count(*) FILTER (WHERE LineNum IS NULL), count(*) FROM inv1
UNION ALL SELECT 'ItemCode', 'VARCHAR', 2, count(*) FILTER (WHERE ItemCode IS NULL), count(*) FROM inv1
UNION ALL SELECT 'Project', 'VARCHAR', 3, count(*) FILTER (WHERE Project IS NULL), count(*) FROM inv1
UNION ALL SELECT 'LineTotal', 'DECIMAL', 4, count(*) FILTER (WHERE LineTotal IS NULL), count(*) FROM inv1
UNION ALL SELECT 'UpdateDate', 'DATE', 5, count(*) FILTER (WHERE UpdateDate IS NULL), count(*) FROM inv1""")
def introspect(spark, sf):
    return generate.introspect(shaped(spark, sf, "inv1"))


@query("confirmed_keys", """SELECT 'o_orderkey' AS column_name, (SELECT count(*) FROM (
    SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) d) AS duplicate_values
UNION ALL SELECT 'o_custkey', (SELECT count(*) FROM (
    SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1) d)
UNION ALL SELECT 'o_orderdate', (SELECT count(*) FROM (
    SELECT o_orderdate FROM orders GROUP BY 1 HAVING count(*) > 1) d)""")
def confirmed_keys(spark, sf):
    return generate.confirmed_keys(table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderdate"])


@query("profile_keys")
def profile_keys(spark, sf):
    return generate.key_profile(table(spark, sf, "orders"))


_LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_SETS = " UNION ALL ".join(
    f"SELECT '{','.join(s)}' AS key_columns, CAST({n} AS INTEGER) AS n_columns, "
    f"(SELECT count(*) FROM lineitem) = (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM lineitem) d) AS unique_rows"
    for n in (1, 2, 3) for s in combinations(_LINEITEM, n)
)


@query("composite_keys", f"""WITH sets AS ({_SETS}), keys AS (SELECT * FROM sets WHERE unique_rows)
SELECT key_columns, n_columns FROM keys k WHERE NOT EXISTS (SELECT 1 FROM keys s WHERE s.n_columns < k.n_columns
  AND list_has_all(string_split(k.key_columns, ','), string_split(s.key_columns, ',')))""")
def composite_keys(spark, sf):
    return generate.composite_keys(table(spark, sf, "lineitem"), _LINEITEM)


def _changed_orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    old = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    new = old.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"),
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"), F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_note"),
    )
    return old, new


# Every row hangs on the NULLs that the data show.
@query("contract_from_data", """WITH c AS (SELECT
    count(o_orderkey) = count(*) AS k, count(o_custkey) = count(*) AS c, count(nullif(o_orderstatus, 'P')) = count(*) AS s,
    count(nullif(o_orderpriority, '5-LOW')) = count(*) AS p FROM orders)
SELECT 'column' AS kind, 'o_orderkey' AS name, 'BIGINT' AS detail, k AS required FROM c
UNION ALL SELECT 'column', 'o_custkey', 'VARCHAR', c FROM c UNION ALL SELECT 'column', 'o_orderstatus', 'VARCHAR', s FROM c
UNION ALL SELECT 'column', 'o_note', 'VARCHAR', p FROM c
UNION ALL SELECT 'rule', 'no_null_o_orderkey', 'not_null', TRUE FROM c WHERE k
UNION ALL SELECT 'rule', 'no_null_o_custkey', 'not_null', TRUE FROM c WHERE c
UNION ALL SELECT 'rule', 'no_null_o_orderstatus', 'not_null', TRUE FROM c WHERE s
UNION ALL SELECT 'rule', 'no_null_o_note', 'not_null', TRUE FROM c WHERE p
UNION ALL SELECT 'rule', 'minimum_rows', 'volume', TRUE""")
def contract_from_data(spark, sf):
    new = _changed_orders(spark, sf)[1]
    return generate.contract_frame(new, generate.generate_contract(new, "orders", "silver"))


@query("schema_diff", """WITH c AS (SELECT
    count(o_orderstatus) = count(*) AS before, count(nullif(o_orderstatus, 'P')) = count(*) AS after,
    count(o_orderpriority) = count(*) AS gone, count(nullif(o_orderpriority, '5-LOW')) = count(*) AS note FROM orders)
SELECT 'o_custkey' AS column_name, 'type' AS change, 'BIGINT' AS old, 'VARCHAR' AS new, 'breaking' AS impact FROM c
UNION ALL SELECT 'o_orderstatus', 'nullable', 'False', 'True', 'compatible' FROM c WHERE before AND NOT after
UNION ALL SELECT 'o_orderstatus', 'not_null', 'True', 'False', 'compatible' FROM c WHERE before AND NOT after
UNION ALL SELECT 'o_note', 'added', NULL, 'VARCHAR', CASE WHEN note THEN 'breaking' ELSE 'compatible' END FROM c
UNION ALL SELECT 'o_orderpriority', 'removed', 'VARCHAR', NULL, 'breaking' FROM c
UNION ALL SELECT NULL, 'rule removed', 'no_null_o_orderstatus', NULL, 'patch' FROM c WHERE before AND NOT after
UNION ALL SELECT NULL, 'rule removed', 'no_null_o_orderpriority', NULL, 'patch' FROM c WHERE gone
UNION ALL SELECT NULL, 'rule added', NULL, 'no_null_o_note', 'patch' FROM c WHERE note""")
def schema_diff(spark, sf):
    old, new = (generate.generate_contract(x, "orders", "silver") for x in _changed_orders(spark, sf))
    return diff_frame(spark, old, new)


# ---------------------------------------------------------------- record linkage

PARTS = linkage.LinkageSettings(
    id="p_partkey",
    blocking=[["p_type"]],
    comparisons=[
        linkage.Comparison("p_name", "edit", 2, {2: 0.9, 1: 0.06, 0: 0.04}, {2: 0.015, 1: 0.03, 0: 0.955}),
        linkage.Comparison("p_brand", "exact", 0, {2: 0.9, 0: 0.1}, {2: 0.04, 0: 0.96}),
        linkage.Comparison("p_size", "near", 1, {2: 0.8, 1: 0.15, 0: 0.05}, {2: 0.02, 1: 0.04, 0: 0.94}),
    ],
    prior=0.001,
    min_probability=0.5,
)


def _double(x: float) -> str:
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


def _scored_sql(pairs: str) -> str:
    """Levels and weight of pairs (a, b) of parts, in the order the score adds them up."""
    name, brand, size = PARTS.comparisons

    def case(c, level):
        w = {lv: _double(c.weight(lv)) for lv in c.levels}
        close = f" WHEN {level} = 1 THEN {w[1]}" if 1 in w else ""
        return f"CASE WHEN {level} = 2 THEN {w[2]}{close} ELSE {w[0]} END"

    return f"""levelled AS (
SELECT a.p_partkey AS id_l, b.p_partkey AS id_r,
  CASE WHEN a.p_name = b.p_name THEN 2 WHEN levenshtein(a.p_name, b.p_name) <= 2 THEN 1 ELSE 0 END AS level_p_name,
  CASE WHEN a.p_brand = b.p_brand THEN 2 ELSE 0 END AS level_p_brand,
  CASE WHEN a.p_size = b.p_size THEN 2 WHEN abs(a.p_size - b.p_size) <= 1 THEN 1 ELSE 0 END AS level_p_size
FROM {pairs}),
scored AS (SELECT *, {_double(PARTS.prior_weight)} + {case(name, "level_p_name")}
  + {case(brand, "level_p_brand")} + {case(size, "level_p_size")} AS match_weight FROM levelled)"""


_BRUTE = "part a JOIN part b ON a.p_type = b.p_type AND a.p_partkey < b.p_partkey"
_MATCHED = f"SELECT id_l, id_r FROM scored WHERE match_weight >= {_double(PARTS.min_weight)}"
_CLUSTERS = f"""WITH RECURSIVE {_scored_sql(_BRUTE)},
matched AS ({_MATCHED}),
edges AS (SELECT id_l AS a, id_r AS b FROM matched UNION SELECT id_r, id_l FROM matched),
reach AS (SELECT p_partkey AS a, p_partkey AS b FROM part
          UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
clusters AS (SELECT a AS p_partkey, min(b) AS cluster_id FROM reach GROUP BY a)"""

# The links themselves: equal records to the smallest id, then close but different values.
_LINKS = f"""g AS (SELECT *, min(p_partkey) OVER (PARTITION BY p_type, p_name, p_brand, p_size) AS rep FROM part),
cells AS (SELECT p_type, p_name, p_brand, p_size, min(p_partkey) AS lo, max(p_partkey) AS hi
          FROM part GROUP BY 1, 2, 3, 4),
links AS (
  SELECT rep AS id_l, p_partkey AS id_r FROM g WHERE rep <> p_partkey
  UNION SELECT least(u.lo, d.hi), greatest(u.lo, d.hi) FROM cells u JOIN cells d
    ON u.p_type = d.p_type AND u.p_name = d.p_name AND u.p_brand = d.p_brand AND u.p_size = d.p_size + 1
  UNION SELECT least(x.lo, y.lo), greatest(x.lo, y.lo) FROM cells x JOIN cells y
    ON x.p_type = y.p_type AND x.p_brand = y.p_brand AND x.p_size = y.p_size AND x.p_name < y.p_name
    AND levenshtein(x.p_name, y.p_name) <= 2)"""


def _parts_links(spark, sf):
    return linkage.candidate_links(table(spark, sf, "part"), PARTS)


@query("linkage_links", f"WITH {_LINKS} SELECT * FROM links")
def linkage_links(spark, sf):
    return _parts_links(spark, sf)


@query("linkage_scores", f"""WITH {_LINKS},
{_scored_sql("links JOIN part a ON links.id_l = a.p_partkey JOIN part b ON links.id_r = b.p_partkey")}
SELECT id_l, id_r, level_p_name, level_p_brand, level_p_size, match_weight,
  round(pow(2.0e0, match_weight) / (1.0e0 + pow(2.0e0, match_weight)), 9) AS match_probability
FROM scored WHERE match_weight >= {_double(PARTS.min_weight)}""")
def linkage_scores(spark, sf):
    parts = table(spark, sf, "part")
    scored = linkage.scored_links(parts, linkage.candidate_links(parts, PARTS), PARTS)
    return linkage.matches(scored, PARTS).select(
        "id_l", "id_r", "level_p_name", "level_p_brand", "level_p_size", "match_weight",
        F.round("match_probability", 9).alias("match_probability"),
    )


@query("linkage_clusters", f"{_CLUSTERS} SELECT * FROM clusters")
def linkage_clusters(spark, sf):
    parts = table(spark, sf, "part")
    return linkage.cluster(parts, _parts_links(spark, sf), "p_partkey").select("p_partkey", "cluster_id")


@query("linkage_survivors", f"""{_CLUSTERS}
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, cluster_id FROM (
  SELECT p.*, c.cluster_id, row_number() OVER (PARTITION BY c.cluster_id
    ORDER BY p.p_retailprice DESC NULLS LAST, p.p_partkey) AS rn
  FROM part p JOIN clusters c ON p.p_partkey = c.p_partkey) x WHERE rn = 1""")
def linkage_survivors(spark, sf):
    return linkage.deduplicate(table(spark, sf, "part"), PARTS, ["p_retailprice"])


_EM_COLUMNS = ["p_name", "p_brand", "p_size"]


@query("linkage_pattern_counts", """SELECT
  CAST(CASE WHEN a.p_name = b.p_name THEN 2 ELSE 0 END AS INTEGER) AS p_name,
  CAST(CASE WHEN a.p_brand = b.p_brand THEN 2 ELSE 0 END AS INTEGER) AS p_brand,
  CAST(CASE WHEN a.p_size = b.p_size THEN 2 ELSE 0 END AS INTEGER) AS p_size, count(*) AS pairs
FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_partkey < b.p_partkey GROUP BY 1, 2, 3""")
def linkage_pattern_counts(spark, sf):
    counts = agreement.pattern_counts(table(spark, sf, "part"), ["p_type"], _EM_COLUMNS)
    rows = [(*pattern, n) for pattern, n in counts.items()]
    return spark.createDataFrame(rows, "p_name int, p_brand int, p_size int, pairs long")


_PARTY_COLUMNS = [linkage.Comparison("name", "edit", 1), linkage.Comparison("segment"), linkage.Comparison("seller")]


def _em_sql() -> str:
    """All pairs are formed and levelled; then plain rounds, more than enough of them."""
    same = lambda c: f"CASE WHEN a.{c} IS NULL OR b.{c} IS NULL THEN -1 WHEN a.{c} = b.{c} THEN 2"
    levels = {"name": (2, 1, 0), "segment": (2, 0), "seller": (2, 0)}
    params = [(c, lv) for c, own in levels.items() for lv in own]
    share = lambda c, lv, what: f"coalesce(sum({what}) FILTER ({c} = {lv}), 0) / sum({what}) FILTER ({c} >= 0)"
    start = {2: 0.9, 1: 0.07, 0: 0.03}
    first = ", ".join(f"{start[lv] / sum(start[x] for x in levels[c])}::DOUBLE" for c, lv in params)
    like = lambda side: " * ".join(
        "CASE " + " ".join(f"WHEN {c} = {lv} THEN {side}_{c}{lv}" for lv in own) + " ELSE 1 END" for c, own in levels.items()
    )
    return f"""WITH RECURSIVE {shape_sql("party")},
pairs AS (
  SELECT {same("name")} WHEN levenshtein(a.name, b.name) <= 1 THEN 1 ELSE 0 END AS name, {same("segment")} ELSE 0 END AS segment,
    {same("seller")} ELSE 0 END AS seller, a.nation = b.nation AS inside, count(*)::DOUBLE AS n
  FROM party a JOIN party b ON a.id < b.id GROUP BY 1, 2, 3, 4
),
u AS (SELECT {", ".join(f"{share(c, lv, 'n')} AS u_{c}{lv}" for c, lv in params)} FROM pairs WHERE NOT inside),
k AS (SELECT * FROM pairs, u WHERE inside),
em(i, lam, {", ".join(f"m_{c}{lv}" for c, lv in params)}) AS (
  SELECT 0, 0.01::DOUBLE, {first}
  UNION ALL
  SELECT any_value(i) + 1, sum(np) / sum(n), {", ".join(share(c, lv, "np") for c, lv in params)}
  FROM (SELECT *, n * lam * {like("m")} / (lam * {like("m")} + (1 - lam) * {like("u")}) AS np FROM em, k WHERE i < 3000) x
  HAVING count(*) > 0
),
last AS (SELECT * FROM em WHERE i = 3000)
""" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {lv} AS level, round(m_{c}{lv}, 4) AS m, round(u_{c}{lv}, 4) AS u, round(lam, 4) AS prior FROM last, u"
        for c, lv in params
    )


@query("linkage_em", _em_sql())
def linkage_em(spark, sf):
    """Agreement probabilities of three records of every customer, a name being close within one edit."""
    found = agreement.estimate(shaped(spark, sf, "party"), ["nation"], _PARTY_COLUMNS)
    if not found.settled:
        raise ValueError("the model is not determined")
    rows = [
        (c.column, lv, round(found.m[j][lv], 4), round(found.u[j][lv], 4), round(found.prior, 4))
        for j, c in enumerate(_PARTY_COLUMNS) for lv in c.levels
    ]
    return spark.createDataFrame(rows, "column_name string, level int, m double, u double, prior double")
