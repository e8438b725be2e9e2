"""Business datasets: revenue, customers, projects.

Facts are aggregated before they are joined, so joins move one row per key. Sums run on
decimals and are exact; ratios are doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, functions as F

from lamina.functions.exprs import (
    as_of_date, days_between, label, mean_of, money, packed_text, present, share_percent, unpacked_text,
)
from lamina.operators.skew import safe_join
from lamina.session import broadcast_limit

NAMES_BYTES = 16 << 20  # names of projects, by Catalyst's estimate, that a session with broadcasts may send to all tasks


def revenue_metrics(
    invoices: DataFrame,
    lines: DataFrame,
    partners: DataFrame,
    projects: DataFrame,
    grain: str = "line",
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Revenue per day, customer, project and sales employee.

    With ``grain="line"`` an invoice total counts once for each of its lines, as in the
    published definition; with ``grain="invoice"`` once per project on the invoice.

    Lines are first reduced to (invoice, project, number of lines). The fan-out then becomes a
    factor instead of rows: an invoice with a million lines is one row per project.
    Partner and project codes are unique in the silver layer, so their names join last, to the
    finished groups, and travel as bytes through the joins and the sort.

    ``stage`` takes the groups with their partners' names and gives the same rows back. ``cut_lineage`` there
    ends the shuffles of lines, headers and groups before those of the projects' names and the sort begin.
    """
    if grain not in ("line", "invoice"):
        raise ValueError(f"Unknown grain {grain}")
    # Dealt out by invoice once: counting, the join and the folding of headers all happen there.
    per_invoice = (
        lines.filter(F.col("DocEntry").isNotNull())
        .select("DocEntry", F.coalesce("Project", F.lit("")).alias("project_code"))
        .repartition("DocEntry").groupBy("DocEntry", "project_code").agg(F.count(F.lit(1)).alias("n"))
    )
    dated = invoices.filter(F.col("DocDate").isNotNull()).select(
        "DocEntry", "DocDate", "CardCode", "SlpCode", money(invoices, "DocTotal").alias("total")
    )
    if grain == "invoice":
        dated = dated.distinct()
    # Copies of a header fold into one row, so that counting rows below counts distinct invoices.
    header = ["DocEntry", "DocDate", "CardCode", "SlpCode"]
    folded = [F.sum("total").alias("total"), F.count("total").alias("n_totals")]
    times = F.coalesce("n", F.lit(1)) if grain == "line" else F.lit(1).cast("long")
    # A header without a key has no lines; such headers stay out of the join, where they would meet.
    keyed = (
        dated.filter(F.col("DocEntry").isNotNull()).join(per_invoice, "DocEntry", "left")
        .groupBy(*header, "project_code").agg(*folded, F.max("n").alias("n"))
    )
    keyless = dated.filter(F.col("DocEntry").isNull()).groupBy(*header).agg(*folded)
    detail = keyed.unionByName(keyless, allowMissingColumns=True).withColumn("times", times)
    groups = (
        detail.groupBy(
            F.col("DocDate").alias("metric_date"),
            F.col("CardCode").alias("customer_code"),
            F.coalesce("project_code", F.lit("")).alias("project_code"),
            F.col("SlpCode").alias("sales_employee_code"),
        )
        .agg(
            F.sum(F.col("total") * F.col("times").cast("decimal(10,0)")).alias("total_revenue"),
            F.count("DocEntry").cast("int").alias("invoice_count"),
            F.sum(F.col("n_totals") * F.col("times")).alias("n_totals"),
        )
        .filter(F.col("total_revenue") >= 0)
    )
    named = safe_join(
        groups,
        partners.select(
            F.col("CardCode").alias("customer_code"),
            packed_text(F.col("CardName_Hash")).alias("customer_name_hash"),
        ),
        ["customer_code"],
        counted_from=invoices.select(F.col("CardCode").alias("customer_code")),
    )
    if stage is not None:
        named = stage(named)
    most = broadcast_limit(invoices.sparkSession)
    # No project has an empty code: as NULL these rows need no partner and can be spread.
    named = safe_join(
        named.withColumn("PrjCode", F.when(F.col("project_code") != "", F.col("project_code"))),
        projects.select("PrjCode", packed_text(F.col("PrjName_Hash")).alias("project_name_hash")),
        ["PrjCode"],
        limit=max(most, NAMES_BYTES) if most >= 0 else None,
        counted_from=lines.select(F.col("Project").alias("PrjCode")),
    )
    return named.orderBy(F.desc("metric_date"), F.desc("total_revenue")).select(
        "metric_date",
        "customer_code",
        unpacked_text(F.col("customer_name_hash")).alias("customer_name_hash"),
        "project_code",
        unpacked_text(F.col("project_name_hash")).alias("project_name_hash"),
        "sales_employee_code",
        "total_revenue",
        "invoice_count",
        mean_of(F.col("total_revenue"), F.col("n_totals")).alias("avg_invoice_value"),
        F.lit(None).cast("string").alias("revenue_by_service"),
    )


def customer_analytics(partners: DataFrame, invoices: DataFrame, as_of: Any = None) -> DataFrame:
    """One row per customer: lifetime revenue, credit use and days since the last invoice.

    Revenue and last invoice date come from one aggregate over the invoices; NULLs drop out of
    both by themselves.
    """
    history = (
        invoices.filter(F.col("CardCode").isNotNull())
        .groupBy("CardCode")
        .agg(
            F.sum(money(invoices, "DocTotal")).alias("revenue"),
            F.max("DocDate").alias("last_invoice_date"),
        )
    )
    customers = partners.filter(F.col("CardType") == "C")
    revenue = F.coalesce("revenue", F.lit(0))
    return (
        customers.join(history, "CardCode", "left")
        .select(
            F.col("CardCode").alias("customer_code"),
            F.col("CardName_Hash").alias("customer_name_hash"),
            F.col("CardType").alias("customer_type"),
            revenue.alias("lifetime_revenue"),
            F.col("Balance").alias("current_balance"),
            F.col("CreditLine").alias("credit_limit"),
            share_percent(F.col("Balance"), F.col("CreditLine")).alias("credit_utilization_pct"),
            days_between(F.col("last_invoice_date"), as_of_date(as_of))
            .cast("int")
            .alias("days_since_last_invoice"),
            (F.col("frozenFor") == "Y").alias("is_frozen"),
            F.col("SlpCode").alias("primary_sales_employee"),
        )
        .orderBy(F.desc_nulls_last("lifetime_revenue"))
    )


def project_profitability(
    projects: DataFrame, revenue_lines: DataFrame, cost_lines: DataFrame, as_of: Any = None
) -> DataFrame:
    """Revenue, cost and margin per project; both kinds of lines go through one aggregate."""
    earned = revenue_lines.select("Project", money(revenue_lines, "LineTotal").alias("revenue"))
    spent = cost_lines.select("Project", money(cost_lines, "LineTotal").alias("cost"))
    flows = earned.unionByName(spent, allowMissingColumns=True)
    totals = (
        flows.filter(present(F.col("Project")))
        .groupBy(F.col("Project").alias("PrjCode"))
        .agg(F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"))
    )
    revenue, cost = F.coalesce("revenue", F.lit(0)), F.coalesce("cost", F.lit(0))
    return (
        projects.join(totals, "PrjCode", "left")
        .select(
            F.col("PrjCode").alias("project_code"),
            F.col("PrjName_Hash").alias("project_name_hash"),
            F.col("CardCode").alias("customer_code"),
            label(F.col("Active") == "Y", "Active", "Closed").alias("project_status"),
            revenue.alias("total_revenue"),
            cost.alias("total_cost"),
            (revenue - cost).alias("gross_profit"),
            share_percent(revenue - cost, revenue).alias("gross_margin_pct"),
            F.col("ValidFrom").alias("project_start_date"),
            F.col("ValidTo").alias("project_end_date"),
            days_between(F.col("ValidFrom"), F.coalesce(F.col("ValidTo"), as_of_date(as_of)))
            .cast("int")
            .alias("duration_days"),
        )
        .orderBy(F.desc_nulls_last("gross_profit"))
    )


def daily_sales(orders: DataFrame, day: str = "order_date", amount: str = "order_total") -> DataFrame:
    return orders.groupBy(F.col(day).alias("order_date")).agg(
        F.sum(money(orders, amount)).alias("total_revenue"),
        F.count(F.lit(1)).alias("orders_count"),
    )


def monthly_revenue(
    invoices: DataFrame,
    partners: DataFrame,
    as_of: Any = None,
    months: int = 12,
    stamped: bool = False,
) -> DataFrame:
    """Revenue per month and known customer over the last months; unknown customers share one group.

    ``stamped`` adds the time of processing as ``processed_at``.
    """
    recent = invoices.filter(F.col("DocDate") >= F.add_months(as_of_date(as_of), -months)).select(
        F.col("CardCode").alias("code"), F.trunc("DocDate", "month").alias("month"), "DocNum", "DocStatus",
        money(invoices, "DocTotal").alias("total"),
    )
    closed = F.when(F.col("DocStatus") == "C", F.col("total")).otherwise(F.lit(0))
    # One row per customer, month and invoice number: what may share a group after the join.
    reduced = recent.groupBy("code", "month", "DocNum").agg(
        F.sum("total").alias("total"), F.count("total").alias("n"), F.sum(closed).alias("closed")
    )
    known = partners.select(F.col("CardCode").alias("code"), F.col("CardName_Hash").alias("customer_hash")).withColumn(
        "customer_code", F.col("code")
    )
    groups = (
        safe_join(reduced, known, ["code"])
        .groupBy(F.col("month").alias("revenue_month"), "customer_code", "customer_hash")
        .agg(
            F.count_distinct("DocNum").alias("invoice_count"), F.sum("total").alias("total_revenue"),
            F.sum("n").alias("n_totals"), F.sum("closed").alias("closed_revenue"),
        )
    )
    out = groups.withColumn(
        "avg_invoice_value", mean_of(F.col("total_revenue"), F.col("n_totals"))
    ).drop("n_totals")
    return out.withColumn("processed_at", F.current_timestamp()) if stamped else out


def customer_summary(
    orders: DataFrame,
    customer: str = "customer_id",
    amount: str = "amount",
    day: str = "order_date",
) -> DataFrame:
    """Number, sum, mean, first and last order per customer."""
    grouped = orders.groupBy(F.col(customer).alias("customer_id")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(money(orders, amount)).alias("total_spent"),
        F.count(amount).alias("n_amounts"),
        F.min(day).alias("first_order_date"),
        F.max(day).alias("last_order_date"),
    )
    return (
        grouped.filter(F.col("total_orders") > 0)
        .withColumn("avg_order_value", mean_of(F.col("total_spent"), F.col("n_amounts")))
        .drop("n_amounts")
    )
