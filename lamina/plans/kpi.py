"""Key figures of a services company."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lamina.functions.exprs import mean_of, money, safe_ratio
from lamina.operators.skew import safe_join


def side_by_side(*figures: DataFrame) -> DataFrame:
    """Columns of several one-row results in one row (a union and an aggregate, not a cross join)."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), figures)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _total(df: DataFrame, amount: str, name: str) -> DataFrame:
    total = F.coalesce(F.sum(money(df, amount)), F.lit(0))
    return df.agg(total.alias(name))


# ---------------------------------------------------------------- revenue


def total_revenue(invoices: DataFrame) -> DataFrame:
    return _total(invoices, "DocTotal", "total_revenue")


def revenue_by_service(lines: DataFrame, items: DataFrame) -> DataFrame:
    totals = lines.groupBy("ItemCode").agg(F.sum(money(lines, "LineTotal")).alias("revenue"))
    return totals.join(items.select("ItemCode", "ItemName"), "ItemCode", "left").select(
        "ItemCode", "ItemName", "revenue"
    )


def revenue_by_customer(invoices: DataFrame, partners: DataFrame) -> DataFrame:
    totals = invoices.groupBy("CardCode").agg(F.sum(money(invoices, "DocTotal")).alias("revenue"))
    return totals.join(partners.select("CardCode", "CardName_Hash"), "CardCode", "left").select(
        "CardCode", "CardName_Hash", "revenue"
    )


def revenue_by_project(lines: DataFrame, projects: DataFrame) -> DataFrame:
    totals = lines.groupBy(F.col("Project").alias("PrjCode")).agg(
        F.sum(money(lines, "LineTotal")).alias("revenue")
    )
    return totals.join(projects.select("PrjCode", "PrjName_Hash"), "PrjCode", "left").select(
        F.col("PrjCode").alias("Project"), "PrjName_Hash", "revenue"
    )


def deal_size(invoices: DataFrame) -> DataFrame:
    """Mean invoice total."""
    sums = invoices.agg(
        F.sum(money(invoices, "DocTotal")).alias("total_revenue"), F.count("DocTotal").alias("invoices")
    )
    return sums.withColumn("avg_deal_size", mean_of(F.col("total_revenue"), F.col("invoices")))


# ---------------------------------------------------------------- profitability


def gross_margin(invoices: DataFrame, purchases: DataFrame) -> DataFrame:
    """(revenue - costs) / revenue."""
    both = side_by_side(
        _total(invoices, "DocTotal", "revenue"), _total(purchases, "DocTotal", "costs")
    )
    return both.withColumn(
        "gross_margin", safe_ratio(F.col("revenue") - F.col("costs"), F.col("revenue"))
    )


def service_margin(lines: DataFrame, cost_lines: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue, cost and margin per item; both kinds of lines go through one aggregate."""
    earned = lines.select("ItemCode", money(lines, "LineTotal").alias("revenue"))
    spent = cost_lines.select("ItemCode", money(cost_lines, "LineTotal").alias("cost"))
    flows, zero = earned.unionByName(spent, allowMissingColumns=True), F.lit(0)
    totals = flows.groupBy("ItemCode").agg(
        F.coalesce(F.sum("revenue"), zero).alias("revenue"), F.coalesce(F.sum("cost"), zero).alias("cost")
    )
    return totals.join(items.select("ItemCode", "ItemName"), "ItemCode", "left").select(
        "ItemCode", "ItemName", "revenue", "cost",
        safe_ratio(F.col("revenue") - F.col("cost"), F.col("revenue")).alias("margin"),
    )


def cost_center_pnl(journal: DataFrame, accounts: DataFrame, centers: DataFrame) -> DataFrame:
    """Credit minus debit per cost centre and account name.

    Journal lines are summed per (centre, account) before any name is joined.
    """
    posted = journal.withColumnRenamed("Account", "AcctCode")
    sums = posted.groupBy("OcrCode", "AcctCode").agg(
        F.sum(money(journal, "Credit")).alias("credit"), F.sum(money(journal, "Debit")).alias("debit")
    )
    names = accounts.select("AcctCode", "AcctName")
    named = safe_join(sums, names, ["AcctCode"], counted_from=posted.select("AcctCode"))
    grouped = named.groupBy("OcrCode", "AcctName").agg(
        F.sum("credit").alias("credit"), F.sum("debit").alias("debit")
    )
    centers = centers.select("OcrCode", "OcrName")
    return safe_join(grouped, centers, ["OcrCode"], counted_from=posted.select("OcrCode")).select(
        "OcrCode", "OcrName", "AcctName", "credit", "debit",
        (F.col("credit") - F.col("debit")).alias("result"),
    )


# ---------------------------------------------------------------- cash


def dso_dpo(
    invoices: DataFrame,
    receipts: DataFrame,
    purchases: DataFrame,
    payments: DataFrame,
    days: int = 365,
) -> DataFrame:
    """Days sales and days payable outstanding.

    Receivables are invoiced minus received, payables purchased minus paid.
    """
    sums = side_by_side(
        _total(invoices, "DocTotal", "invoiced"),
        _total(receipts, "DocTotal", "received"),
        _total(purchases, "DocTotal", "purchased"),
        _total(payments, "DocTotal", "paid"),
    )
    receivable = (F.col("invoiced") - F.col("received")).cast("double")
    payable = (F.col("purchased") - F.col("paid")).cast("double")
    return sums.withColumn(
        "dso", safe_ratio(receivable, F.col("invoiced")) * F.lit(float(days))
    ).withColumn("dpo", safe_ratio(payable, F.col("purchased")) * F.lit(float(days)))


def cash_collected(receipts: DataFrame) -> DataFrame:
    return _total(receipts, "DocTotal", "cash_collected")


def collection_rate(invoices: DataFrame, receipts: DataFrame) -> DataFrame:
    """Received divided by invoiced."""
    sums = side_by_side(
        _total(invoices, "DocTotal", "invoiced"), _total(receipts, "DocTotal", "received")
    )
    return sums.withColumn("collection_rate", safe_ratio(F.col("received"), F.col("invoiced")))


# ---------------------------------------------------------------- operations


def active_projects(projects: DataFrame) -> DataFrame:
    return projects.agg(F.count_if(F.col("Active") == "Y").alias("active_projects"))


def revenue_per_employee(invoices: DataFrame, employees: DataFrame) -> DataFrame:
    """Revenue divided by the number of sales employees."""
    both = side_by_side(
        _total(invoices, "DocTotal", "revenue"),
        employees.agg(F.count_distinct("SlpCode").alias("headcount")),
    )
    return both.withColumn("revenue_per_employee", safe_ratio(F.col("revenue"), F.col("headcount")))


def top_customers(invoices: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the highest revenue (ties by code)."""
    totals = invoices.groupBy("CardCode").agg(F.sum(money(invoices, "DocTotal")).alias("revenue"))
    return totals.orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("CardCode")).limit(n)


def customer_concentration(invoices: DataFrame, n: int = 10) -> DataFrame:
    """Share of the ``n`` largest customers in revenue."""
    top = top_customers(invoices, n).agg(F.sum("revenue").alias("top_revenue"))
    both = side_by_side(top, _total(invoices, "DocTotal", "revenue"))
    return both.withColumn("concentration", safe_ratio(F.col("top_revenue"), F.col("revenue")))


def new_vs_repeat(invoices: DataFrame) -> DataFrame:
    """Invoices and revenue of first and of later invoices.

    An invoice is new when it is its customer's first by date, then number. First totals come out
    of a per-customer minimum, which combines before the shuffle, instead of ranking all invoices.
    """
    dated = invoices.filter(F.col("CardCode").isNotNull() & F.col("DocDate").isNotNull())
    first = F.min(F.struct("DocDate", "DocEntry", money(invoices, "DocTotal").alias("total")))
    per_customer = dated.groupBy("CardCode").agg(
        first.alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.sum(money(invoices, "DocTotal")).alias("total"),
    )
    zero = F.lit(0)
    sums = per_customer.agg(
        F.count(F.lit(1)).alias("n_new"),
        F.coalesce(F.sum("first.total"), zero).alias("r_new"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_all"),
        F.coalesce(F.sum("total"), zero).alias("r_all"),
    )
    kinds = F.array(
        F.struct(F.lit("new").alias("kind"), F.col("n_new").alias("invoices"),
                 F.col("r_new").alias("revenue")),
        F.struct(F.lit("repeat").alias("kind"), (F.col("n_all") - F.col("n_new")).alias("invoices"),
                 (F.col("r_all") - F.col("r_new")).alias("revenue")),
    )
    return sums.select(F.explode(kinds).alias("k")).select("k.*")
