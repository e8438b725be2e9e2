"""Cleansed datasets: one row per key, normalized values, invalid rows left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lamina.functions.exprs import (
    clamp_percent, code2, in_order, is_sha256, normalized, one_of, or_default, or_zero, present,
)
from lamina.functions.hashing import pseudonym
from lamina.operators.dedup import keep_latest

PARTNER_TYPES = ("C", "S", "L")
MONEY = "decimal(18,2)"


def customers(bronze: DataFrame) -> DataFrame:
    """CRM customers: hashed e-mail, two-letter country, newest row per customer."""
    newest = keep_latest(
        bronze.filter(F.col("customer_id").isNotNull()), ["customer_id"], ["updated_at"]
    )
    return newest.select(
        "customer_id",
        pseudonym(F.col("email")).alias("email_hash"),
        code2(F.col("country")).alias("country_code"),
        "consent_marketing",
        "consent_analytics",
        "consent_timestamp",
        "data_subject_rights_exercised",
        "retention_category",
        "created_at",
        "updated_at",
        "gdpr_delete_after",
    )


def partners(bronze: DataFrame) -> DataFrame:
    """Business partners (already masked): valid rows, newest per code, defaults filled.

    The partner type is filtered as delivered, so lower-case types are left out although the
    output is upper case.
    """
    valid = bronze.filter(
        present(F.col("CardCode"))
        & is_sha256(F.col("CardName_Hash"))
        & one_of(F.col("CardType"), PARTNER_TYPES)
    )
    newest = keep_latest(valid, ["CardCode"], ["UpdateDate", "CreateDate"])
    return newest.select(
        "CardCode",
        "CardName_Hash",
        normalized(F.col("CardType")).alias("CardType"),
        "GroupCode",
        "Territory",
        "SlpCode",
        normalized(F.col("Currency")).alias("Currency"),
        "CreateDate",
        "UpdateDate",
        or_zero(F.col("Balance"), MONEY).alias("Balance"),
        or_zero(F.col("CreditLine"), MONEY).alias("CreditLine"),
        or_default(F.col("frozenFor"), "N").alias("frozenFor"),
        "FrozenFrom",
        "FrozenTo",
        or_default(F.col("DebPayAcct"), "").alias("DebPayAcct"),
        or_zero(F.col("Discount"), MONEY).alias("Discount"),
        "ValidFrom",
        "ValidTo",
    )


def projects(bronze: DataFrame) -> DataFrame:
    """Projects (already masked) with consistent dates, newest per code.

    A closing date is compared with the start of the project wherever a due date is known; an
    unknown start then leaves the row out.
    """
    closing, due, start = F.col("ClosingDate"), F.col("DueDate"), F.col("ValidFrom")
    valid = bronze.filter(
        present(F.col("PrjCode"))
        & is_sha256(F.col("PrjName_Hash"))
        & in_order(start, F.col("ValidTo"))
        & (closing.isNull() | due.isNull() | (closing >= start))
    )
    newest = keep_latest(valid, ["PrjCode"], ["UpdateDate", "CreateDate"])
    return newest.select(
        "PrjCode", "PrjName_Hash", "CardCode", "Active", "ValidFrom", "ValidTo", "DueDate",
        "ClosingDate", "CreateDate", "UpdateDate", "FinncPriod",
    )


def employees(bronze: DataFrame) -> DataFrame:
    """Sales employees (already masked): commission within 0..100, one row per code."""
    valid = bronze.filter(F.col("SlpCode").isNotNull() & is_sha256(F.col("SlpName_Hash")))
    chosen = keep_latest(
        valid, ["SlpCode"], [], ["SlpName_Hash", "Active", "Commission", "EmployeeID"]
    )
    return chosen.select(
        "SlpCode", "SlpName_Hash", "Active",
        clamp_percent(F.col("Commission")).alias("Commission"),
        "EmployeeID",
    )


def pass_through(bronze: DataFrame) -> DataFrame:
    """Transaction tables carry no personal data and are taken as they are."""
    return bronze


def orders_clean(orders: DataFrame, status: str = "status") -> DataFrame:
    return orders.filter(F.col(status).isNotNull())
