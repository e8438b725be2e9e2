"""The seven contracts of the delivered datasets.

Names, types, limits and rule names are fixed values that callers depend on.
"""

from __future__ import annotations

from lamina.contracts.model import ColumnSpec, Contract, ContractStore, Rule
from lamina.sources.catalogue import EMPLOYEE_DROP, PARTNER_DROP

HEX64 = "^[a-f0-9]{64}$"
COUNTRY = "^[A-Z]{2}$"
FLAG = ("Y", "N", "")
PARTNER_KIND = ("C", "S", "L")


def _key(name: str, kind: str) -> ColumnSpec:
    return ColumnSpec(name, kind, False, unique=True, not_null=True)


def _must(name: str, kind: str, **limits) -> ColumnSpec:
    return ColumnSpec(name, kind, False, not_null=True, **limits)


def _hash(name: str, required: bool = True) -> ColumnSpec:
    return ColumnSpec(name, "VARCHAR", not required, not_null=required, pattern=HEX64)


def _all(kind: str, *names: str) -> list[ColumnSpec]:
    return [ColumnSpec(n, kind) for n in names]


def _unique(name: str, column: str) -> Rule:
    return Rule(name, "uniqueness", column=column)


def _filled(name: str, column: str) -> Rule:
    return Rule(name, "not_null", column=column)


def _none(name: str, where: str, severity: str = "error") -> Rule:
    return Rule(name, "violations", severity, where=where)


def _hash_length(name: str, column: str) -> Rule:
    return _none(name, f"length({column}) <> 64")


def _rows(name: str, severity: str = "error") -> Rule:
    return Rule(name, "volume", severity, min_rows=1)


def _absent(name: str, columns) -> Rule:
    return Rule(name, "absent_columns", columns=tuple(columns))


def _evolution(change: str, day: str) -> dict:
    return {
        "backward_compatible": True,
        "breaking_changes_allowed": False,
        "deprecation_notice_days": 30,
        "migration_strategy": "strict",
        "changelog": [{"version": "1.0.0", "date": day, "changes": [change]}],
    }


def _sla(growth: float | None = None) -> dict:
    complete: dict = {"min_row_count": 1}
    if growth is not None:
        complete["expected_growth_rate"] = growth
    return {
        "freshness": {"max_age_hours": 24, "schedule": "daily"},
        "completeness": complete,
        "data_retention": {"max_age_days": 2555},
    }


def _hashed(field: str) -> list[dict]:
    return [{"field": field, "method": "SHA-256", "output_field": f"{field}_Hash"}]


CUSTOMERS = Contract(
    "1.0.0", "gdpr_customers", "silver", "data-governance-team",
    "Pseudonymized customers with consent and retention state",
    (
        _key("customer_id", "VARCHAR"),
        _hash("email_hash", required=False),
        _must("country_code", "VARCHAR", pattern=COUNTRY),
        _must("consent_marketing", "BOOLEAN"),
        _must("consent_analytics", "BOOLEAN"),
        ColumnSpec("consent_timestamp", "TIMESTAMP"),
        ColumnSpec(
            "data_subject_rights_exercised", "VARCHAR",
            allowed_values=(
                "none", "access", "rectification", "erasure", "restriction", "portability", "objection",
            ),
        ),
        ColumnSpec(
            "retention_category", "VARCHAR", False,
            allowed_values=("active", "inactive", "to_delete", "deleted"),
        ),
        _must("created_at", "TIMESTAMP"),
        _must("updated_at", "TIMESTAMP"),
        ColumnSpec("gdpr_delete_after", "DATE"),
    ),
    (
        _unique("no_duplicate_customers", "customer_id"),
        _filled("no_null_customer_ids", "customer_id"),
        _none("valid_country_codes", "length(country_code) <> 2 OR country_code <> upper(country_code)"),
        Rule("valid_email_hashes", "pattern", column="email_hash", pattern=HEX64),
        _none(
            "consent_timestamp_present_when_consent_given",
            "(consent_marketing OR consent_analytics) AND consent_timestamp IS NULL",
        ),
        _none("updated_at_not_before_created_at", "updated_at < created_at"),
        _none(
            "retention_flagged_for_deletion",
            "retention_category = 'to_delete' AND gdpr_delete_after IS NULL", "warning",
        ),
        _rows("minimum_customers"),
    ),
    _sla(),
    _evolution("Initial schema", "2024-12-05"),
    {"classification": "PII", "gdpr_applicable": True},
)

PARTNERS = Contract(
    "1.0.0", "sap_ocrd_silver", "silver", "sap-data-team",
    "Business partners, cleansed, one row per code",
    (
        _key("CardCode", "VARCHAR"),
        _hash("CardName_Hash"),
        ColumnSpec("CardType", "VARCHAR", False, allowed_values=PARTNER_KIND),
        *_all("INTEGER", "GroupCode", "Territory", "SlpCode"),
        *_all("VARCHAR", "Currency"),
        *_all("DATE", "CreateDate", "UpdateDate"),
        *_all("DECIMAL", "Balance", "CreditLine"),
        ColumnSpec("frozenFor", "VARCHAR", allowed_values=FLAG),
        *_all("DATE", "FrozenFrom", "FrozenTo"),
        *_all("VARCHAR", "DebPayAcct"),
        *_all("DECIMAL", "Discount"),
        *_all("DATE", "ValidFrom", "ValidTo"),
    ),
    (
        _absent(
            "gdpr_no_pii_columns",
            [
                "Phone1", "Phone2", "Cellular", "Fax", "E_Mail", "Address", "Address2", "ZipCode", "City",
                "County", "Country", "State1", "State2", "Building", "MailAddrss", "MailZipCod", "MailCity",
                "MailCounty", "MailCountr", "MailState", "MailBuildi", "LicTradNum", "VatIdUnCmp", "Email",
            ],
        ),
        _hash_length("gdpr_valid_cardname_hash", "CardName_Hash"),
        _filled("gdpr_cardname_hash_not_null", "CardName_Hash"),
        _unique("no_duplicate_partners", "CardCode"),
        _filled("no_null_card_codes", "CardCode"),
        _none("update_after_create", "UpdateDate < CreateDate"),
        _none("valid_card_types", "CardType NOT IN ('C', 'S', 'L')"),
        _none("valid_frozen_status", "frozenFor NOT IN ('Y', 'N', '')", "warning"),
        _rows("minimum_partners"),
    ),
    _sla(0.02),
    _evolution("Initial schema", "2024-12-29"),
    {
        "classification": "GDPR-Compliant",
        "pseudonymized_fields": _hashed("CardName"),
        "excluded_pii_fields": list(PARTNER_DROP),
    },
)

PROJECTS = Contract(
    "1.0.0", "sap_oprj_silver", "silver", "sap-data-team",
    "Projects with valid dates, one row per code",
    (
        _key("PrjCode", "VARCHAR"),
        _hash("PrjName_Hash"),
        *_all("VARCHAR", "CardCode"),
        ColumnSpec("Active", "VARCHAR", allowed_values=FLAG),
        *_all("DATE", "ValidFrom", "ValidTo", "CreateDate", "UpdateDate", "DueDate", "ClosingDate"),
        *_all("INTEGER", "FinncPriod"),
    ),
    (
        _absent("gdpr_no_project_pii", ["PrjName"]),
        _hash_length("gdpr_valid_prjname_hash", "PrjName_Hash"),
        _filled("gdpr_prjname_hash_not_null", "PrjName_Hash"),
        _unique("no_duplicate_projects", "PrjCode"),
        _filled("no_null_project_codes", "PrjCode"),
        _none("valid_date_ranges", "ValidTo < ValidFrom"),
        _none("update_after_create", "UpdateDate < CreateDate"),
        _none("valid_active_status", "Active NOT IN ('Y', 'N', '')", "warning"),
        _rows("minimum_projects", "warning"),
    ),
    _sla(0.05),
    _evolution("Initial schema", "2024-12-29"),
    {"classification": "GDPR-Compliant", "pseudonymized_fields": _hashed("PrjName")},
)

EMPLOYEES = Contract(
    "1.0.0", "sap_oslp_silver", "silver", "sap-data-team",
    "Sales employees, one row per code",
    (
        _key("SlpCode", "INTEGER"),
        _hash("SlpName_Hash"),
        ColumnSpec("Active", "VARCHAR", allowed_values=FLAG),
        *_all("DECIMAL", "Commission"),
        *_all("INTEGER", "EmployeeID"),
    ),
    (
        _absent("gdpr_no_employee_contact_info", [*EMPLOYEE_DROP, "E_Mail", "Phone", "Fax"]),
        _hash_length("gdpr_valid_slpname_hash", "SlpName_Hash"),
        _filled("gdpr_slpname_hash_not_null", "SlpName_Hash"),
        _unique("no_duplicate_employees", "SlpCode"),
        _filled("no_null_employee_codes", "SlpCode"),
        _none("valid_active_status", "Active NOT IN ('Y', 'N', '')", "warning"),
        _none("valid_commission_percentage", "Commission < 0 OR Commission > 100", "warning"),
        _rows("minimum_employees", "warning"),
    ),
    _sla(0.01),
    _evolution("Initial schema", "2024-12-29"),
    {
        "classification": "GDPR-Compliant",
        "pseudonymized_fields": _hashed("SlpName"),
        "excluded_pii_fields": [", ".join([*EMPLOYEE_DROP, "Fax"])],
    },
)

REVENUE = Contract(
    "1.0.0", "sap_revenue_metrics_gold", "gold", "sap-analytics-team",
    "Daily revenue by customer, project and sales employee",
    (
        _must("metric_date", "DATE"),
        *_all("VARCHAR", "customer_code"),
        _hash("customer_name_hash", required=False),
        *_all("VARCHAR", "project_code"),
        _hash("project_name_hash", required=False),
        *_all("INTEGER", "sales_employee_code"),
        _must("total_revenue", "DECIMAL", min_value=0),
        _must("invoice_count", "INTEGER", min_value=0),
        ColumnSpec("avg_invoice_value", "DECIMAL", min_value=0),
        *_all("VARCHAR", "revenue_by_service"),
    ),
    (
        _none("no_negative_revenue", "total_revenue < 0"),
        _none("no_negative_invoice_count", "invoice_count < 0"),
        _hash_length("gdpr_customer_hash_consistency", "customer_name_hash"),
        _hash_length("gdpr_project_hash_consistency", "project_name_hash"),
        _none(
            "valid_avg_invoice_calculation",
            "invoice_count > 0 AND abs(avg_invoice_value - try_divide(total_revenue, invoice_count)) > 0.01",
            "warning",
        ),
        _rows("revenue_completeness", "warning"),
        _none("no_future_dates", "metric_date > current_date()"),
    ),
    _sla(),
    _evolution("Initial schema", "2024-12-29"),
    {"classification": "GDPR-Compliant"},
)

CUSTOMER_ANALYTICS = Contract(
    "1.0.0", "sap_customer_analytics_gold", "gold", "sap-analytics-team",
    "Customer view with lifetime revenue, credit use and recency",
    (
        _key("customer_code", "VARCHAR"),
        _hash("customer_name_hash"),
        ColumnSpec("customer_type", "VARCHAR", False, allowed_values=PARTNER_KIND),
        ColumnSpec("lifetime_revenue", "DECIMAL", False, min_value=0),
        ColumnSpec("current_balance", "DECIMAL", False),
        ColumnSpec("credit_limit", "DECIMAL", False, min_value=0),
        ColumnSpec("credit_utilization_pct", "DECIMAL", min_value=0, max_value=200),
        ColumnSpec("days_since_last_invoice", "INTEGER", min_value=0),
        ColumnSpec("is_frozen", "BOOLEAN", False),
        *_all("INTEGER", "primary_sales_employee"),
    ),
    (
        _unique("no_duplicate_customers", "customer_code"),
        _filled("no_null_customer_codes", "customer_code"),
        _hash_length("gdpr_customer_hash_valid", "customer_name_hash"),
        _none("no_negative_lifetime_revenue", "lifetime_revenue < 0"),
        _none("no_negative_credit_limit", "credit_limit < 0"),
        _none(
            "valid_credit_utilization",
            "credit_utilization_pct < 0 OR credit_utilization_pct > 200", "warning",
        ),
        _none("valid_customer_types", "customer_type NOT IN ('C', 'S', 'L')"),
        _rows("minimum_customers", "warning"),
    ),
    _sla(),
    _evolution("Initial schema", "2024-12-29"),
    {"classification": "GDPR-Compliant"},
)

PROFITABILITY = Contract(
    "1.0.0", "sap_project_profitability_gold", "gold", "sap-analytics-team",
    "Revenue, cost and margin per project",
    (
        _key("project_code", "VARCHAR"),
        _hash("project_name_hash"),
        *_all("VARCHAR", "customer_code"),
        ColumnSpec("project_status", "VARCHAR", False, allowed_values=("Active", "Closed")),
        ColumnSpec("total_revenue", "DECIMAL", False, min_value=0),
        ColumnSpec("total_cost", "DECIMAL", False, min_value=0),
        ColumnSpec("gross_profit", "DECIMAL", False),
        ColumnSpec("gross_margin_pct", "DECIMAL", min_value=-100, max_value=100),
        *_all("DATE", "project_start_date", "project_end_date"),
        ColumnSpec("duration_days", "INTEGER", min_value=0),
    ),
    (
        _unique("no_duplicate_projects", "project_code"),
        _filled("no_null_project_codes", "project_code"),
        _hash_length("gdpr_project_hash_valid", "project_name_hash"),
        _none("no_negative_revenue", "total_revenue < 0"),
        _none("no_negative_cost", "total_cost < 0"),
        _none("valid_gross_profit_calculation", "abs(gross_profit - (total_revenue - total_cost)) > 0.01"),
        _none(
            "valid_margin_calculation",
            "total_revenue > 0 AND abs(gross_margin_pct"
            " - try_divide(total_revenue - total_cost, total_revenue) * 100) > 0.1",
            "warning",
        ),
        _none("valid_project_dates", "project_end_date < project_start_date"),
        _none("valid_duration", "duration_days < 0"),
        _rows("minimum_projects", "warning"),
    ),
    _sla(),
    _evolution("Initial schema", "2024-12-29"),
    {"classification": "GDPR-Compliant"},
)

CONTRACTS: dict[str, Contract] = {
    c.dataset: c
    for c in (
        CUSTOMERS, PARTNERS, PROJECTS, EMPLOYEES, REVENUE, CUSTOMER_ANALYTICS, PROFITABILITY,
    )
}


def store(folder: str | None = None) -> ContractStore:
    """The delivered contracts, and those of a folder."""
    return ContractStore(folder, CONTRACTS)
