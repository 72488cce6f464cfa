"""Shapes of the evidence tables and the vocabularies their columns use."""

from pyspark.sql import types as T

# --- fixed values: vocabularies ----------------------------------------------
DIMENSIONS = ["completeness", "validity", "uniqueness", "consistency", "accuracy", "timeliness", "integrity"]
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
RESULT_STATUSES = ["PASS", "WARN", "FAIL", "ERROR"]
RUN_STATUSES = ["RUNNING", "SUCCESS", "COMPLETED_WITH_FAILURES", "FAILED"]
RUN_TYPES = ["PROFILE", "RULES", "ETL_RECON", "QUARANTINE"]
QUARANTINE_STATUSES = ["OPEN", "IN_REVIEW", "FIXED", "REPROCESSED", "IGNORED", "REJECTED"]
OPEN_STATUSES = ["OPEN", "IN_REVIEW"]
RESOLVED_STATUSES = ["FIXED", "REPROCESSED", "IGNORED", "REJECTED"]
CHECK_TYPES = ["row_count", "sum_check", "distinct_check", "null_check", "orphan_check", "hash_check"]
SENSITIVITIES = ["PUBLIC", "INTERNAL", "CONFIDENTIAL", "PII", "PHI", "PCI", "SOX"]
MASKING_STRATEGIES = ["NONE", "HASH", "PARTIAL", "REDACT", "TOKENIZE"]

# --- fixed values: share of each dimension in the overall score ---------------
DEFAULT_WEIGHTS = {
    "completeness": 0.25,
    "validity": 0.20,
    "uniqueness": 0.15,
    "consistency": 0.15,
    "accuracy": 0.15,
    "timeliness": 0.10,
}

# --- fixed values: how long an open row may wait ------------------------------
SLA_CLOCKS = {"CRITICAL": "4 hours", "HIGH": "1 day", "MEDIUM": "3 days", "LOW": "7 days"}

PCT = T.DecimalType(7, 4)
MONEY = T.DecimalType(18, 2)


# --- shapes, as DDL text ------------------------------------------------------
RULES = (
    "rule_id string, rule_name string, schema_name string, table_name string, column_name string, "
    "dimension string, severity string, expr string, min_pass_pct double, is_active boolean, "
    "data_domain string, description string, key_columns array<string>, parent_table string, parent_column string, "
    "selector string, allowed_table string, allowed_column string"
)

CLASSIFICATION = (
    "schema_name string, table_name string, column_name string, sensitivity string, "
    "masking_strategy string, owner_team string, regulatory_tag array<string>, notes string"
)

STEWARD_DOMAINS = "db_user string, data_domain string, granted_by string"

# Staging accepts anything: dates stay text, nothing is required but the load columns.
STAGED_CUSTOMER = (
    "customer_id string, name string, email string, phone string, state string, country string, "
    "income decimal(14,2), registration_date string"
)
STAGED_SALES = (
    "order_id string, customer_id string, product_id string, order_date string, "
    "revenue decimal(14,2), region string, category string"
)
STAGED_EMPLOYEE = (
    "employee_id string, age int, department string, salary decimal(14,2), joining_date string, "
    "attrition string, location string"
)

PRODUCTS = (
    "product_id bigint, sku string, name string, category string, unit_price decimal(12,2), active boolean"
)
