"""Bindings for masking, classification, access, audit and statistical rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden import schemas
from tablewarden.functions import masking
from tablewarden.functions.hashing import draw
from tablewarden.operators import change_feed
from tablewarden.operators import governance as gov
from tablewarden.operators import rules as r
from tablewarden.operators import trends
from tablewarden.plans import inputs, quarantines
from tablewarden.plans.cleaning import CATALOG_SQL, catalog
from tablewarden.plans.registry import Loader, draw_sql, query, stamp_sql
from tablewarden.plans.rules import RULES


# --- masking --------------------------------------------------------------------------------
def partial_sql(value: str) -> str:
    """Built from the list of characters: those that are not among the first or last two are starred."""
    size = f"len({value})"
    starred = f"regexp_replace({value}[3:{size} - 2], '.', '*', 'gs')"
    middle = f"CASE {size} WHEN 4 THEN '*' ELSE {starred} END"
    return f"coalesce(CASE WHEN {size} > 3 THEN {value}[:2] || {middle} || {value}[-2:] END, '****')"


def email_sql(value: str) -> str:
    """Built from the parts of the address."""
    parts = f"string_split({value}, '@')"
    return f"coalesce(CASE WHEN len({parts}) > 1 THEN {parts}[1][:1] || '***@' || {parts}[2] END, '****')"


def masks(name: str, columns: list[str], spark_side, sql_side):
    listed = ", ".join(f"{sql_side(c)} AS {c}" for c in columns)

    @query(name, f"WITH {inputs.DIRTY_CUSTOMERS} SELECT customer_id, {listed} FROM dirty_customers")
    def run(load):
        return inputs.dirty_customers(load).select("customer_id", *[spark_side(F.col(c)).alias(c) for c in columns])


masks("mask_partial", ["name", "phone", "country"], masking.mask_partial, partial_sql)
masks("mask_email", ["email"], masking.mask_email, email_sql)
masks("hash_id", ["email", "phone"], masking.hash_id, lambda c: f"sha256(coalesce({c}, ''))")

POLICY = [
    ("customers", "email", "PII", "PARTIAL", "CRM", ["GDPR", "CCPA"]),
    ("customers", "name", "PII", "PARTIAL", "CRM", ["GDPR"]),
    ("customers", "phone", "PII", "REDACT", "CRM", ["GDPR", "CCPA"]),
    ("customers", "country", "INTERNAL", "NONE", "CRM", None),
    ("customers", "signup_date", "INTERNAL", "TOKENIZE", "CRM", None),
    ("customers", "customer_id", "INTERNAL", "HASH", "CRM", ["GDPR"]),
    ("customers", "no_such_column", "INTERNAL", "HASH", "CRM", None),
]


@query(
    "masked_table",
    f"""WITH {inputs.DIRTY_CUSTOMERS} SELECT sha256(customer_id) AS customer_id, {partial_sql('name')} AS name, segment,
      {email_sql('email')} AS email, '***REDACTED***' AS phone, country, sha256('pepper' || signup_date) AS signup_date
    FROM dirty_customers""",
)
def masked_table(load):
    policy = [{"column_name": c, "masking_strategy": how} for _, c, _, how, _, _ in POLICY]
    return gov.apply_policy(inputs.dirty_customers(load), policy, salt="pepper")


@query(
    "mask_redact_tokenize",
    f"""WITH {inputs.DIRTY_CUSTOMERS} SELECT customer_id, '***REDACTED***' AS name, sha256('salt-1' || phone) AS phone
    FROM dirty_customers""",
)
def mask_redact_tokenize(load):
    return inputs.dirty_customers(load).select(
        "customer_id",
        masking.redact(F.col("name")).alias("name"),
        masking.tokenize(F.col("phone"), "salt-1").alias("phone"),
    )


# --- classification and coverage ----------------------------------------------------------------
CLASSIFIED = [
    ("customer", "c_name", "PII", "PARTIAL"),
    ("customer", "c_acctbal", "CONFIDENTIAL", "NONE"),
    ("orders", "o_totalprice", "SOX", "NONE"),
    ("orders", "o_custkey", "INTERNAL", "HASH"),
    ("events", "user_id", "INTERNAL", "HASH"),
]


@query(
    "classification_coverage",
    f"""WITH {CATALOG_SQL}, policy(table_name, column_name, sensitivity, masking_strategy) AS
      (VALUES {', '.join(str(x) for x in CLASSIFIED)})
    SELECT table_name, column_name, data_type, populated_rows, sensitivity, masking_strategy,
      CASE WHEN sensitivity IS NULL THEN 'UNCLASSIFIED' ELSE 'OK' END AS coverage_status
    FROM columns_found LEFT JOIN policy USING (table_name, column_name)""",
)
def classification_coverage(load):
    rows = [("main", t, c, level, how, "data", None, None) for t, c, level, how in CLASSIFIED]
    policy = load.spark.createDataFrame(rows, schemas.CLASSIFICATION)
    return gov.classification_coverage(catalog(load), policy).drop("schema_name", "ordinal")


COVERED = {}
for _rule in RULES:
    if _rule.active:
        COVERED[(_rule.table, _rule.column)] = COVERED.get((_rule.table, _rule.column), 0) + 1


@query(
    "rule_coverage",
    f"""WITH {CATALOG_SQL}, covered(table_name, column_name, n) AS
      (VALUES {', '.join(f"('{t}', '{c}', {n}::BIGINT)" for (t, c), n in COVERED.items())})
    SELECT table_name, column_name, populated_rows, coalesce(n, 0) AS rule_count, coalesce(n, 0) > 0 AS covered
    FROM columns_found LEFT JOIN covered USING (table_name, column_name)""",
)
def rule_coverage(load):
    found = gov.rule_coverage(catalog(load), r.catalog(load.spark, RULES))
    return found.select("table_name", "column_name", "populated_rows", "rule_count", "covered")


# --- access ------------------------------------------------------------------------------------------
@query(
    "domain_filter",
    f"""WITH {quarantines.BAD}, rows AS (SELECT quarantine_id, rule_id,
        CASE WHEN data_domain = 'view' THEN 'GLOBAL' ELSE data_domain END AS data_domain FROM bad)
    SELECT * FROM rows WHERE data_domain IN ('GLOBAL', 'click')""",
)
def domain_filter(load):
    domain = F.when(F.col("data_domain") == "view", "GLOBAL").otherwise(F.col("data_domain"))
    rows = quarantines.bad_events(load).select("quarantine_id", "rule_id", domain.alias("data_domain"))
    return gov.filter_by_domain(
        rows, user="steward_click", roles=["dq_steward"], mapping=quarantines.stewards(load)
    )


# --- audit --------------------------------------------------------------------------------------------
AUDITED = ["order_id", "customer_id", "status", "total_amount"]
AUDIT_AS_OF = "2001-08-03 00:00:00"


def audited(load: Loader):
    def side(df):
        return df.select("order_id", "customer_id", "status", F.col("total_amount").cast("string").alias("total_amount"))

    return gov.change_audit(
        side(inputs.recon_source(load)), side(inputs.recon_target(load)), "order_id", table="orders", as_of=AUDIT_AS_OF
    )


def _json(side: str) -> str:
    return (
        f"to_json({{'order_id': {side}.order_id, 'customer_id': {side}.customer_id, 'status': {side}.status, "
        f"'total_amount': {side}.total_amount::VARCHAR}})::VARCHAR"
    )


AUDIT = f"""{inputs.RECON}, audit AS (
  SELECT CASE WHEN s.order_id IS NULL THEN 'INSERT' WHEN t.order_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
    coalesce(s.order_id, t.order_id)::VARCHAR AS row_pk,
    CASE WHEN s.order_id IS NOT NULL THEN {_json('s')} END AS old_row,
    CASE WHEN t.order_id IS NOT NULL THEN {_json('t')} END AS new_row,
    CASE WHEN s.order_id IS NOT NULL AND t.order_id IS NOT NULL THEN concat_ws(',',
      CASE WHEN s.customer_id IS DISTINCT FROM t.customer_id THEN 'customer_id' END,
      CASE WHEN s.status IS DISTINCT FROM t.status THEN 'status' END,
      CASE WHEN s.total_amount IS DISTINCT FROM t.total_amount THEN 'total_amount' END) END AS changed_cols
  FROM source s FULL JOIN target t ON s.order_id = t.order_id),
  changes AS (SELECT * FROM audit WHERE changed_cols IS NULL OR changed_cols <> '')"""


@query("change_audit", f"WITH {AUDIT} SELECT * FROM changes")
def change_audit(load):
    return audited(load).select("action", "row_pk", "old_row", "new_row", "changed_cols")


@query(
    "audit_activity",
    f"""WITH {AUDIT}, timed AS (SELECT *, 'user_' || ({draw_sql('row_pk', 'user')} % 3) AS db_user,
        TIMESTAMP '{AUDIT_AS_OF}' - to_hours(({draw_sql('row_pk', 'hours')} % 4000)::INT) AS event_time FROM changes)
    SELECT db_user, 'main' AS schema_name, 'orders' AS table_name, action, count(*) AS event_count,
      {stamp_sql('min(event_time)')} AS first_event, {stamp_sql('max(event_time)')} AS last_event
    FROM timed WHERE event_time >= TIMESTAMP '{AUDIT_AS_OF}' - INTERVAL 90 DAY GROUP BY db_user, action""",
)
def audit_activity(load):
    key = F.col("row_pk")
    spread = audited(load).withColumns(
        {
            "db_user": F.concat(F.lit("user_"), draw(key, "user") % 3),
            "event_time": F.col("event_time") - F.make_dt_interval(hours=(draw(key, "hours") % 4000).cast("int")),
        }
    )
    return gov.audit_activity(spread, as_of=AUDIT_AS_OF)


# --- statistical rules -----------------------------------------------------------------------------------
@query(
    "rule_zscore",
    """WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY 1)
    SELECT event_id, event_type, value, round(abs(value - m) / d, 5) AS z FROM events JOIN s USING (event_type)
    WHERE abs(value - m) / d > 3""",
)
def rule_zscore(load):
    found = trends.zscore_rows(load("events"), "value", by=["event_type"])
    return found.select("event_id", "event_type", "value", F.round("z", 5).alias("z"))


@query(
    "rule_time_window",
    f"""SELECT {stamp_sql("time_bucket(INTERVAL '6 hours', ts)")} AS window_start, count(*) AS row_count,
      CASE WHEN count(*) BETWEEN 70 AND 95 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM events GROUP BY time_bucket(INTERVAL '6 hours', ts)""",
)
def rule_time_window(load):
    return trends.window_counts(load("events"), "ts", window="6 hours", low=70, high=95)


@query(
    "heartbeat_gaps",
    f"""WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)
    SELECT user_id, {stamp_sql('before')} AS gap_start, {stamp_sql('ts')} AS gap_end,
      round((epoch_us(ts) - epoch_us(before)) / 1000000, 3) AS gap_seconds
    FROM e WHERE epoch_us(ts) - epoch_us(before) > 1800000000""",
)
def heartbeat_gaps(load):
    found = trends.gaps(load("events"), "ts", longer_than_seconds=1800, by=["user_id"])
    return found.withColumn("gap_seconds", F.round("gap_seconds", 3))


# --- changes as they come ---------------------------------------------------------------------
@query(
    "change_feed_audit",
    f"""WITH states AS (SELECT *, CASE WHEN event_type <> 'error' THEN {quarantines.payload_sql(['event_type', 'value'])} END AS n FROM events),
      replayed AS (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY event_id) AS o,
        lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS old_type,
        lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS old_value FROM states)
    SELECT {stamp_sql('ts')} AS event_time, 'system' AS db_user,
      CASE WHEN o IS NULL THEN 'INSERT' WHEN n IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action, 'main' AS schema_name,
      'user_state' AS table_name, user_id::VARCHAR AS row_pk, o AS old_row, n AS new_row,
      CASE WHEN o IS NOT NULL AND n IS NOT NULL THEN concat_ws(',', CASE WHEN event_type IS DISTINCT FROM old_type THEN 'event_type' END,
        CASE WHEN value IS DISTINCT FROM old_value THEN 'value' END) END AS changed_cols
    FROM replayed WHERE (o IS NOT NULL OR n IS NOT NULL)
      AND (o IS NULL OR n IS NULL OR event_type IS DISTINCT FROM old_type OR value IS DISTINCT FROM old_value)""",
)
def change_feed_audit(load):
    """Each user's last event as a row: an error deletes it, any other event writes it."""
    return change_feed.feed_audit(
        load("events"), "user_id", "event_id", deletes=F.col("event_type") == "error", columns=["event_type", "value"],
        table="user_state", event_time="ts",
    )
