"""Bindings for quarantine and remediation over events, customers, documents and sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions.hashing import draw
from tablewarden.operators import payload_index
from tablewarden.operators import quarantine as q
from tablewarden.operators import rules as r
from tablewarden.operators.rules import Rule
from tablewarden.plans import inputs
from tablewarden.plans.registry import Loader, draw_sql, query, stamp_sql
from tablewarden.plans.rules import ANY_ORDER, ORDER_RULES, row_rule
from tablewarden.session import new_path
from tablewarden.sources import writers

RUN, AS_OF = "run-1", "2024-01-31 00:00:00"


def event_rule(rule_id, severity, name, violation) -> Rule:
    return row_rule(rule_id, "events", "value", "accuracy", severity, 95, violation, name)


EVENT_RULES = [
    (event_rule("EVQ1", "HIGH", "value too large", r.outside_range("value", 0, 100)),
     "value IS NULL OR value < 0 OR value > 100"),
    (event_rule("EVQ2", "CRITICAL", "costly error", "event_type = 'error' AND value > 60"),
     "event_type = 'error' AND value > 60"),
    (event_rule("EVQ3", "MEDIUM", "unknown type", r.not_in_set("event_type", ["click", "error", "view", "login"])),
     "event_type NOT IN ('click', 'error', 'view', 'login')"),
    (event_rule("EVQ4", "LOW", "payload out of range", "get_json_object(props, '$.k') > 95"),
     "(props->>'$.k')::INT > 95"),
]
PAYLOAD = ["event_id", "user_id", "event_type", "value", "props"]
STATUS_SHARES = ["OPEN"] * 5 + ["IN_REVIEW"] * 2 + ["FIXED", "IGNORED", "REJECTED"]


def payload_sql(columns: list[str]) -> str:
    return "to_json({" + ", ".join(f"'{c}': {c}" for c in columns) + "})::VARCHAR"


CAUGHT = " UNION ALL ".join(
    f"SELECT '{x.rule_id}' AS rule_id, '{x.name}' AS rule_name, '{x.severity}' AS severity, * FROM events WHERE {p}"
    for x, p in EVENT_RULES
)
STATUS_CASE = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATUS_SHARES))
BAD = f"""captured AS (
  SELECT md5('{RUN}|' || rule_id || '|' || event_id) AS quarantine_id, rule_id, 'main' AS schema_name,
    'events' AS table_name, event_id::VARCHAR AS business_key, {payload_sql(PAYLOAD)} AS payload,
    rule_id || ' — ' || rule_name AS failure_reason, severity, ts AS quarantined_at, event_type AS data_domain
  FROM ({CAUGHT})), bad AS (
  SELECT *, CASE {draw_sql('quarantine_id', 'status')} % 10 {STATUS_CASE} END AS status,
    CASE WHEN {draw_sql('quarantine_id', 'owner')} % 4 = 0 THEN 'dana' END AS assigned_to,
    NULL::TIMESTAMP AS resolved_at, NULL::VARCHAR AS resolution_note FROM captured)"""


def captured(load: Loader):
    rules = [x for x, _ in EVENT_RULES]
    return q.quarantine(
        load("events"), rules, key=["event_id"], run_id=RUN, as_of=F.col("ts"), payload=PAYLOAD, unique_key=True
    ).withColumn("data_domain", F.get_json_object("payload", "$.event_type"))


def bad_events(load: Loader):
    """Captured events in several states of work."""
    state = F.element_at(
        F.array(*[F.lit(s) for s in STATUS_SHARES]), (draw(F.col("quarantine_id"), "status") % 10 + 1).cast("int")
    )
    owner = F.when(draw(F.col("quarantine_id"), "owner") % 4 == 0, F.lit("dana"))
    return captured(load).withColumns({"status": state, "assigned_to": owner})


# --- capture -------------------------------------------------------------------------------
CAPTURED = "quarantine_id, rule_id, table_name, business_key, payload, failure_reason, severity"


@query(
    "quarantine_multi",
    f"WITH {BAD} SELECT {CAPTURED}, {stamp_sql('quarantined_at')} AS quarantined_at, data_domain FROM captured",
)
def quarantine_multi(load):
    return captured(load).select(*CAPTURED.split(", "), "quarantined_at", "data_domain")


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
BALANCE = row_rule("CUS01", "customer", "c_acctbal", "accuracy", "HIGH", 90, r.not_positive("c_acctbal"), "balance positive")


@query(
    "quarantine_rows",
    f"""SELECT md5('{RUN}|CUS01|' || c_custkey) AS quarantine_id, c_custkey::VARCHAR AS business_key,
      {payload_sql(CUSTOMER_COLUMNS)} AS payload, 'CUS01 — balance positive' AS failure_reason,
      'HIGH' AS severity, 'OPEN' AS status FROM customer WHERE c_acctbal <= 0""",
)
def quarantine_rows(load):
    rows = q.quarantine(load("customer"), [BALANCE], key=["c_custkey"], run_id=RUN, as_of=AS_OF, unique_key=True)
    return rows.select("quarantine_id", "business_key", "payload", "failure_reason", "severity", "status")


DUPLICATES = Rule("CUS09", "customers unique", "dirty_customers", "uniqueness", "CRITICAL", "customer_id", key=("customer_id",))
STRAYS = Rule("SAL01", "sales have a customer", "dirty_sales", "integrity", "CRITICAL", "customer_id",
              parent=("clean_customers", "customer_id"))


@query(
    "quarantine_duplicates",
    f"""WITH {inputs.DIRTY_CUSTOMERS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY name, segment, email NULLS FIRST, phone NULLS FIRST, country, signup_date) AS nth FROM dirty_customers)
    , surplus AS (SELECT customer_id, {payload_sql(['customer_id', 'name', 'email'])} AS payload FROM ranked WHERE nth > 1),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY sha256(payload)) AS n FROM surplus)
    SELECT md5('{RUN}|{DUPLICATES.rule_id}|' || customer_id || CASE WHEN n > 1 THEN '|row|' || n ELSE '' END) AS quarantine_id,
      customer_id AS business_key, payload, 'CUS09 — customers unique' AS failure_reason FROM numbered""",
)
def quarantine_duplicates(load):
    tables = {"dirty_customers": inputs.dirty_customers(load)}
    rows = q.quarantine_selected(
        tables, DUPLICATES, key=["customer_id"], run_id=RUN, as_of=AS_OF, payload=["customer_id", "name", "email"]
    )
    return rows.select("quarantine_id", "business_key", "payload", "failure_reason")


@query(
    "quarantine_orphans",
    f"""WITH {inputs.CLEAN_CUSTOMERS}, {inputs.DIRTY_SALES}
    , strays AS (SELECT order_id, {payload_sql(['order_id', 'customer_id'])} AS payload FROM dirty_sales s
      WHERE NOT EXISTS (SELECT 1 FROM clean_customers c WHERE c.customer_id = s.customer_id)),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY sha256(payload)) AS n FROM strays)
    SELECT md5('{RUN}|SAL01|' || order_id || CASE WHEN n > 1 THEN '|row|' || n ELSE '' END) AS quarantine_id,
      order_id AS business_key, payload FROM numbered""",
)
def quarantine_orphans(load):
    tables = {"dirty_sales": inputs.dirty_sales(load), "clean_customers": inputs.staged_customers(load)}
    rows = q.quarantine_selected(
        tables, STRAYS, key=["order_id"], run_id=RUN, as_of=AS_OF, payload=["order_id", "customer_id"]
    )
    return rows.select("quarantine_id", "business_key", "payload")


ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


@query("split_clean", f"SELECT {ORDER_COLUMNS} FROM orders WHERE NOT ({ANY_ORDER})")
def split_clean(load):
    return q.split(load("orders"), [x for x, _ in ORDER_RULES])[0].select(*ORDER_COLUMNS.split(", "))


@query("split_bad", f"SELECT {ORDER_COLUMNS} FROM orders WHERE {ANY_ORDER}")
def split_bad(load):
    return q.split(load("orders"), [x for x, _ in ORDER_RULES])[1].select(*ORDER_COLUMNS.split(", "))


# --- remediation -----------------------------------------------------------------------------
ACTION_NAMES = list(q.ACTIONS)
ROUNDS = [("first", 0.6, "1 hour"), ("second", 0.3, "2 hours")]


def actions(load: Loader):
    """Two rounds of steward actions on a share of the rows each."""
    rows = bad_events(load)
    key = F.col("quarantine_id")
    parts = []
    for label, share, delay in ROUNDS:
        action = F.element_at(
            F.array(*[F.lit(a) for a in ACTION_NAMES]), (draw(key, f"{label}/action") % 5 + 1).cast("int")
        )
        chosen = rows.where(draw(key, label) < int(share * 2**32)).withColumn("action", action)
        parts.append(
            chosen.select(
                "quarantine_id",
                "action",
                F.when(F.col("action") == "assign", F.concat(F.lit("steward_"), draw(key, f"{label}/who") % 3)).alias(
                    "assignee"
                ),
                F.lit(label).alias("note"),
                (F.col("quarantined_at") + F.expr(f"interval {delay}")).alias("acted_at"),
            )
        )
    return parts[0].unionByName(parts[1])


ACTION_CASE = " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(ACTION_NAMES))
NEW_STATUS = " ".join(f"WHEN '{a}' THEN '{s}'" for a, s in q.ACTIONS.items())
ACTIONS = "actions AS (" + " UNION ALL ".join(
    f"""SELECT quarantine_id, action, CASE WHEN action = 'assign'
      THEN 'steward_' || ({draw_sql('quarantine_id', label + '/who')} % 3) END AS assignee, '{label}' AS note,
      quarantined_at + INTERVAL '{delay}' AS acted_at FROM
      (SELECT *, CASE {draw_sql('quarantine_id', label + '/action')} % 5 {ACTION_CASE} END AS action FROM bad
       WHERE {draw_sql('quarantine_id', label)} < {int(share * 2**32)})"""
    for label, share, delay in ROUNDS
) + ")"
ACTED = f"""{BAD}, {ACTIONS}, moves AS (SELECT *, CASE action {NEW_STATUS} END AS new_status FROM actions), last AS (
  SELECT quarantine_id, arg_max(new_status, acted_at) AS new_status, arg_max(note, acted_at) AS note,
    max(acted_at) AS acted_at, arg_max(assignee, acted_at) FILTER (WHERE assignee IS NOT NULL) AS assignee,
    max(acted_at) FILTER (WHERE new_status <> 'IN_REVIEW') AS closed_at
  FROM moves GROUP BY quarantine_id), acted AS (
  SELECT b.quarantine_id, b.status AS old_status, coalesce(l.new_status, b.status) AS status,
    coalesce(l.assignee, b.assigned_to) AS assigned_to, coalesce(l.note, b.resolution_note) AS resolution_note,
    coalesce(l.closed_at, b.resolved_at) AS resolved_at, l.acted_at, l.note
  FROM bad b LEFT JOIN last l USING (quarantine_id))"""


@query(
    "apply_actions",
    f"""WITH {ACTED} SELECT quarantine_id, status, assigned_to, resolution_note,
      {stamp_sql('resolved_at')} AS resolved_at FROM acted""",
)
def apply_actions(load):
    rows, _ = q.apply_actions(bad_events(load), actions(load))
    return rows.select("quarantine_id", "status", "assigned_to", "resolution_note", "resolved_at")


@query(
    "remediation_log",
    f"""WITH {ACTED} SELECT quarantine_id, 'STATUS_CHANGE' AS action, coalesce(assigned_to, 'system') AS actor, note,
      old_status, status AS new_status, {stamp_sql('acted_at')} AS acted_at
    FROM acted WHERE acted_at IS NOT NULL AND status <> old_status""",
)
def remediation_log(load):
    return q.apply_actions(bad_events(load), actions(load))[1]


@query(
    "bulk_resolve",
    f"""WITH {BAD}, marked AS (SELECT *, rule_id = 'EVQ3' AND status = 'OPEN'
        AND quarantined_at < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AS hit FROM bad)
    SELECT quarantine_id, CASE WHEN hit THEN 'IGNORED' ELSE status END AS status,
      CASE WHEN hit THEN 'BULK: known false positive' END AS resolution_note,
      CASE WHEN hit THEN '{AS_OF}' END AS resolved_at FROM marked""",
)
def bulk_resolve(load):
    rows = q.bulk_resolve(bad_events(load), rule_id="EVQ3", as_of=AS_OF, note="known false positive")
    return rows.select("quarantine_id", "status", "resolution_note", "resolved_at")


STEWARDS = f"""stewards AS (SELECT DISTINCT event_type AS data_domain, 'steward_' || event_type AS db_user FROM events
  WHERE event_type <> 'error')"""


def stewards(load: Loader):
    """One steward per event type, none for errors."""
    kinds = load("events").where("event_type <> 'error'").select("event_type").distinct()
    return kinds.select(
        F.col("event_type").alias("data_domain"), F.concat(F.lit("steward_"), F.col("event_type")).alias("db_user")
    )


@query(
    "assign_stewards",
    f"""WITH {BAD}, {STEWARDS} SELECT quarantine_id, data_domain, coalesce(assigned_to, db_user) AS assigned_to
    FROM bad LEFT JOIN stewards USING (data_domain)""",
)
def assign_stewards(load):
    rows = q.assign_stewards(bad_events(load), stewards(load))
    return rows.select("quarantine_id", "data_domain", "assigned_to")


# --- backlog -----------------------------------------------------------------------------------
OPEN = "status IN ('OPEN', 'IN_REVIEW')"
NOW = f"TIMESTAMP '{AS_OF}'"


@query(
    "open_by_table",
    f"""WITH {BAD} SELECT schema_name, table_name, severity, count(*) AS open_count,
      {stamp_sql('min(quarantined_at)')} AS oldest_open, {stamp_sql('max(quarantined_at)')} AS newest_open
    FROM bad WHERE {OPEN} GROUP BY 1, 2, 3""",
)
def open_by_table(load):
    return q.open_by_table(bad_events(load))


LATE = f"""{OPEN} AND quarantined_at < {NOW} - CASE severity WHEN 'CRITICAL' THEN INTERVAL 4 HOUR
  WHEN 'HIGH' THEN INTERVAL 1 DAY WHEN 'MEDIUM' THEN INTERVAL 3 DAY ELSE INTERVAL 7 DAY END"""


@query(
    "sla_breaches",
    f"""WITH {BAD} SELECT quarantine_id, table_name, severity, business_key, failure_reason,
      (epoch_us({NOW}) - epoch_us(quarantined_at)) // 1000000 AS open_seconds FROM bad WHERE {LATE}""",
)
def sla_breaches(load):
    rows = q.sla_breaches(bad_events(load), as_of=AS_OF)
    return rows.select(
        "quarantine_id", "table_name", "severity", "business_key", "failure_reason",
        F.floor("open_seconds").alias("open_seconds"),
    )


@query(
    "quarantine_backlog",
    f"""WITH {BAD} SELECT table_name AS source_table, severity, status, count(*) AS open_rows,
      count(*) FILTER (WHERE {NOW} - quarantined_at < INTERVAL 1 DAY) AS lt_1d,
      count(*) FILTER (WHERE {NOW} - quarantined_at BETWEEN INTERVAL 1 DAY AND INTERVAL 7 DAY) AS d1_7,
      count(*) FILTER (WHERE {NOW} - quarantined_at > INTERVAL 7 DAY) AS gt_7d
    FROM bad WHERE {OPEN} GROUP BY 1, 2, 3""",
)
def quarantine_backlog(load):
    return q.backlog(bad_events(load), as_of=AS_OF)


@query(
    "quarantine_list",
    f"""WITH {BAD} SELECT quarantine_id, schema_name, table_name, rule_id, severity, status, business_key,
      left(failure_reason, 60) AS reason, {stamp_sql('quarantined_at')} AS quarantined_at
    FROM bad WHERE status = 'OPEN' AND severity = 'HIGH' ORDER BY bad.quarantined_at DESC, quarantine_id LIMIT 50""",
)
def quarantine_list(load):
    return q.listing(bad_events(load), status="OPEN", severity="HIGH")


@query(
    "triage_list",
    f"""WITH {BAD} SELECT quarantine_id, data_domain, severity,
      CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END::BIGINT AS severity_rank,
      {stamp_sql('quarantined_at')} AS quarantined_at FROM bad WHERE status = 'OPEN'""",
)
def triage_list(load):
    return q.triage(bad_events(load)).select(
        "quarantine_id", "data_domain", "severity", "severity_rank", "quarantined_at"
    )


@query(
    "backlog_age",
    f"""WITH {BAD} SELECT data_domain, severity, count(*) AS row_count,
      round(avg((epoch_us({NOW}) - epoch_us(quarantined_at)) / 3600000000), 4) AS avg_age_hours
    FROM bad WHERE status = 'OPEN' GROUP BY 1, 2""",
)
def backlog_age(load):
    return q.backlog_age(bad_events(load), as_of=AS_OF).withColumn("avg_age_hours", F.round("avg_age_hours", 4))


@query(
    "top_failing_rules_week",
    f"""WITH {BAD} SELECT rule_id, table_name, count(*) AS bad_rows FROM bad
    WHERE quarantined_at > {NOW} - INTERVAL 7 DAY GROUP BY 1, 2""",
)
def top_failing_rules_week(load):
    return q.failing_rules_since(bad_events(load), as_of=AS_OF)


@query("quarantine_status", f"WITH {BAD} SELECT status, count(*) AS row_count FROM bad GROUP BY status")
def quarantine_status(load):
    return q.status_counts(bad_events(load))


@query(
    "payload_search",
    f"""WITH {BAD} SELECT quarantine_id, rule_id, payload FROM bad WHERE payload->>'$.event_type' = 'error'""",
)
def payload_search(load):
    return q.search_payload(bad_events(load), "event_type", "error").select("quarantine_id", "rule_id", "payload")


@query(
    "payload_index_search",
    f"""WITH {BAD} SELECT quarantine_id, rule_id, payload FROM bad WHERE payload->>'$.event_type' = 'error'""",
)
def payload_index_search(load):
    """The same search through an index that was written in two batches."""
    bad, folder = writers.stored(bad_events(load), "bad"), new_path(load.spark, "payload-index")
    late = F.col("quarantined_at") >= F.lit(AS_OF).cast("timestamp_ntz")
    payload_index.add_batch(bad.where(~late), folder, "first")
    payload_index.add_batch(bad.where(late), folder, "second")
    return payload_index.search(bad, folder, "event_type", "error").select("quarantine_id", "rule_id", "payload")
