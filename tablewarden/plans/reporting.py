"""Bindings for reports: one run per order day gives a history of evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions.hashing import draw
from tablewarden.operators import evaluate as ev
from tablewarden.operators import quarantine as qr
from tablewarden.operators import reconcile as rc
from tablewarden.operators import reports as rp
from tablewarden.operators import rules as r
from tablewarden.operators import scoring, trends
from tablewarden.operators.rules import Rule
from tablewarden.plans import inputs
from tablewarden.plans.recon import diff_pct_sql, status_sql
from tablewarden.plans.registry import Loader, day_sql, draw_sql, grade_sql, query, rate_sql, stamp_sql
from tablewarden.plans.rules import MEAN_RATE, WEIGHT_ROWS

AS_OF = "2001-08-01 06:30:00"
NOW = f"TIMESTAMP '{AS_OF}'"


def day_rule(rule_id, column, dimension, severity, minimum, domain, violation) -> Rule:
    return Rule(
        rule_id=rule_id, name=f"{column} {dimension}", table="orders", column=column, dimension=dimension,
        severity=severity, min_pass_pct=minimum, domain=domain, violation=violation,
    )


DAY_RULES = [
    (day_rule("DAY1", "o_orderpriority", "validity", "HIGH", 80, "SALES",
              r.not_in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])),
     "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"),
    (day_rule("DAY2", "o_orderdate", "timeliness", "HIGH", 99, "SALES", r.after("o_orderdate", "2001-06-30 00:00:00")),
     "o_orderdate > TIMESTAMP '2001-06-30'"),
    (day_rule("DAY3", "o_totalprice", "accuracy", "MEDIUM", 90, "FINANCE", r.outside_range("o_totalprice", 1000, 450000)),
     "o_totalprice IS NULL OR o_totalprice < 1000 OR o_totalprice > 450000"),
    (day_rule("DAY4", "o_orderstatus", "completeness", "CRITICAL", 100, "SALES", r.is_blank("o_orderstatus")),
     "o_orderstatus IS NULL OR o_orderstatus = ''"),
    (day_rule("DAY5", "o_orderstatus", "consistency", "CRITICAL", 85, "FINANCE",
              "o_orderstatus = 'F' AND o_orderpriority = '5-LOW'"),
     "o_orderstatus = 'F' AND o_orderpriority = '5-LOW'"),
]


# --- evidence in Spark ---------------------------------------------------------------------
def results(load: Loader):
    """Rule results per order day; the day is the run."""
    day = F.to_date("o_orderdate").alias("day")
    rules = [x for x, _ in DAY_RULES]
    found = ev.evaluate(load("orders"), rules, run_id="daily", as_of=AS_OF, slice_by=[day])
    at_six = F.col("day").cast("timestamp_ntz") + F.expr("interval 6 hours")
    return found.withColumns({"execution_id": run_number(), "executed_at": at_six}).drop("run_id")


def run_number():
    return F.date_format("day", "yyyyMMdd").cast("bigint")


def runs(load: Loader):
    """Run headers: started at five, 90 seconds per order, status from the results."""
    status = scoring.run_status(results(load), "execution_id").select("execution_id", "status")
    days = load("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    started = F.col("day").cast("timestamp_ntz") + F.expr("interval 5 hours")
    return days.select(
        run_number().alias("execution_id"),
        F.lit("daily").alias("pipeline_name"),
        F.lit("scheduler").alias("triggered_by"),
        started.alias("started_at"),
        (started + F.make_dt_interval(secs=F.col("n") * 90)).alias("ended_at"),
    ).join(status, "execution_id")


def recon(load: Loader):
    """Row counts and totals of source and target per order day."""

    def side(df, mark):
        return df.groupBy(F.to_date("order_date").alias("day")).agg(
            F.count("*").alias(f"n_{mark}"), F.sum("total_amount").alias(f"s_{mark}")
        )

    both = side(inputs.recon_source(load), "s").join(side(inputs.recon_target(load), "t"), "day", "full_outer")
    number = rc.NUMBER
    rows = F.array(
        F.struct(
            F.lit("orders_rows").alias("job_name"),
            F.lit("row_count").alias("check_type"),
            F.col("n_s").cast(number).alias("source_value"),
            F.col("n_t").cast(number).alias("target_value"),
            F.lit(1).cast("decimal(7,4)").alias("tolerance_pct"),
        ),
        F.struct(
            F.lit("orders_total").alias("job_name"),
            F.lit("sum_check").alias("check_type"),
            F.col("s_s").cast(number).alias("source_value"),
            F.col("s_t").cast(number).alias("target_value"),
            F.lit(0.01).cast("decimal(7,4)").alias("tolerance_pct"),
        ),
    )
    checked = rc.compared(both.select("day", F.inline(rows)))
    at_six = F.col("day").cast("timestamp_ntz") + F.expr("interval 6 hours")
    return checked.withColumns({"execution_id": run_number(), "executed_at": at_six})


def bad(load: Loader):
    """Bad orders of every day; captured some time that day, half of them still open."""
    orders = load("orders")
    seconds = draw(F.col("o_orderkey").cast("string"), "captured") % 86400
    rows = qr.quarantine(
        orders,
        [x for x, _ in DAY_RULES],
        key=["o_orderkey"],
        run_id="daily",
        as_of=F.col("o_orderdate") + F.make_dt_interval(secs=seconds),
        payload=["o_orderkey"],
    )
    is_open = draw(F.col("quarantine_id"), "open") % 2 == 0
    return rows.withColumns(
        {
            "execution_id": F.date_format("quarantined_at", "yyyyMMdd").cast("bigint"),
            "status": F.when(is_open, "OPEN").otherwise("FIXED"),
        }
    )


def scores(load: Loader):
    by = ["execution_id", "executed_at", "schema_name", "table_name"]
    return scoring.quality_scores(results(load), by=by).withColumnRenamed("executed_at", "scored_at")


# --- the same evidence as SQL --------------------------------------------------------------
DAYS = f"""days AS (SELECT o_orderdate::DATE AS day, count(*) AS total,
    {', '.join(f"count(*) FILTER (WHERE {p}) AS {x.rule_id}" for x, p in DAY_RULES)} FROM orders GROUP BY 1)"""
RESULTS = f"""{DAYS}, counts AS ({' UNION ALL '.join(
    f"SELECT day, '{x.rule_id}' AS rule_id, '{x.name}' AS rule_name, 'main' AS schema_name, 'orders' AS table_name, "
    f"'{x.column}' AS column_name, '{x.dimension}' AS dimension, '{x.severity}' AS severity, "
    f"'{x.domain}' AS data_domain, {x.min_pass_pct}::DOUBLE AS min_pass_pct, total AS total_rows, "
    f"{x.rule_id} AS violation_count FROM days" for x, _ in DAY_RULES)}),
  rated AS (SELECT *, {rate_sql('total_rows', 'violation_count')} AS pass_rate_pct FROM counts),
  results AS (SELECT *, strftime(day, '%Y%m%d')::BIGINT AS execution_id, day + INTERVAL 6 HOUR AS executed_at,
    {grade_sql('total_rows', 'violation_count', 'min_pass_pct')} AS status FROM rated)"""
RUNS = f"""{RESULTS}, runs AS (
  SELECT strftime(day, '%Y%m%d')::BIGINT AS execution_id, 'daily' AS pipeline_name, 'scheduler' AS triggered_by,
    day + INTERVAL 5 HOUR AS started_at, day + INTERVAL 5 HOUR + to_seconds(total * 90) AS ended_at,
    (SELECT CASE WHEN bool_or(r.status = 'FAIL') THEN 'COMPLETED_WITH_FAILURES' ELSE 'SUCCESS' END
     FROM results r WHERE r.day = days.day) AS status FROM days)"""
RECON = f"""{inputs.RECON}, sides AS (
  SELECT coalesce(s.day, t.day) AS day, ns, ss, nt, st FROM
    (SELECT order_date::DATE AS day, count(*) AS ns, sum(total_amount) AS ss FROM source GROUP BY 1) s FULL JOIN
    (SELECT order_date::DATE AS day, count(*) AS nt, sum(total_amount) AS st FROM target GROUP BY 1) t ON s.day = t.day),
  pairs AS (
  SELECT day, 'orders_rows' AS job_name, 'row_count' AS check_type, ns::DOUBLE AS source_value, nt::DOUBLE AS target_value,
    1::DOUBLE AS tolerance_pct FROM sides UNION ALL
  SELECT day, 'orders_total', 'sum_check', ss::DOUBLE, st::DOUBLE, 0.01::DOUBLE FROM sides),
  recon AS (SELECT *, strftime(day, '%Y%m%d')::BIGINT AS execution_id, day + INTERVAL 6 HOUR AS executed_at,
    target_value - source_value AS diff, {diff_pct_sql('source_value', 'target_value')} AS diff_pct,
    {status_sql('source_value', 'target_value', 'tolerance_pct')} AS status FROM pairs)"""
BAD = f"""bad AS (SELECT *, strftime(quarantined_at, '%Y%m%d')::BIGINT AS execution_id,
    CASE WHEN {draw_sql('quarantine_id', 'open')} % 2 = 0 THEN 'OPEN' ELSE 'FIXED' END AS status FROM (
  SELECT md5('daily|' || rule_id || '|' || o_orderkey) AS quarantine_id, rule_id, severity, 'orders' AS table_name,
    o_orderdate + to_seconds({draw_sql('o_orderkey', 'captured')} % 86400) AS quarantined_at FROM (
  {' UNION ALL '.join(f"SELECT '{x.rule_id}' AS rule_id, '{x.severity}' AS severity, * FROM orders WHERE {p}"
                      for x, p in DAY_RULES)})))"""
LATE = f"""status = 'OPEN' AND quarantined_at < {NOW} - CASE severity WHEN 'CRITICAL' THEN INTERVAL 4 HOUR
  WHEN 'HIGH' THEN INTERVAL 1 DAY WHEN 'MEDIUM' THEN INTERVAL 3 DAY ELSE INTERVAL 7 DAY END"""
PASS = "count(*) FILTER (WHERE status = 'PASS')"


# --- scorecards ------------------------------------------------------------------------------
@query(
    "executive_scorecard",
    f"""WITH {RUNS}, {RECON}, {BAD},
      a AS (SELECT execution_id, count(*) AS rules_total, {PASS} AS rules_pass,
        count(*) FILTER (WHERE status = 'WARN') AS rules_warn, count(*) FILTER (WHERE status = 'FAIL') AS rules_fail
        FROM results GROUP BY 1),
      b AS (SELECT execution_id, count(*) AS etl_checks_total, {PASS} AS etl_checks_pass,
        count(*) FILTER (WHERE status IN ('FAIL', 'ERROR')) AS etl_checks_fail FROM recon GROUP BY 1),
      c AS (SELECT execution_id, count(*) AS rows_quarantined FROM bad GROUP BY 1)
    SELECT execution_id, pipeline_name, triggered_by, {stamp_sql('started_at')} AS started_at,
      {stamp_sql('ended_at')} AS ended_at, epoch(ended_at - started_at)::BIGINT AS duration_seconds,
      status AS execution_status, coalesce(rules_total, 0) AS rules_total, coalesce(rules_pass, 0) AS rules_pass,
      coalesce(rules_warn, 0) AS rules_warn, coalesce(rules_fail, 0) AS rules_fail,
      coalesce(etl_checks_total, 0) AS etl_checks_total, coalesce(etl_checks_pass, 0) AS etl_checks_pass,
      coalesce(etl_checks_fail, 0) AS etl_checks_fail, coalesce(rows_quarantined, 0) AS rows_quarantined,
      round(100.0::DOUBLE * rules_pass / rules_total, 2) AS rule_pass_pct
    FROM runs LEFT JOIN a USING (execution_id) LEFT JOIN b USING (execution_id) LEFT JOIN c USING (execution_id)""",
)
def executive_scorecard(load):
    return rp.executive_scorecard(runs(load), results(load), recon(load), bad(load))


DETAIL = f"""{RUNS}, detail AS (SELECT r.execution_id, started_at::DATE AS run_date, pipeline_name, rule_id, rule_name,
    dimension, 'main.orders' AS target_table, column_name AS target_column, severity, r.status,
    violation_count AS failed_rows, total_rows, round(100.0::DOUBLE * violation_count / total_rows, 4) AS failure_rate_pct,
    executed_at FROM results r JOIN runs USING (execution_id))"""


@query(
    "rule_results_detail",
    f"""WITH {DETAIL} SELECT * REPLACE ({day_sql('run_date')} AS run_date, {stamp_sql('executed_at')} AS executed_at)
    FROM detail""",
)
def rule_results_detail(load):
    return rp.rule_results_detail(results(load), runs(load))


@query(
    "dimension_trend",
    f"""WITH {DETAIL} SELECT {day_sql('run_date')} AS run_date, dimension, count(*) AS checks_total,
      {PASS} AS checks_pass, round(100.0::DOUBLE * {PASS} / count(*), 2) AS pass_pct
    FROM detail GROUP BY detail.run_date, dimension""",
)
def dimension_trend(load):
    return rp.dimension_trend(results(load), runs(load))


@query(
    "table_health",
    f"""WITH {RESULTS} SELECT schema_name || '.' || table_name AS target_table, count(*) AS checks_total,
      count(*) FILTER (WHERE status = 'FAIL') AS checks_fail, count(*) FILTER (WHERE status = 'WARN') AS checks_warn,
      {stamp_sql('max(executed_at)')} AS last_checked_at, round(100.0::DOUBLE * {PASS} / count(*), 2) AS health_score_pct
    FROM results WHERE executed_at > {NOW} - INTERVAL 30 DAY AND executed_at <= {NOW} GROUP BY 1""",
)
def table_health(load):
    return rp.table_health(results(load), as_of=AS_OF)


@query(
    "table_health_daily",
    f"""WITH {RESULTS} SELECT {day_sql('day')} AS day, schema_name || '.' || table_name AS table_full_name,
      {PASS} / count(*) AS pass_rate FROM results GROUP BY results.day, 2""",
)
def table_health_daily(load):
    return rp.table_health_daily(results(load))


SCORES = f"""{RESULTS}, dims AS (SELECT execution_id, executed_at, dimension, {MEAN_RATE} AS dim_score,
    count(*) AS rules_run, sum(violation_count)::BIGINT AS violations FROM results GROUP BY 1, 2, 3),
  weights(dimension, weight) AS (VALUES {WEIGHT_ROWS}),
  scores AS (SELECT execution_id, executed_at AS scored_at, 'orders' AS table_name,
    round(sum(dim_score * weight) / sum(weight), 4) AS overall_score, sum(violations)::BIGINT AS total_violations
    FROM dims JOIN weights USING (dimension) GROUP BY 1, 2)"""


@query(
    "latest_scores",
    f"""WITH {SCORES} SELECT table_name, execution_id, {stamp_sql('scored_at')} AS scored_at, overall_score,
      total_violations FROM scores ORDER BY scores.scored_at DESC LIMIT 1""",
)
def latest_scores(load):
    found = rp.latest_scores(scores(load))
    return found.select("table_name", "execution_id", "scored_at", "overall_score", "total_violations")


@query(
    "latest_recon",
    f"""WITH {RECON} SELECT DISTINCT ON (job_name) job_name, check_type, execution_id, source_value, target_value, status
    FROM recon ORDER BY job_name, executed_at DESC""",
)
def latest_recon(load):
    found = rc.latest_results(recon(load))
    return found.select("job_name", "check_type", "execution_id", "source_value", "target_value", "status")


@query(
    "top_failing_rules",
    f"""WITH {DETAIL} SELECT rule_name, severity, target_table, failed_rows, {stamp_sql('executed_at')} AS executed_at
    FROM detail WHERE status = 'FAIL' AND executed_at > {NOW} - INTERVAL 30 DAY AND executed_at <= {NOW}
    ORDER BY failed_rows DESC, rule_id, detail.executed_at DESC LIMIT 25""",
)
def top_failing_rules(load):
    return rp.top_failing_rules(rp.rule_results_detail(results(load), runs(load)), as_of=AS_OF, window="30 days")


@query(
    "failure_scope",
    f"""WITH {RESULTS}, recent AS (SELECT * FROM results WHERE severity = 'CRITICAL' AND status = 'FAIL'
        AND executed_at > {NOW} - INTERVAL 7 DAY AND executed_at <= {NOW})
    SELECT count(DISTINCT rule_id) AS failing_rules, count(DISTINCT table_name) AS failing_tables,
      coalesce(sum(violation_count), 0)::BIGINT AS failed_rows,
      CASE WHEN count(DISTINCT rule_id) = 0 THEN 'NONE' WHEN count(DISTINCT rule_id) = 1 THEN 'SINGLE_RULE'
           WHEN count(DISTINCT table_name) = 1 THEN 'SINGLE_TABLE' ELSE 'MANY_TABLES' END AS scope FROM recent""",
)
def failure_scope(load):
    return rp.failure_scope(results(load), as_of=AS_OF, window="7 days")


@query(
    "kpi_gate",
    f"""WITH {RUNS}, k AS (SELECT (SELECT {PASS} / count(*) FROM results) AS overall_pass_rate,
        (SELECT count(*) FROM results WHERE status = 'FAIL' AND severity = 'CRITICAL') AS critical_failures,
        (SELECT avg(epoch(ended_at - started_at)) FROM runs) AS avg_pipeline_seconds)
    SELECT overall_pass_rate, critical_failures, avg_pipeline_seconds,
      concat_ws(',', CASE WHEN overall_pass_rate < 0.85 THEN 'pass_rate' END,
        CASE WHEN critical_failures > 0 THEN 'critical_failures' END,
        CASE WHEN avg_pipeline_seconds > 300 THEN 'avg_pipeline_seconds' END) AS breaches,
      overall_pass_rate >= 0.85 AND critical_failures <= 0 AND avg_pipeline_seconds <= 300 AS gate_ok FROM k""",
)
def kpi_gate(load):
    return rp.kpi_gate(runs(load), results(load))


# --- alerts and metrics ------------------------------------------------------------------------
RECENT = f"executed_at > {NOW} - INTERVAL 24 HOUR AND executed_at <= {NOW}"
ALERTS = f"""{RESULTS}, {RECON}, {BAD}, alerts AS (
  SELECT 'RULE_FAIL' AS alert_type, severity, rule_name AS subject, 'main.orders' AS object,
    violation_count AS magnitude, executed_at AS triggered_at FROM results
  WHERE status = 'FAIL' AND severity IN ('HIGH', 'CRITICAL') AND {RECENT} UNION ALL
  SELECT 'ETL_RECON_FAIL', 'HIGH', job_name, NULL,
    round(abs(coalesce(source_value, 0) - coalesce(target_value, 0)))::BIGINT, executed_at FROM recon
  WHERE status IN ('FAIL', 'ERROR') AND {RECENT} UNION ALL
  SELECT 'SLA_BREACH', severity, 'Quarantine row #' || quarantine_id, table_name, 1, quarantined_at FROM bad WHERE {LATE})"""


def alerts(load: Loader):
    return rp.active_alerts(results(load), recon(load), bad(load), as_of=AS_OF)


@query(
    "active_alerts",
    f"""WITH {ALERTS} SELECT * REPLACE ({stamp_sql('triggered_at')} AS triggered_at) FROM alerts""",
)
def active_alerts(load):
    return alerts(load)


@query(
    "alert_routing",
    f"""WITH {ALERTS}, routes(channel, severity) AS (VALUES
      {', '.join(f"('{c}', '{s}')" for s, names in rp.ROUTING.items() for c in names)}),
      routed AS (SELECT *, alert_type || '::' || subject AS dedup_key FROM alerts JOIN routes USING (severity)),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY triggered_at DESC, dedup_key,
          magnitude DESC, object NULLS FIRST) AS nth,
        row_number() OVER (PARTITION BY channel, dedup_key ORDER BY triggered_at DESC, magnitude DESC,
          object NULLS FIRST) AS nth_of_key, count(*) OVER (PARTITION BY channel) AS in_channel,
        count(*) OVER (PARTITION BY channel, dedup_key) AS of_key FROM routed)
    SELECT channel, alert_type, severity, subject, magnitude, {stamp_sql('triggered_at')} AS triggered_at, dedup_key,
      CASE channel WHEN 'email' THEN 0 WHEN 'pagerduty' THEN of_key - 1 ELSE greatest(in_channel - 20, 0) END AS omitted
    FROM ranked WHERE channel = 'email' OR (channel IN ('slack', 'teams') AND nth <= 20)
      OR (channel = 'pagerduty' AND nth_of_key = 1)""",
)
def alert_routing(load):
    return rp.alert_routing(alerts(load)).drop("object")


@query(
    "pipeline_metrics",
    f"""WITH {RESULTS}, {RECON}, {BAD}
    SELECT 'dq.rules.executed' AS metric, status || ',' || severity AS labels, count(*)::DOUBLE AS value
      FROM results GROUP BY 2 UNION ALL
    SELECT 'dq.rule.pass_rate', data_domain, round({PASS} / count(*), 6) FROM results GROUP BY 2 UNION ALL
    SELECT 'dq.recon.gap_rows', job_name, sum(abs(target_value - source_value)) FROM recon
      WHERE check_type = 'row_count' GROUP BY 2 UNION ALL
    SELECT 'dq.sla.breaches', severity, count(*) FROM bad WHERE {LATE} GROUP BY 2""",
)
def pipeline_metrics(load):
    return rp.pipeline_metrics(results(load), recon(load), bad(load), as_of=AS_OF)


# --- trends over the daily scores -----------------------------------------------------------------
def daily(load: Loader):
    return scores(load).select(
        "table_name", F.to_date("scored_at").alias("day"), F.col("overall_score").cast("double").alias("score")
    )


DAILY = f"{SCORES}, daily AS (SELECT table_name, scored_at::DATE AS day, overall_score AS score FROM scores)"


@query(
    "score_drift",
    f"""WITH {DAILY}, t AS (SELECT *, avg(score) OVER (PARTITION BY table_name ORDER BY day
        ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline FROM daily)
    SELECT table_name, {day_sql('day')} AS day, score, round(baseline, 6) AS baseline,
      round(score - baseline, 6) AS change, coalesce(score - baseline < -5, false) AS drifted FROM t""",
)
def score_drift(load):
    found = trends.score_drift(daily(load), by=["table_name"], day="day", score="score")
    return found.withColumns({c: F.round(c, 6) for c in ("baseline", "change")})


@query(
    "score_anomaly",
    f"""WITH {DAILY}, t AS (SELECT *, avg(score) OVER w AS m, stddev_samp(score) OVER w AS s FROM daily
      WINDOW w AS (PARTITION BY table_name ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
    SELECT table_name, {day_sql('day')} AS day, score, round((score - m) / nullif(s, 0), 5) AS z
    FROM t WHERE abs((score - m) / nullif(s, 0)) > 2""",
)
def score_anomaly(load):
    found = trends.score_anomalies(daily(load), by=["table_name"], day="day", score="score")
    return found.select("table_name", "day", "score", F.round("z", 5).alias("z"))


@query(
    "score_forecast",
    f"""WITH {DAILY}, p AS (SELECT *, day - DATE '1995-01-01' AS x FROM daily)
    SELECT table_name, round(regr_slope(score, x), 8) AS slope, round(regr_intercept(score, x), 6) AS intercept,
      count(*) AS points, round(regr_intercept(score, x) + regr_slope(score, x) * (max(x) + 7), 6) AS projected
    FROM p GROUP BY table_name""",
)
def score_forecast(load):
    number = F.date_diff("day", F.lit("1995-01-01").cast("date"))
    found = trends.forecast(daily(load), by=["table_name"], day_number=number, score="score")
    return found.withColumns(
        {"slope": F.round("slope", 8), "intercept": F.round("intercept", 6), "projected": F.round("projected", 6)}
    )
