"""Scorecards, trends, alerts and metrics over the evidence tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.timing import ago, moment, seconds_between
from tablewarden.operators.dedup import latest_per_key, top_per_key
from tablewarden.operators.quarantine import sla_breaches
from tablewarden.schemas import SEVERITIES


def _share(part: Column, whole: Column, digits: int) -> Column:
    ratio = part.cast("decimal(20,0)") * 100 / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(ratio, digits).cast("double")


def _passed(status: str) -> Column:
    return F.count_if(F.col("status") == status)


# --- scorecards -------------------------------------------------------------------
def executive_scorecard(
    runs: DataFrame, results: DataFrame, recon: DataFrame, bad: DataFrame, key: str = "execution_id"
) -> DataFrame:
    """One row per run with its rule, reconciliation and quarantine counts.

    Each evidence table is counted per run before it is joined.
    """
    rules = results.groupBy(key).agg(
        F.count("*").alias("rules_total"),
        _passed("PASS").alias("rules_pass"),
        _passed("WARN").alias("rules_warn"),
        _passed("FAIL").alias("rules_fail"),
    )
    checks = recon.groupBy(key).agg(
        F.count("*").alias("etl_checks_total"),
        _passed("PASS").alias("etl_checks_pass"),
        F.count_if(F.col("status").isin("FAIL", "ERROR")).alias("etl_checks_fail"),
    )
    rows = bad.groupBy(key).agg(F.count("*").alias("rows_quarantined"))
    joined = runs.withColumnRenamed("status", "execution_status")
    for part in (rules, checks, rows):
        joined = joined.join(part, key, "left")
    counts = [c for part in (rules, checks, rows) for c in part.columns if c != key]
    return joined.select(
        key,
        "pipeline_name",
        "triggered_by",
        "started_at",
        "ended_at",
        seconds_between(F.col("started_at"), F.col("ended_at")).cast("int").alias("duration_seconds"),
        "execution_status",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        _share(F.col("rules_pass"), F.col("rules_total"), 2).alias("rule_pass_pct"),
    )


def rule_results_detail(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Results joined to their run, with the failure rate."""
    header = runs.select("execution_id", "pipeline_name", F.to_date("started_at").alias("run_date"))
    rate = F.coalesce(_share(F.col("violation_count"), F.col("total_rows"), 4), F.lit(0.0))
    return results.join(header, "execution_id").select(
        "execution_id", "run_date", "pipeline_name", "rule_id", "rule_name", "dimension",
        F.concat_ws(".", "schema_name", "table_name").alias("target_table"),
        F.col("column_name").alias("target_column"),
        "severity", "status",
        F.col("violation_count").alias("failed_rows"),
        "total_rows",
        rate.alias("failure_rate_pct"),
        "executed_at",
    )


def dimension_trend(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Checks and pass share per day and dimension."""
    days = runs.select("execution_id", F.to_date("started_at").alias("run_date"))
    return (
        results.join(days, "execution_id")
        .groupBy("run_date", "dimension")
        .agg(F.count("*").alias("checks_total"), _passed("PASS").alias("checks_pass"))
        .withColumn("pass_pct", _share(F.col("checks_pass"), F.col("checks_total"), 2))
    )


def table_health(results: DataFrame, *, as_of, window: str = "30 days") -> DataFrame:
    """Checks per table in a trailing window."""
    recent = results.where((F.col("executed_at") > ago(as_of, window)) & (F.col("executed_at") <= moment(as_of)))
    return (
        recent.groupBy(F.concat_ws(".", "schema_name", "table_name").alias("target_table"))
        .agg(
            F.count("*").alias("checks_total"),
            _passed("FAIL").alias("checks_fail"),
            _passed("WARN").alias("checks_warn"),
            _passed("PASS").alias("checks_pass"),
            F.max("executed_at").alias("last_checked_at"),
        )
        .withColumn("health_score_pct", _share(F.col("checks_pass"), F.col("checks_total"), 2))
        .drop("checks_pass")
    )


def table_health_daily(results: DataFrame) -> DataFrame:
    """Share of passed checks (0..1) per day and table."""
    return (
        results.groupBy(
            F.to_date("executed_at").alias("day"),
            F.concat_ws(".", "schema_name", "table_name").alias("table_full_name"),
        )
        .agg((_passed("PASS") / F.count("*")).alias("pass_rate"))
    )


def latest_scores(scores: DataFrame) -> DataFrame:
    """Newest score per table."""
    return latest_per_key(scores, ["schema_name", "table_name"], "scored_at", ["execution_id"])


def top_failing_rules(detail: DataFrame, *, as_of, window: str = "24 hours", limit: int = 25) -> DataFrame:
    recent = detail.where((F.col("status") == "FAIL") & (F.col("executed_at") > ago(as_of, window)))
    return (
        recent.where(F.col("executed_at") <= moment(as_of))
        .orderBy(F.desc("failed_rows"), F.asc("rule_id"), F.desc("executed_at"))
        .limit(limit)
        .select("rule_name", "severity", "target_table", "failed_rows", "executed_at")
    )


def failure_scope(results: DataFrame, *, as_of, window: str = "1 hour") -> DataFrame:
    """Recent CRITICAL failures and how far they reach: one rule, one table, or many tables."""
    recent = results.where(
        (F.col("severity") == "CRITICAL")
        & (F.col("status") == "FAIL")
        & (F.col("executed_at") > ago(as_of, window))
        & (F.col("executed_at") <= moment(as_of))
    )
    return recent.agg(
        F.count_distinct("rule_id").alias("failing_rules"),
        F.count_distinct("schema_name", "table_name").alias("failing_tables"),
        F.coalesce(F.sum("violation_count"), F.lit(0)).alias("failed_rows"),
    ).withColumn(
        "scope",
        F.when(F.col("failing_rules") == 0, "NONE")
        .when(F.col("failing_rules") == 1, "SINGLE_RULE")
        .when(F.col("failing_tables") == 1, "SINGLE_TABLE")
        .otherwise("MANY_TABLES"),
    )


# --- the KPI gate -----------------------------------------------------------------
# fixed values: limits of the gate
MIN_PASS_RATE = 0.85
MAX_CRITICAL_FAILURES = 0
MAX_DURATION_SECONDS = 300


def kpi_gate(
    runs: DataFrame,
    results: DataFrame,
    *,
    min_pass_rate: float = MIN_PASS_RATE,
    max_critical: int = MAX_CRITICAL_FAILURES,
    max_seconds: float = MAX_DURATION_SECONDS,
) -> DataFrame:
    """Overall pass rate, critical failures and mean duration, with the limits they break."""
    quality = results.agg(
        (_passed("PASS") / F.count("*")).alias("overall_pass_rate"),
        F.count_if((F.col("status") == "FAIL") & (F.col("severity") == "CRITICAL")).alias("critical_failures"),
    )
    speed = runs.agg(F.avg(seconds_between(F.col("started_at"), F.col("ended_at"))).alias("avg_pipeline_seconds"))
    one = quality.withColumn("avg_pipeline_seconds", speed.scalar())
    broken = F.array_compact(
        F.array(
            F.when(F.col("overall_pass_rate") < min_pass_rate, F.lit("pass_rate")),
            F.when(F.col("critical_failures") > max_critical, F.lit("critical_failures")),
            F.when(F.col("avg_pipeline_seconds") > max_seconds, F.lit("avg_pipeline_seconds")),
        )
    )
    return one.withColumn("breaches", broken).withColumn("gate_ok", F.size("breaches") == 0)


# --- alerts -----------------------------------------------------------------------
def active_alerts(results: DataFrame, recon: DataFrame, bad: DataFrame, *, as_of) -> DataFrame:
    """Rule failures and reconciliation gaps of the last 24 hours, and rows past their clock."""
    recent = (F.col("executed_at") > ago(as_of, "24 hours")) & (F.col("executed_at") <= moment(as_of))
    rules = results.where((F.col("status") == "FAIL") & F.col("severity").isin("HIGH", "CRITICAL") & recent).select(
        F.lit("RULE_FAIL").alias("alert_type"),
        "severity",
        F.col("rule_name").alias("subject"),
        F.concat_ws(".", "schema_name", "table_name").alias("object"),
        F.col("violation_count").alias("magnitude"),
        F.col("executed_at").alias("triggered_at"),
    )
    gap = F.abs(F.coalesce("source_value", F.lit(0)) - F.coalesce("target_value", F.lit(0)))
    gaps = recon.where(F.col("status").isin("FAIL", "ERROR") & recent).select(
        F.lit("ETL_RECON_FAIL").alias("alert_type"),
        F.lit("HIGH").alias("severity"),
        F.col("job_name").alias("subject"),
        F.lit(None).cast("string").alias("object"),
        F.round(gap).cast("bigint").alias("magnitude"),
        F.col("executed_at").alias("triggered_at"),
    )
    late = sla_breaches(bad, as_of=as_of).select(
        F.lit("SLA_BREACH").alias("alert_type"),
        "severity",
        F.concat(F.lit("Quarantine row #"), F.col("quarantine_id")).alias("subject"),
        F.col("table_name").alias("object"),
        F.lit(1).cast("bigint").alias("magnitude"),
        F.col("quarantined_at").alias("triggered_at"),
    )
    return rules.unionByName(gaps).unionByName(late)


# fixed values: channels by severity, and how many alerts a digest shows
ROUTING = {
    "LOW": ["slack", "teams"],
    "MEDIUM": ["slack", "teams", "email"],
    "HIGH": ["slack", "teams", "email"],
    "CRITICAL": ["slack", "teams", "email", "pagerduty"],
}
DIGEST_SIZE = 20  # default of alert_routing
DIGEST_CHANNELS = ["slack", "teams"]


def alert_routing(alerts: DataFrame, digest_size: int = DIGEST_SIZE) -> DataFrame:
    """Alerts per channel: paging keeps the newest alert per deduplication key, chat digests show the newest
    ``digest_size``, mail gets all. ``omitted`` is the number of alerts of the channel (for paging, of the key) that
    are not shown. Delivery is left to the caller."""
    channels = F.array()
    for severity in SEVERITIES:
        names = F.array(*[F.lit(c) for c in ROUTING[severity]])
        channels = F.when(F.col("severity") == severity, names).otherwise(channels)
    routed = alerts.withColumn("dedup_key", F.concat_ws("::", "alert_type", "subject")).select(
        F.explode(channels).alias("channel"), "*"
    )
    newest = [F.desc("triggered_at"), F.asc("dedup_key"), F.desc("magnitude"), F.asc("object")]
    mail = routed.where(F.col("channel") == "email")
    chat = top_per_key(routed.where(F.col("channel").isin(DIGEST_CHANNELS)), ["channel"], newest, digest_size)
    paged = top_per_key(routed.where(F.col("channel") == "pagerduty"), ["channel", "dedup_key"], newest)
    totals = routed.groupBy(F.col("channel").alias("c"), "dedup_key").agg(F.count("*").alias("n"))
    of_key = totals.where(F.col("c") == "pagerduty").select("c", F.col("dedup_key").alias("k"), (F.col("n") - 1).alias("omitted"))
    of_chat = totals.where(F.col("c").isin(DIGEST_CHANNELS)).groupBy("c").agg(
        F.greatest(F.sum("n") - digest_size, F.lit(0)).alias("omitted")
    )
    mail = mail.withColumn("omitted", F.lit(0).cast("bigint"))
    chat = chat.join(of_chat, F.col("channel") == F.col("c")).drop("c")
    paged = paged.join(of_key, (F.col("channel") == F.col("c")) & (F.col("dedup_key") == F.col("k"))).drop("c", "k")
    return mail.unionByName(chat).unionByName(paged)


# --- metrics ------------------------------------------------------------------------
def pipeline_metrics(results: DataFrame, recon: DataFrame, bad: DataFrame, *, as_of) -> DataFrame:
    """Counters and gauges as (metric, labels, value) rows."""

    def rows(df: DataFrame, metric: str, labels: Column, value: Column) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), labels.alias("labels"), value.cast("double").alias("value"))

    executed = results.groupBy("status", "severity").agg(F.count("*").alias("n"))
    domains = results.groupBy("data_domain").agg((_passed("PASS") / F.count("*")).alias("rate"))
    gaps = recon.where(F.col("check_type") == "row_count").groupBy("job_name").agg(
        F.sum(F.abs(F.col("target_value") - F.col("source_value"))).alias("gap")
    )
    breaches = sla_breaches(bad, as_of=as_of).groupBy("severity").agg(F.count("*").alias("n"))
    label = F.concat_ws
    return (
        rows(executed, "dq.rules.executed", label(",", "status", "severity"), F.col("n"))
        .unionByName(rows(domains, "dq.rule.pass_rate", F.col("data_domain"), F.round("rate", 6)))
        .unionByName(rows(gaps, "dq.recon.gap_rows", F.col("job_name"), F.col("gap")))
        .unionByName(rows(breaches, "dq.sla.breaches", F.col("severity"), F.col("n")))
    )


# --- exports ------------------------------------------------------------------------
def sorted_reports(reports: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six exported reports in their order; missing values come first when descending."""
    order = {
        "executive_scorecard": [F.desc_nulls_first("started_at")],
        "rule_results_detail": [F.desc_nulls_first("executed_at")],
        "dimension_trend": [F.desc_nulls_first("run_date"), F.asc_nulls_last("dimension")],
        "table_health": [F.asc_nulls_last("health_score_pct")],
        "quarantine_backlog": [F.desc_nulls_first("open_rows")],
        "active_alerts": [F.desc_nulls_first("triggered_at")],
    }
    return {name: df.orderBy(*order[name]) if name in order else df for name, df in reports.items()}
