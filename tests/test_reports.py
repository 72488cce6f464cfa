import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import reports as rp
from tablewarden.operators import trends

RESULT = (
    "execution_id long, rule_id string, rule_name string, schema_name string, table_name string, column_name string, "
    "dimension string, severity string, data_domain string, total_rows long, violation_count long, status string, "
    "executed_at timestamp_ntz"
)
NOW = dt.datetime(2024, 1, 2)


def result(execution, rule, status, severity="HIGH", hours=1, table="t", bad=5):
    at = NOW - dt.timedelta(hours=hours)
    return (execution, rule, rule, "s", table, "c", "validity", severity, "D", 10, bad, status, at)


RUN = "execution_id long, pipeline_name string, triggered_by string, started_at timestamp_ntz, ended_at timestamp_ntz, status string"
RECON = (
    "execution_id long, job_name string, check_type string, source_value decimal(38,6), target_value decimal(38,6), "
    "status string, executed_at timestamp_ntz"
)
BAD = "execution_id long, quarantine_id string, table_name string, severity string, status string, quarantined_at timestamp_ntz"


@pytest.fixture
def evidence(frame):
    results = frame(
        [result(1, "a", "PASS"), result(1, "b", "FAIL", "CRITICAL"), result(1, "c", "WARN"), result(2, "a", "FAIL", "LOW")],
        RESULT,
    )
    runs = frame(
        [(i, "p", "me", NOW, NOW + dt.timedelta(seconds=100 * i), "SUCCESS") for i in (1, 2, 3)], RUN
    )
    recon = frame([(1, "j", "row_count", Decimal(10), Decimal(7), "FAIL", NOW - dt.timedelta(hours=2))], RECON)
    bad = frame([(1, "q1", "t", "CRITICAL", "OPEN", NOW - dt.timedelta(hours=5))], BAD)
    return runs, results, recon, bad


def test_scorecard_keeps_runs_without_evidence(evidence):
    rows = {r.execution_id: r for r in rp.executive_scorecard(*evidence).collect()}
    assert (rows[1].rules_total, rows[1].rules_pass, rows[1].rule_pass_pct) == (3, 1, 33.33)
    assert (rows[1].etl_checks_fail, rows[1].rows_quarantined, rows[2].duration_seconds) == (1, 1, 200)
    assert (rows[3].rules_total, rows[3].rule_pass_pct) == (0, None)


def test_gate(evidence):
    runs, results, _, _ = evidence
    row = rp.kpi_gate(runs, results).first()
    assert (row.overall_pass_rate, row.critical_failures, row.avg_pipeline_seconds) == (0.25, 1, 200.0)
    assert (row.breaches, row.gate_ok) == (["pass_rate", "critical_failures"], False)
    good = rp.kpi_gate(runs, results, min_pass_rate=0.2, max_critical=1)
    assert good.first().gate_ok


def test_alerts_and_routes(evidence):
    _, results, recon, bad = evidence
    alerts = rp.active_alerts(results, recon, bad, as_of="2024-01-02 00:00:00")
    assert sorted((a.alert_type, a.severity, a.magnitude) for a in alerts.collect()) == [
        ("ETL_RECON_FAIL", "HIGH", 3), ("RULE_FAIL", "CRITICAL", 5), ("SLA_BREACH", "CRITICAL", 1),
    ]
    routed = rp.alert_routing(alerts.unionByName(alerts))
    counts = {r.channel: r["count"] for r in routed.groupBy("channel").count().collect()}
    assert counts == {"slack": 6, "teams": 6, "email": 6, "pagerduty": 2}


def test_digest_shows_the_newest_twenty(spark):
    alerts = spark.range(50).select(
        F.lit("RULE_FAIL").alias("alert_type"), F.lit("LOW").alias("severity"), F.col("id").cast("string").alias("subject"),
        F.lit("t").alias("object"), F.col("id").alias("magnitude"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("triggered_at"),
    )
    rows = rp.alert_routing(alerts).where("channel = 'slack'").collect()
    assert sorted(r.magnitude for r in rows) == list(range(30, 50))


def test_scope(frame):
    scope = lambda *rows: rp.failure_scope(frame(list(rows), RESULT), as_of="2024-01-02 00:00:00", window="3 hours").first().scope
    critical = lambda rule, table="t": result(1, rule, "FAIL", "CRITICAL", table=table)
    assert scope(result(1, "a", "PASS")) == "NONE"
    assert scope(critical("a"), critical("a")) == "SINGLE_RULE"
    assert scope(critical("a"), critical("b")) == "SINGLE_TABLE"
    assert scope(critical("a"), critical("b", "u")) == "MANY_TABLES"


def test_trends(frame):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 50.0 + i if i < 20 else 10.0) for i in range(21)]
    daily = frame([("t", d, s) for d, s in days], "g string, day date, score double")
    drift = {r.day: r for r in trends.score_drift(daily, by=["g"], day="day", score="score").collect()}
    assert [d.day for d in drift if drift[d].drifted] == [21]
    assert drift[dt.date(2024, 1, 1)].baseline is None
    odd = trends.score_anomalies(daily, by=["g"], day="day", score="score", limit=3).collect()
    assert dt.date(2024, 1, 21) in [r.day for r in odd]
    line = trends.forecast(daily.where("score > 20"), by=["g"], day_number=F.day("day"), score="score").first()
    assert (round(line.slope, 9), round(line.projected, 6)) == (1.0, 76.0)


def test_zscore_without_spread(frame):
    df = frame([("a", 5.0)] * 4 + [("b", 1.0)] * 30 + [("b", 100.0)], "g string, v double")
    assert [r.v for r in trends.zscore_rows(df, "v", by=["g"]).collect()] == [100.0]
