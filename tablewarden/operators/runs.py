"""Whole runs: compute the evidence of a stage, write it, and return the run header.

Every stage of a run shares its ``run_id``; writing a run again replaces its own rows only.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.timing import moment
from tablewarden.operators import profiling, reconcile, scoring
from tablewarden.operators import quarantine as qr
from tablewarden.operators.evaluate import evaluate_tables
from tablewarden.operators.rules import Rule, Tables
from tablewarden.sources.writers import read_evidence, write_evidence


def _header(
    spark: SparkSession, folder: str, run_date: str, run_id: str, run_type: str, *, status: str, notes: str,
    started_at: str, ended_at: str, pipeline: str, triggered_by: str,
) -> DataFrame:
    row = spark.range(1).select(
        F.concat_ws("-", F.lit(run_id), F.lit(run_type)).alias("execution_id"),
        F.lit(run_type).alias("run_type"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(triggered_by).alias("triggered_by"),
        moment(started_at).alias("started_at"),
        moment(ended_at).alias("ended_at"),
        F.lit(status).alias("status"),
        F.lit(notes).alias("notes"),
    )
    write_evidence(row, f"{folder}/runs_{run_type.lower()}", run_date=run_date, run_id=run_id)
    return row.withColumn("run_id", F.lit(run_id))


def _written(spark: SparkSession, path: str, run_date: str, run_id: str) -> DataFrame:
    return read_evidence(spark, path).where((F.col("run_date") == run_date) & (F.col("run_id") == run_id))


def run_rules(
    spark: SparkSession, tables: Tables, rules: Iterable[Rule], folder: str, *, run_id: str, as_of: str,
    ended_at: str | None = None, table: str | None = None, pipeline: str = "quality", triggered_by: str = "cli",
) -> DataFrame:
    """Evaluate the active rules (of one table, if given), write results and scores."""
    wanted = [r for r in rules if r.active and (table is None or r.table == table)]
    day = as_of[:10]
    results = evaluate_tables(tables, wanted, run_id=run_id, as_of=as_of)
    write_evidence(results, f"{folder}/rule_results", run_date=day, run_id=run_id)
    results = _written(spark, f"{folder}/rule_results", day, run_id)
    write_evidence(
        scoring.quality_scores(results).withColumn("scored_at", moment(as_of)),
        f"{folder}/quality_scores", run_date=day, run_id=run_id,
    )
    outcome = scoring.run_status(results).first()  # one row per run
    notes = f"rules={outcome.checks} fail={outcome.fail_count} error={outcome.error_count}"
    return _header(
        spark, folder, day, run_id, "RULES", status=outcome.status, notes=notes, started_at=as_of,
        ended_at=ended_at or as_of, pipeline=pipeline, triggered_by=triggered_by,
    )


def run_profile(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, *, run_id: str, as_of: str,
    ended_at: str | None = None, pipeline: str = "quality", triggered_by: str = "cli",
) -> DataFrame:
    """Profile every column of the tables and write the profiles."""
    day = as_of[:10]
    profiles = profiling.profile_tables(tables).withColumn("profiled_at", moment(as_of))
    write_evidence(profiles, f"{folder}/profile_results", run_date=day, run_id=run_id)
    return _header(
        spark, folder, day, run_id, "PROFILE", status="SUCCESS", notes=f"tables={len(tables)}", started_at=as_of,
        ended_at=ended_at or as_of, pipeline=pipeline, triggered_by=triggered_by,
    )


def run_recon(
    spark: SparkSession, tables: Mapping[str, DataFrame], checks: Iterable[reconcile.Check], folder: str, *,
    run_id: str, as_of: str, ended_at: str | None = None, job: str | None = None, pipeline: str = "quality",
    triggered_by: str = "cli",
) -> DataFrame:
    """Run the active reconciliation jobs (or one of them) and write their results."""
    day = as_of[:10]
    wanted = [c for c in checks if c.active and (job is None or c.job_name == job)]
    results = reconcile.reconcile(tables, wanted, run_id=run_id, as_of=as_of)
    write_evidence(results, f"{folder}/recon_results", run_date=day, run_id=run_id)
    written = _written(spark, f"{folder}/recon_results", day, run_id)
    outcome = scoring.run_status(written).first()  # one row per run
    notes = f"jobs={outcome.checks} fail={outcome.fail_count} error={outcome.error_count}"
    return _header(
        spark, folder, day, run_id, "ETL_RECON", status=outcome.status, notes=notes, started_at=as_of,
        ended_at=ended_at or as_of, pipeline=pipeline, triggered_by=triggered_by,
    )


def run_quarantine(
    spark: SparkSession, tables: Tables, rules: Iterable[Rule], keys: Mapping[str, list[str]], folder: str, *,
    run_id: str, as_of: str, ended_at: str | None = None, pipeline: str = "quality", triggered_by: str = "cli",
) -> DataFrame:
    """Capture the rows behind the violations of this run's rule results.

    Only rules with violations are looked at; row rules of one table, and rules that want its key unique, share a scan
    and are dealt by the key once.
    """
    day = as_of[:10]
    results = _written(spark, f"{folder}/rule_results", day, run_id)
    failing = {r.rule_id for r in results.where("violation_count > 0").select("rule_id").collect()}  # rule ids only
    rules = list(rules)
    active = [r for r in rules if r.rule_id in failing]
    active_tables = next(((r.table, r) for r in rules if r.violation is not None and r.table in keys), None)
    parts = []
    together = [r for r in active if qr.shares_key(tables[r.table], r, keys[r.table])]
    for name in dict.fromkeys(r.table for r in together):
        own = [r for r in together if r.table == name]
        parts.append(qr.quarantine_table(tables[name], own, key=keys[name], run_id=run_id, as_of=as_of))
    for rule in active:
        if rule not in together:
            parts.append(
                qr.quarantine_selected(tables, rule, key=keys[rule.table], run_id=run_id, as_of=as_of)
            )
    if not parts and active_tables:  # an earlier capture of this run is replaced by no rows
        name, rule = active_tables
        nothing = tables[name].where(F.lit(False))
        parts.append(qr.quarantine(nothing, [rule], key=keys[name], run_id=run_id, as_of=as_of))
    captured = 0
    if parts:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        write_evidence(rows, f"{folder}/bad_rows", run_date=day, run_id=run_id)
        captured = _written(spark, f"{folder}/bad_rows", day, run_id).count()
    return _header(
        spark, folder, day, run_id, "QUARANTINE", status="SUCCESS", notes=f"rules={len(active)} quarantined={captured}",
        started_at=as_of, ended_at=ended_at or as_of, pipeline=pipeline, triggered_by=triggered_by,
    )
