"""From rule results to dimension scores, table scores and run status."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.timing import ago, moment
from tablewarden.schemas import DEFAULT_WEIGHTS, DIMENSIONS, PCT

TABLE_KEY = ["run_id", "schema_name", "table_name"]


def dimension_scores(results: DataFrame, by: list[str] = TABLE_KEY) -> DataFrame:
    """Mean pass rate per dimension. ERROR rows have no rate, so the mean leaves them out."""
    return results.groupBy(*by, "dimension").agg(
        F.avg("pass_rate_pct").cast(PCT).alias("dim_score"),
        F.count("*").alias("rules_run"),
        F.sum("violation_count").alias("total_violations"),
    )


def quality_scores(
    results: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS, by: list[str] = TABLE_KEY
) -> DataFrame:
    """One row per table: a column per dimension and the weighted overall score.

    Weights are renormalised over the weighted dimensions a table has; without any the score is 0.
    """
    dims = dimension_scores(results, by)
    wide = dims.groupBy(*by).agg(
        *[F.max(F.when(F.col("dimension") == d, F.col("dim_score"))).alias(f"{d}_score") for d in DIMENSIONS],
        F.sum("rules_run").alias("total_rules_run"),
        F.sum("total_violations").alias("total_violations"),
    )
    weighted = weight = F.lit(0).cast("decimal(20,8)")
    for dimension, share in weights.items():
        score = F.col(f"{dimension}_score")
        share = F.lit(share).cast("decimal(8,6)")
        weighted = weighted + F.coalesce(score * share, F.lit(0).cast("decimal(20,8)"))
        weight = weight + F.when(score.isNotNull(), share).otherwise(F.lit(0).cast("decimal(8,6)"))
    overall = F.when(weight > 0, F.round(weighted / F.nullif(weight, F.lit(0)), 4)).otherwise(F.lit(0))
    return wide.withColumn("overall_score", overall.cast(PCT))


def quality_scores_long(
    results: DataFrame, weights: Mapping[str, float] = DEFAULT_WEIGHTS, by: list[str] = TABLE_KEY
) -> DataFrame:
    """One row per table and dimension with its weight, plus an Overall row."""
    share = F.lit(0.0)
    for dimension, value in weights.items():
        share = F.when(F.col("dimension") == dimension, F.lit(float(value))).otherwise(share)
    weight_pct = (share * 100).cast("decimal(5,2)")
    parts = dimension_scores(results, by).select(
        *by,
        "dimension",
        F.col("dim_score").alias("dimension_score"),
        weight_pct.alias("weight_pct"),
        F.round(F.col("dim_score") * weight_pct / 100, 4).cast(PCT).alias("weighted_score"),
    )
    overall = quality_scores(results, weights, by).select(
        *by,
        F.lit("Overall").alias("dimension"),
        F.col("overall_score").alias("dimension_score"),
        F.lit(100).cast("decimal(5,2)").alias("weight_pct"),
        F.col("overall_score").alias("weighted_score"),
    )
    return parts.unionByName(overall)


def run_status(results: DataFrame, by: str = "run_id") -> DataFrame:
    """FAILED on any error, COMPLETED_WITH_FAILURES on any failure, else SUCCESS."""
    return (
        results.groupBy(by)
        .agg(
            F.count("*").alias("checks"),
            F.count_if(F.col("status") == "FAIL").alias("fail_count"),
            F.count_if(F.col("status") == "ERROR").alias("error_count"),
        )
        .withColumn(
            "status",
            F.when(F.col("error_count") > 0, "FAILED")
            .when(F.col("fail_count") > 0, "COMPLETED_WITH_FAILURES")
            .otherwise("SUCCESS"),
        )
    )


def failed_rules(results: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rules with violations and their definition, worst first."""
    wanted = catalog.select("rule_id", "expr", "description")
    return (
        results.where("violation_count > 0")
        .join(wanted, "rule_id")
        .orderBy(F.desc("violation_count"), F.asc("rule_id"))
    )


def run_summary(results: DataFrame, *, as_of, window: str = "10 minutes") -> DataFrame:
    """Rules, passes, fails and failed rows per dimension in a recent window."""
    recent = results.where(F.col("executed_at") > ago(as_of, window)).where(F.col("executed_at") <= moment(as_of))
    return recent.groupBy("dimension").agg(
        F.count("*").alias("rules"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.sum("violation_count").alias("failed_rows"),
    )


def slow_rules(durations: DataFrame, *, rule: str = "rule_name", duration: str = "duration_ms", top: int = 10):
    """Slowest rules by mean duration."""
    return (
        durations.groupBy(rule)
        .agg(F.avg(duration).alias("avg_ms"), F.max(duration).alias("max_ms"))
        .orderBy(F.desc("avg_ms"), F.asc(rule))
        .limit(top)
    )


def ordered_labels(df: DataFrame, by: list[str], label: str, alias: str) -> DataFrame:
    """Distinct labels of each group as one sorted, comma-separated text; NULL labels are left out.

    Labels are collected as sets before the shuffle, so a group keeps one entry per label and never a list of its rows.
    """
    return df.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(label)), ",").alias(alias))
