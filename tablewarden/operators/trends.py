"""Statistical rules and trends over scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.timing import seconds_between
from tablewarden.operators.attach import attach, unused
from tablewarden.operators.quantiles import exact_percentiles


def zscore_rows(df: DataFrame, value: str, *, by: list[str], limit: float = 3.0) -> DataFrame:
    """Rows further than ``limit`` sample deviations from the mean of their group, NULL being a group too.

    Adds group_mean, group_sd and z; columns of these names are replaced.
    """
    mean, spread, score = unused(df.columns, "_mean", "_spread", "_z")
    stats = df.groupBy(*by).agg(F.avg(value).alias(mean), F.stddev_samp(value).alias(spread))
    z = F.abs(F.col(value) - F.col(mean)) / F.nullif(F.col(spread), F.lit(0.0))
    shown = [F.col(mean).alias("group_mean"), F.col(spread).alias("group_sd"), z.alias("z")]
    own = [F.col(f"`{c}`") for c in df.columns if c not in ("group_mean", "group_sd", "z")]
    return attach(df, stats, by).select(*own, *shown, z.alias(score)).where(F.col(score) > limit).drop(score)


def outlier_counts(df: DataFrame, value: str, *, by: list[str], whisker: float = 1.5) -> DataFrame:
    """Rows below and above the interquartile fences of their group."""
    quartiles = exact_percentiles(df, value, {"q1": 0.25, "q3": 0.75}, by)
    reach = (F.col("q3") - F.col("q1")) * whisker
    fences = quartiles.withColumn("low_fence", F.col("q1") - reach).withColumn("high_fence", F.col("q3") + reach)
    # values are counted before they meet the fences
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_n"))
    below = F.sum(F.when(F.col(value) < F.col("low_fence"), F.col("_n")).otherwise(0))
    above = F.sum(F.when(F.col(value) > F.col("high_fence"), F.col("_n")).otherwise(0))
    return attach(counts, fences, by).groupBy(*by, "q1", "q3", "low_fence", "high_fence").agg(
        F.sum("_n").alias("row_count"), below.alias("below"), above.alias("above")
    )


def window_counts(df: DataFrame, stamp: str, *, window: str, low: int, high: int) -> DataFrame:
    """Rows per time window, marked when outside the bounds."""
    counted = df.groupBy(F.window(stamp, window).alias("w")).agg(F.count("*").alias("row_count"))
    return counted.select(
        F.col("w.start").alias("window_start"),
        "row_count",
        F.when(F.col("row_count").between(low, high), "PASS").otherwise("FAIL").alias("status"),
    )


def gaps(df: DataFrame, stamp: str, *, longer_than_seconds: int, by: list[str] | None = None) -> DataFrame:
    """Silent stretches: neighbouring events more than the limit apart.

    Events closer than the limit cannot hide a gap, so time is cut in slots of that length and only
    the first and last event of each slot are compared. The rows to sort shrink to the used slots.
    """
    by = by or []
    used = df.groupBy(*by, F.window(stamp, f"{longer_than_seconds} seconds").alias("w")).agg(
        F.min(stamp).alias("first_event"), F.max(stamp).alias("last_event")
    )
    before = F.lag("last_event").over(Window.partitionBy(*by).orderBy("first_event"))
    length = seconds_between(F.col("gap_start"), F.col("first_event"))
    return (
        used.withColumn("gap_start", before)
        .withColumn("gap_seconds", length)
        .where(F.col("gap_seconds") > longer_than_seconds)
        .select(*by, "gap_start", F.col("first_event").alias("gap_end"), "gap_seconds")
    )


def latency(
    source: DataFrame, target: DataFrame, key: str, *, source_stamp: str, target_stamp: str, probs: dict[str, float]
) -> DataFrame:
    """Percentiles of the time from source load to target load, over keys loaded on both sides."""
    loaded = source.select(key, F.col(source_stamp).alias("_s")).join(
        target.select(key, F.col(target_stamp).alias("_t")), key
    )
    lag = loaded.select(seconds_between(F.col("_s"), F.col("_t")).alias("latency_seconds"))
    return exact_percentiles(lag, "latency_seconds", probs)


def _trailing(days: int, by: list[str], day: str):
    return Window.partitionBy(*by).orderBy(day).rowsBetween(-days, -1)


def score_drift(daily: DataFrame, *, by: list[str], day: str, score: str, days: int = 7, drop: float = 5.0):
    """Score of each day against the mean of the days before; one row per group and day goes in."""
    baseline = F.avg(score).over(_trailing(days, by, day))
    return (
        daily.withColumn("baseline", baseline)
        .withColumn("change", F.col(score) - F.col("baseline"))
        .withColumn("drifted", F.coalesce(F.col("change") < -drop, F.lit(False)))
    )


def score_anomalies(daily: DataFrame, *, by: list[str], day: str, score: str, days: int = 30, limit: float = 2.0):
    """Days whose score lies more than ``limit`` deviations from the trailing mean."""
    over = _trailing(days, by, day)
    mean, spread = F.avg(score).over(over), F.stddev_samp(score).over(over)
    return (
        daily.withColumn("trailing_mean", mean)
        .withColumn("trailing_sd", spread)
        .withColumn("z", (F.col(score) - F.col("trailing_mean")) / F.nullif("trailing_sd", F.lit(0.0)))
        .where(F.abs("z") > limit)
    )


def forecast(daily: DataFrame, *, by: list[str], day_number: Column, score: str, ahead: int = 7) -> DataFrame:
    """Linear fit per group and the value it projects ``ahead`` days after the last one."""
    points = daily.withColumn("_x", day_number.cast("double"))
    fit = points.groupBy(*by).agg(
        F.regr_slope(score, "_x").alias("slope"),
        F.regr_intercept(score, "_x").alias("intercept"),
        F.max("_x").alias("last_day"),
        F.count("*").alias("points"),
    )
    return fit.withColumn("projected", F.col("intercept") + F.col("slope") * (F.col("last_day") + ahead)).drop("last_day")
