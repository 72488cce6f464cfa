"""Windowed checks. Each takes a streaming or a batch DataFrame and returns the same kind."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tablewarden.operators.rules import Rule

# fixed values: alert windows and limits
CRITICAL_WINDOW = "5 minutes"
DURATION_WINDOW = "10 minutes"
DURATION_LIMIT_MS = 600_000
GAP_WINDOW = "15 minutes"
GAP_ROWS_LIMIT = 1000
SURGE_WINDOW = "1 hour"
SURGE_LIMIT = 5
SILENCE = "30 minutes"
SILENCE_SECONDS = 1800


def _bounds(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "w"]
    return df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def rule_windows(df: DataFrame, rules: Iterable[Rule], stamp: str, *, window: str, late: str) -> DataFrame:
    """Rows and violations of every rule per tumbling window, from one pass."""
    rules = list(rules)
    wide = (
        df.withWatermark(stamp, late)
        .groupBy(F.window(stamp, window).alias("w"))
        .agg(F.count("*").alias("total"), *[F.count_if(r.bad).alias(f"bad_{i}") for i, r in enumerate(rules)])
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.severity).alias("severity"),
                F.col("total").alias("total_rows"),
                F.col(f"bad_{i}").alias("violation_count"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return _bounds(wide.select("w", F.inline(rows)))


def hits(
    df: DataFrame, condition: Column, stamp: str, *, late: str, window: str = SURGE_WINDOW, slide: str = "15 minutes"
) -> DataFrame:
    """How often the condition holds in each sliding window."""
    return _bounds(
        df.where(condition)
        .withWatermark(stamp, late)
        .groupBy(F.window(stamp, window, slide).alias("w"))
        .agg(F.count("*").alias("hits"))
    )


def surge(
    df: DataFrame, condition: Column, stamp: str, *, late: str, window: str = SURGE_WINDOW,
    slide: str = "15 minutes", limit: int = SURGE_LIMIT,
) -> DataFrame:
    """Sliding windows in which the condition holds more than ``limit`` times; a count only grows, so a window stays."""
    return hits(df, condition, stamp, late=late, window=window, slide=slide).where(F.col("hits") > limit)


def gap_sums(df: DataFrame, gap: Column, stamp: str, *, late: str, window: str = GAP_WINDOW) -> DataFrame:
    """Gaps of reconciliation per tumbling window."""
    return _bounds(
        df.withWatermark(stamp, late)
        .groupBy(F.window(stamp, window).alias("w"))
        .agg(F.sum(gap).alias("gap_rows"), F.count_if(gap > 0).alias("gaps"))
    )


def gap_windows(
    df: DataFrame, gap: Column, stamp: str, *, late: str, window: str = GAP_WINDOW, limit: float = GAP_ROWS_LIMIT
) -> DataFrame:
    """Tumbling windows in which the gaps add up to more than ``limit`` rows. In an update-mode stream take ``gap_sums``
    and filter the table, for a sum may fall again."""
    return gap_sums(df, gap, stamp, late=late, window=window).where(F.col("gap_rows") > limit)


def critical_failures(df: DataFrame, condition: Column, stamp: str, *, late: str, window: str = CRITICAL_WINDOW):
    """Tumbling windows with at least one critical failure."""
    return surge(df, condition, stamp, late=late, window=window, slide=window, limit=0)


def slow_windows(
    df: DataFrame, duration: str, stamp: str, *, late: str, window: str = DURATION_WINDOW,
    share: float = 0.95, limit: float = DURATION_LIMIT_MS,
) -> DataFrame:
    """Windows whose 95th percentile of durations exceeds the limit. In an update-mode stream take ``durations`` and
    filter the table, for a percentile may fall again."""
    return durations(df, duration, stamp, late=late, window=window, share=share).where(F.col("p95") > limit)


def durations(
    df: DataFrame, duration: str, stamp: str, *, late: str, window: str = DURATION_WINDOW, share: float = 0.95
) -> DataFrame:
    """The 95th percentile of durations per tumbling window; the sketch keeps state small."""
    return _bounds(
        df.withWatermark(stamp, late)
        .groupBy(F.window(stamp, window).alias("w"))
        .agg(F.percentile_approx(duration, share, 10000).alias("p95"), F.count("*").alias("row_count"))
    )


def sessions(df: DataFrame, stamp: str, *, late: str, by: list[str], silence: str = SILENCE) -> DataFrame:
    """Runs of events without a silence; in append mode a session that ends is a missing heartbeat.

    Streaming sessions need at least one key, such as the pipeline name.
    """
    grouped = df.withWatermark(stamp, late).groupBy(F.session_window(stamp, silence).alias("w"), *by)
    return grouped.agg(
        F.min(stamp).alias("first_event"), F.max(stamp).alias("last_event"), F.count("*").alias("row_count")
    ).drop("w")


def heartbeat(df: DataFrame, stamp: str, *, by: list[str], silence_seconds: int = SILENCE_SECONDS) -> DataFrame:
    """(by, last_event): a row for each key that has been silent for so long by the clock, also when no event comes any more.

    State is one moment per key; its timer starts anew with each event. A key that has been reported is forgotten until
    it speaks again. Events without a moment count as signs of life and change no moment.
    """

    def watch(key, frames, state):
        import pandas as pd

        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield pd.DataFrame({**{c: [v] for c, v in zip(by, key, strict=True)}, "last": pd.array([last], "Int64")})
            return
        last = state.get[0] if state.exists else None
        for frame in frames:
            newest = frame["_at"].max()
            if newest == newest and newest is not pd.NA:
                last = int(newest) if last is None else max(last, int(newest))
        state.update((last,))
        state.setTimeoutDuration(silence_seconds * 1000)

    own = df.select(*by, F.unix_micros(F.col(stamp).cast("timestamp")).alias("_at"))
    shape = T.StructType([*[own.schema[c] for c in by], T.StructField("last", T.LongType())])
    alerts = own.groupBy(*by).applyInPandasWithState(
        watch, shape, "last bigint", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return alerts.select(*by, F.timestamp_micros("last").alias("last_event"))


def suppress_duplicates(df: DataFrame, keys: list[str], stamp: str, *, within: str) -> DataFrame:
    """First row per key; a repeat counts as one while the watermark has not passed it."""
    return df.withWatermark(stamp, within).dropDuplicatesWithinWatermark(keys)


def orphans(df: DataFrame, reference: DataFrame, column: str, reference_column: str) -> DataFrame:
    """Stream rows whose reference a static table does not hold."""
    known = reference.select(F.col(reference_column).alias("_reference"), F.lit(True).alias("_known")).distinct()
    joined = df.join(known, F.col(column) == F.col("_reference"), "left")
    return joined.where(F.col("_known").isNull()).drop("_reference", "_known")
