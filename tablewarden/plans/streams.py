"""Bindings for streaming: the events table read as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.plans.quarantines import EVENT_RULES, PAYLOAD, RUN, payload_sql
from tablewarden.plans.registry import Loader, query, stamp_sql
from tablewarden.session import new_path
from tablewarden.sources.writers import stored
from tablewarden.streaming import sinks
from tablewarden.streaming import transforms as tf

LATE = "2 hours"
WINDOW = ["window_start", "window_end"]
SLICES = 6  # files that rows arrive in
RULES = [x for x, _ in EVENT_RULES]


def events(load: Loader):
    return sinks.read_stream(load.spark, load.folder, "events", stamp="ts")


def bounds(df):
    """Window ends as plain moments, whatever the session time zone is."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def window_sql(width: str) -> str:
    start = f"time_bucket(INTERVAL '{width}', ts)"
    return f"{stamp_sql(start)} AS window_start, {stamp_sql(f'{start} + INTERVAL {chr(39)}{width}{chr(39)}')} AS window_end"


@query(
    "stream_rule_windows",
    " UNION ALL ".join(
        f"SELECT {window_sql('1 hour')}, '{x.rule_id}' AS rule_id, '{x.severity}' AS severity, count(*) AS total_rows, "
        f"count(*) FILTER (WHERE {p}) AS violation_count FROM events GROUP BY time_bucket(INTERVAL '1 hour', ts)"
        for x, p in EVENT_RULES
    ),
)
def stream_rule_windows(load):
    found = tf.rule_windows(events(load), RULES, "ts", window="1 hour", late=LATE)
    return bounds(sinks.table_of(found, "windows", keys=[*WINDOW, "rule_id"]))


@query(
    "stream_surge",
    f"""WITH slots AS (SELECT time_bucket(INTERVAL '15 minutes', ts) - to_minutes(15 * i::INT) AS s, ts
        FROM events, range(4) r(i) WHERE event_type = 'error')
    SELECT {stamp_sql('s')} AS window_start, {stamp_sql("s + INTERVAL '1 hour'")} AS window_end, count(*) AS hits
    FROM slots GROUP BY s HAVING count(*) > 5""",
)
def stream_surge(load):
    found = tf.surge(events(load), F.col("event_type") == "error", "ts", late=LATE)
    return bounds(sinks.table_of(found, "surge", keys=WINDOW))


@query(
    "stream_critical_failures",
    f"""SELECT {window_sql('5 minutes')}, count(*) AS hits FROM events WHERE event_type = 'error' AND value > 60
    GROUP BY time_bucket(INTERVAL '5 minutes', ts)""",
)
def stream_critical_failures(load):
    found = tf.critical_failures(events(load), F.expr("event_type = 'error' AND value > 60"), "ts", late=LATE)
    return bounds(sinks.table_of(found, "critical", keys=WINDOW))


@query(
    "stream_recon_gaps",
    f"""SELECT {window_sql('15 minutes')}, sum(floor(value * 10)::BIGINT)::BIGINT AS gap_rows, count(*) FILTER (WHERE floor(value * 10) > 0) AS gaps
    FROM events GROUP BY time_bucket(INTERVAL '15 minutes', ts) HAVING sum(floor(value * 10)::BIGINT) > {tf.GAP_ROWS_LIMIT}""",
)
def stream_recon_gaps(load):
    """A tenth of the value stands for one lost row."""
    gap = F.floor(F.col("value") * 10).cast("bigint")
    found = sinks.table_of(tf.gap_sums(events(load), gap, "ts", late=LATE), "gaps", keys=WINDOW)
    return bounds(found.where(F.col("gap_rows") > tf.GAP_ROWS_LIMIT))


@query(
    "stream_p95",
    f"""SELECT {window_sql('1 hour')}, quantile_disc(value, 0.95) AS p95, count(*) AS row_count FROM events
    GROUP BY time_bucket(INTERVAL '1 hour', ts) HAVING quantile_disc(value, 0.95) > 150""",
)
def stream_p95(load):
    found = sinks.table_of(tf.durations(events(load), "value", "ts", late=LATE, window="1 hour"), "p95", keys=WINDOW)
    return bounds(found.where("p95 > 150"))


@query(
    "stream_sessions",
    f"""WITH e AS (SELECT user_id, ts, coalesce(ts >= lag(ts) OVER w + INTERVAL 30 MINUTE, true) AS fresh
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      s AS (SELECT *, count(*) FILTER (WHERE fresh) OVER (PARTITION BY user_id ORDER BY ts) AS nth FROM e)
    SELECT user_id, {stamp_sql('min(ts)')} AS first_event, {stamp_sql('max(ts)')} AS last_event, count(*) AS row_count
    FROM s GROUP BY user_id, nth""",
)
def stream_sessions(load):
    found = sinks.table_of(tf.sessions(events(load), "ts", late=LATE, by=["user_id"]), "sessions")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_event", "last_event")})


@query(
    "stream_quarantine",
    " UNION ALL ".join(
        f"SELECT md5('{RUN}|{x.rule_id}|' || event_id) AS quarantine_id, 'bad' AS side, event_id::VARCHAR AS business_key, "
        f"{payload_sql(PAYLOAD)} AS payload FROM events WHERE {p}"
        for x, p in EVENT_RULES
    )
    + " UNION ALL SELECT NULL, 'clean', event_id::VARCHAR, NULL FROM events WHERE NOT ("
    + " OR ".join(f"coalesce({p}, false)" for _, p in EVENT_RULES)
    + ")",
)
def stream_quarantine(load):
    spark = load.spark
    clean, bad = new_path(spark, "clean"), new_path(spark, "bad")
    sinks.quarantine_stream(
        events(load), RULES, key=["event_id"], run_id=RUN, as_of=F.col("ts").cast("timestamp_ntz"),
        payload=PAYLOAD, clean_path=clean, bad_path=bad, checkpoint=new_path(spark, "quarantine-checkpoint"), unique_key=True,
    )
    kept = spark.read.parquet(clean).select(
        F.lit(None).cast("string").alias("quarantine_id"), F.lit("clean").alias("side"),
        F.col("event_id").cast("string").alias("business_key"), F.lit(None).cast("string").alias("payload"),
    )
    caught = spark.read.parquet(bad).select("quarantine_id", F.lit("bad").alias("side"), "business_key", "payload")
    return caught.unionByName(kept)


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(load):
    found = tf.suppress_duplicates(events(load), ["user_id", "event_type"], "ts", within="60 days")
    return sinks.table_of(found.select("user_id", "event_type"), "dedup", mode="append")


@query(
    "stream_orphans",
    f"""SELECT event_id, user_id, {stamp_sql('ts')} AS ts FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def stream_orphans(load):
    standing = load("customer").where("c_acctbal > 0")
    found = tf.orphans(events(load), standing, "user_id", "c_custkey").select("event_id", "user_id", "ts")
    return sinks.table_of(found, "orphans", mode="append").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_heartbeat",
    f"SELECT user_id, {stamp_sql('max(ts)')} AS last_event FROM events GROUP BY user_id",
)
def stream_heartbeat(load):
    """Once the table has been read no event comes any more, so every user is reported after two silent seconds."""
    path = new_path(load.spark, "silent")
    alerts = tf.heartbeat(events(load), "ts", by=["user_id"], silence_seconds=2)
    sinks.run_until_silent(alerts, path, checkpoint=new_path(load.spark, "silent-checkpoint"), seconds=120)
    found = load.spark.read.parquet(path).drop("batch_id")
    return found.withColumn("last_event", F.col("last_event").cast("timestamp_ntz"))


def arrival(load: Loader):
    """The events with the file they arrive in: some come up to a third of all time after they happened."""
    slot = f"CAST(floor((unix_micros(CAST(ts AS timestamp)) - low) / (high - low + 1) * {SLICES}) AS int)"
    ends = load("events").agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("low"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("high"))
    late = F.when(F.col("event_id") % 10 == 0, F.lit(SLICES // 3)).otherwise(0)
    return load("events").join(F.broadcast(ends)).withColumn("arrives", F.least(F.expr(slot) + late, F.lit(SLICES - 1))).drop("low", "high")


ARRIVAL = f"""arrival AS (SELECT *, least(floor((epoch_us(ts) - low) / (high - low + 1) * {SLICES})::INT
      + CASE WHEN event_id % 10 = 0 THEN {SLICES // 3} ELSE 0 END, {SLICES - 1}) AS arrives
    FROM events, (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events)),
  marks AS (SELECT arrives, max(max(ts)) OVER (ORDER BY arrives ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 HOUR AS mark
    FROM arrival GROUP BY arrives)"""


@query(
    "late_rows",
    f"""WITH {ARRIVAL} SELECT event_id, {stamp_sql('ts')} AS ts,
      coalesce(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= mark, false) AS late FROM arrival JOIN marks USING (arrives)""",
)
def late_rows(load):
    """All events, with those that come behind the watermark marked; kept and late rows together are the input."""
    spark, folder, path = load.spark, new_path(load.spark, "arriving"), new_path(load.spark, "late")
    rows = stored(arrival(load), "arrival")
    for k in range(SLICES):  # one file after another, as they arrive
        rows.where(F.col("arrives") == k).drop("arrives").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(rows.drop("arrives").schema).option("maxFilesPerTrigger", 1).parquet(folder)
    sinks.run_split_late(stream, path, stamp="ts", late="2 hours", window="1 hour", checkpoint=new_path(spark, "late-checkpoint"))
    return spark.read.parquet(path).select("event_id", "ts", F.col("late").cast("boolean").alias("late"))
