import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import reports
from tablewarden.operators.rules import Rule
from tablewarden.session import work_folder
from tablewarden.sources import readers, writers
from tablewarden.streaming import sinks
from tablewarden.streaming import transforms as tf


def test_csv_keeps_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,name,price\n1,a,1.50\n2,,\nx,c,3.00\n")
    df = readers.load_csv(spark, str(tmp_path / "p.csv"), "id int, name string, price decimal(12,2)").cache()
    rows = df.orderBy("name").collect()
    assert [(r.id, r.name, r.price and float(r.price)) for r in rows] == [(2, None, None), (1, "a", 1.5), (None, "c", 3.0)]
    assert [r[readers.BAD_RECORD] for r in rows] == [None, None, "x,c,3.00"]


def test_stage_accepts_anything(frame):
    df = frame([("1", "2.5"), ("x", "y")], "a string, b string")
    rows = readers.stage(df, load_id=3, load_ts="2024-01-01 00:00:00", types={"b": "decimal(14,2)"}).collect()
    assert [(r.a, r.b and float(r.b), r.load_id) for r in rows] == [("1", 2.5, 3), ("x", None, 3)]


def test_optional_filters(frame):
    df = frame([("a", "2024-01-01 00:00:00"), ("b", "2024-02-01 00:00:00")], "s string, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert readers.optional_filters(df, {"s": None}).count() == 2
    assert readers.optional_filters(df, {"s": "a"}, ("t", "2024-01-15 00:00:00")).count() == 0
    assert readers.optional_filters(df, None, ("t", None)).count() == 2


def test_evidence_is_idempotent_per_run(spark, frame, tmp_path):
    path = str(tmp_path / "evidence")
    rows = frame([(1,), (2,)], "x int")
    for run in ("a", "b", "a"):
        writers.write_evidence(rows, path, run_date="2024-01-01", run_id=run)
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {"a": 2, "b": 2}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_exports(spark, frame, tmp_path, fmt):
    day = dt.date
    tables = {
        "dimension_trend": frame([(day(2024, 1, 1), "x"), (day(2024, 1, 2), "y")], "run_date date, dimension string"),
        "table_health": frame([(2.0,), (1.0,)], "health_score_pct double"),
    }
    paths = writers.export_reports(
        reports.sorted_reports(tables), str(tmp_path), stamp="20240101_000000", fmt=fmt, since="2024-01-02"
    )
    reader = spark.read.option("header", True).option("inferSchema", True)
    counts = [reader.format(fmt).load(p).count() for p in paths]
    assert counts == [1, 2]


# --- streams ---------------------------------------------------------------------------------
SCHEMA = "id long, k string, v double, ts timestamp"


def write_file(spark, folder, rows):
    at = lambda minute: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    df = spark.createDataFrame([(i, k, v, at(m)) for i, k, v, m in rows], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    os.makedirs(folder, exist_ok=True)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def unique(spark, label):
    return f"{work_folder(spark)}/test-{label}-{uuid.uuid4().hex[:8]}"


RULE = Rule("R", "R", "t", "validity", violation="v > 5")


def test_stream_equals_batch(spark):
    folder, out = unique(spark, "in"), unique(spark, "out")
    for part in range(3):
        write_file(spark, folder, [(part * 10 + i, "k", float(i), part * 7 + i) for i in range(10)])
    make = lambda df: tf.rule_windows(df, [RULE], "ts", window="5 minutes", late="1 hour")
    sinks.run_available(make(stream(spark, folder)), out, mode="complete", checkpoint=unique(spark, "cp"))
    streamed = spark.read.parquet(out)
    batch = make(spark.read.schema(SCHEMA).parquet(folder))
    assert streamed.exceptAll(batch).count() == batch.exceptAll(streamed).count() == 0
    assert streamed.agg(F.sum("total_rows")).first()[0] == 30


def test_late_rows_are_counted(spark):
    folder, out = unique(spark, "in"), unique(spark, "out")
    windows = tf.rule_windows(stream(spark, folder), [RULE], "ts", window="5 minutes", late="10 minutes")
    checkpoint = unique(spark, "cp")
    for minute in (0, 600, 1, 700):
        write_file(spark, folder, [(minute, "k", 1.0, minute)])
        query = sinks.run_available(windows, out, mode="append", checkpoint=checkpoint)
        if minute == 1:
            assert sinks.late_rows(query) == 1
    rows = spark.read.parquet(out).select("window_start", "total_rows").distinct().collect()
    assert sorted(r.total_rows for r in rows) == [1, 1]  # the late row is in no window


def test_stream_quarantine_twice_writes_once(spark):
    folder, clean, bad = (unique(spark, x) for x in ("in", "clean", "bad"))
    write_file(spark, folder, [(i, "k", float(i), i) for i in range(10)])
    for _ in range(2):  # a new checkpoint replays batch 0
        sinks.quarantine_stream(
            stream(spark, folder), [RULE], key=["id"], run_id="r", as_of="2024-01-01 00:00:00",
            clean_path=clean, bad_path=bad, checkpoint=unique(spark, "cp"), payload=["id", "v"],
        )
    assert (spark.read.parquet(clean).count(), spark.read.parquet(bad).count()) == (6, 4)


def test_stream_quarantine_ids_are_unique_across_batches(spark):
    folder, clean, bad = (unique(spark, x) for x in ("in", "clean", "bad"))
    for _ in range(2):
        write_file(spark, folder, [(1, "k", 9.0, 0), (1, "k", 9.0, 0), (1, "k", 8.0, 1), (2, "k", 1.0, 0)])
    sinks.quarantine_stream(
        stream(spark, folder), [RULE], key=["id"], run_id="r", as_of="2024-01-01 00:00:00",
        clean_path=clean, bad_path=bad, checkpoint=unique(spark, "cp"), payload=["id", "v"],
    )
    rows = spark.read.parquet(bad).select("quarantine_id", "run_id", "business_key").collect()
    assert len({r.quarantine_id for r in rows}) == len(rows) == 6 and {r.run_id for r in rows} == {"r"}


def test_update_mode_keeps_rows_and_drops_state(spark):
    folder, out, checkpoint = (unique(spark, x) for x in ("in", "out", "cp"))
    make = lambda df: tf.rule_windows(df, [RULE], "ts", window="5 minutes", late="10 minutes")
    keys, states, removed = ["window_start", "window_end", "rule_id"], [], 0
    files = [[(i, "k", float(i), i) for i in range(60)], [(1, "k", 9.0, 58), (2, "k", 1.0, 300)], [(3, "k", 9.0, 600)], [(4, "k", 9.0, 601)]]
    for rows in files:
        write_file(spark, folder, rows)
        query = sinks.run_available(make(stream(spark, folder)), out, mode="update", checkpoint=checkpoint)
        for progress in query.recentProgress:
            for operator in progress["stateOperators"]:
                states.append(operator["numRowsTotal"])
                removed += operator["numRowsRemoved"]
    assert max(states) >= 12 and states[-1] <= 2 and removed >= 12
    batch = make(spark.read.schema(SCHEMA).parquet(folder))
    found = sinks.current(spark, out, keys)
    assert found.exceptAll(batch).count() == batch.exceptAll(found).count() == 0
    versions = spark.read.parquet(out).groupBy("batch_id").count().collect()
    assert max(r["count"] for r in versions if r.batch_id > 0) <= 2  # later batches write what they change
    sinks.compact(spark, out, keys, f"{out}-compact")
    assert spark.read.parquet(f"{out}-compact").drop("batch_id").exceptAll(batch).count() == 0


def test_a_percentile_that_falls_again_leaves_the_report(spark):
    folder, out, checkpoint = (unique(spark, x) for x in ("in", "out", "cp"))
    for rows in ([(1, "k", 900.0, 0)], [(i, "k", 1.0, 1) for i in range(60)]):
        write_file(spark, folder, rows)
        made = tf.durations(stream(spark, folder), "v", "ts", late="1 hour")
        sinks.run_available(made, out, mode="update", checkpoint=checkpoint)
    assert sinks.current(spark, out, ["window_start", "window_end"]).where("p95 > 100").count() == 0


def test_silence_is_reported_while_no_event_comes(spark):
    folder, out = unique(spark, "in"), unique(spark, "out")
    write_file(spark, folder, [(1, "a", 1.0, 0), (2, "a", 1.0, 30), (3, "b", 1.0, 5), (4, None, 1.0, 7)])
    beats = tf.heartbeat(stream(spark, folder), "ts", by=["k"], silence_seconds=2)
    sinks.run_until_silent(beats, out, checkpoint=unique(spark, "cp"), seconds=60)
    rows = spark.read.parquet(out).collect()
    assert sorted(((r.k, r.last_event.minute) for r in rows), key=str) == [("a", 30), ("b", 5), (None, 7)]


@pytest.mark.parametrize("window", [None, "5 minutes"])
def test_late_rows_are_kept_apart(spark, window):
    folder, out, checkpoint = (unique(spark, x) for x in ("in", "out", "cp"))
    batches = [[(1, "k", 1.0, 0), (2, "k", 1.0, 59)], [(3, "k", 1.0, 48), (4, "k", 1.0, 52), (5, "k", 1.0, 130)], [(6, "k", 1.0, 60), (7, "k", 1.0, 121)]]
    for rows in batches:
        write_file(spark, folder, rows)
    sinks.run_split_late(stream(spark, folder), out, stamp="ts", late="10 minutes", window=window, checkpoint=checkpoint)
    for _ in range(2):  # a new checkpoint replays the batches, which replace themselves
        rows = spark.read.parquet(out).select("id", F.col("late").cast("boolean").alias("late")).collect()
        assert sorted(r.id for r in rows) == list(range(1, 8))
        assert {r.id for r in rows if r.late} == ({3, 6} if window is None else {6})
        sinks.run_split_late(stream(spark, folder), out, stamp="ts", late="10 minutes", window=window, checkpoint=unique(spark, "cp"))


def test_session_ends_are_missing_heartbeats(spark):
    folder, out, checkpoint = (unique(spark, x) for x in ("in", "out", "cp"))
    beats = tf.sessions(stream(spark, folder), "ts", late="0 minutes", by=["k"])
    write_file(spark, folder, [(i, "k", 1.0, i * 10) for i in range(4)])
    sinks.run_available(beats, out, mode="append", checkpoint=checkpoint)
    write_file(spark, folder, [(9, "k", 1.0, 200)])
    sinks.run_available(beats, out, mode="append", checkpoint=checkpoint)
    ended = spark.read.parquet(out).collect()
    assert [(r.row_count, r.last_event.minute) for r in ended] == [(4, 30)]


def test_stream_dedup_and_orphans(spark, frame):
    folder = unique(spark, "in")
    write_file(spark, folder, [(1, "a", 1.0, 0), (2, "a", 1.0, 1), (3, "b", 1.0, 2)])
    once = sinks.table_of(tf.suppress_duplicates(stream(spark, folder), ["k"], "ts", within="1 hour"), "d", mode="append")
    assert sorted(r.k for r in once.collect()) == ["a", "b"]
    known = frame([("a",)], "key string")
    lost = sinks.table_of(tf.orphans(stream(spark, folder), known, "k", "key"), "o", mode="append")
    assert [r.id for r in lost.collect()] == [3]


def test_surge_and_slow_windows_on_batches(spark):
    folder = unique(spark, "in")
    write_file(spark, folder, [(i, "k", 1000.0 * i, i) for i in range(10)])
    df = spark.read.schema(SCHEMA).parquet(folder)
    surges = tf.surge(df, F.col("v") >= 0, "ts", late="1 hour")
    assert {r.hits for r in surges.collect()} == {10}
    slow = tf.slow_windows(df, "v", "ts", late="1 hour", window="5 minutes", limit=5000).collect()
    assert [(r.window_start.minute, r.p95) for r in slow] == [(5, 9000.0)]
