import hashlib
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import profiling, trends
from tablewarden.operators import reconcile as rc
from tablewarden.operators.quantiles import exact_percentiles


def types_of(frame, values):
    df = frame([(v,) for v in values], "x string")
    return profiling.profile(df, "t").first().inferred_type


@pytest.mark.parametrize(
    "values, expected",
    [
        (["a@b.io"] * 6 + ["?"] * 4, "email"),
        (["a@b.io"] * 59 + ["?"] * 41, "text"),
        (["5551234567"], "phone_e164"),
        (["(555) 123-4567"], "phone_us"),
        (["007"], "integer"),
        ([" 1.5 "], "decimal"),
        (["2024-01-05"], "date_iso"),
        (["1/5/24"], "date_us"),
        (["123e4567-e89b-12d3-a456-426614174000"], "uuid"),
        ([None], "unknown"),
        ([], "unknown"),
    ],
)
def test_semantic_type(frame, values, expected):
    assert types_of(frame, values) == expected


def test_profile_against_brute_force(frame):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "bb", "ccc", "bb"]), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    found = {x.column_name: x for x in profiling.profile(frame(rows, "s string, n int"), "t").collect()}
    for i, name in enumerate(("s", "n")):
        values = [r[i] for r in rows if r[i] is not None]
        counts = sorted(((values.count(v), str(v)) for v in set(values)), key=lambda x: (-x[0], hashlib.sha256(x[1].encode()).hexdigest()))
        assert found[name].row_count == 300
        assert found[name].null_count == 300 - len(values)
        assert found[name].distinct_count == len(set(values))
        assert found[name].top_values == "|".join(f"{v}:{c}" for c, v in counts[:5])
    numbers = [r[1] for r in rows if r[1] is not None]
    assert found["n"].mean_value == pytest.approx(statistics.mean(numbers))
    assert found["n"].stddev_value == pytest.approx(statistics.stdev(numbers))
    assert (found["s"].min_length, found["s"].max_length, found["n"].min_length) == (1, 3, None)


def test_long_texts_are_told_apart_and_shown_in_full(frame):
    long = "x" * 500
    values = [long + "a"] * 3 + [long + "b"] * 2 + ["short", None]
    found = profiling.profile(frame([(v,) for v in values], "t string"), "t").first()
    assert (found.distinct_count, found.null_count, found.max_length) == (3, 1, 501)
    assert found.top_values == f"{long}a:3|{long}b:2|short:1"
    emails = profiling.profile(frame([("a" * 200 + "@b.io",)], "t string"), "t").first()
    assert emails.inferred_type == "email"


def test_top_values_limits_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    columns = ["o_orderkey", "o_orderstatus"]
    best = profiling.top_values(profiling.value_counts(df, columns), profiling.long_texts(df, columns))
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_top_values_sort_few_of_many(spark, monkeypatch):
    numbers = spark.range(20000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") < 9000, F.col("id") % 3000).otherwise(F.col("id")).alias("r"),
        F.concat(F.lit("t"), F.col("id") % 7000).alias("t"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("x" * 200), F.col("id"))).alias("long"),
        F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") > 1, F.lit("one")).alias("one"),
    )
    sizes, limited = [], profiling.top_per_key

    def counted(df, *args):
        sizes.append(df.count())
        return limited(df, *args)

    monkeypatch.setattr(profiling, "top_per_key", counted)
    counts = profiling.value_counts(numbers, numbers.columns).localCheckpoint()
    found = profiling.top_values(counts, profiling.long_texts(numbers, numbers.columns))
    rows = {c: [r[c] for r in numbers.select(c).collect() if r[c] is not None] for c in numbers.columns}
    expected = {}
    for column, values in rows.items():
        places = sorted((-n, hashlib.sha256(str(v).encode()).hexdigest(), v) for v, n in Counter(values).items())
        expected[column] = "|".join(f"{v}:{-n}" for n, _, v in places[:5])
    assert {r.column_name: r.top_values for r in found.collect()} == {c: v for c, v in expected.items() if v}
    assert counts.count() > 50000 and max(sizes) < 1000  # buckets of a column, and what reaches its bound


def test_top_values_of_counts_too_large_for_the_tie(frame):
    sizes = [5, 1 << 23, (1 << 23) - 1, (1 << 23) + 1, 1 << 50, 1 << 62, 1 << 24, 1]
    counts = frame([("c", f"v{i}", None, n) for i, n in enumerate(sizes)], "column_name string, value string, long_label string, n long")
    texts = frame([], "column_name string, full_text string, value string")
    for most in (1, 3, 5, 20):
        expected = sorted(((n, i) for i, n in enumerate(sizes)), reverse=True)[:most]
        assert profiling.top_values(counts, texts, most).first().top_values == "|".join(f"v{i}:{n}" for n, i in expected)


@pytest.mark.parametrize("count", [1, 2, 3, 10, 1001])
def test_exact_percentiles(frame, count):
    rng = random.Random(count)
    # one hot value holds a third of the rows
    values = [7.0 if rng.random() < 0.33 else rng.lognormvariate(2, 3) for _ in range(count)]
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    found = exact_percentiles(frame([(v,) for v in values], "v double"), "v", probs, buckets=16).first()
    ordered = sorted(values)
    for name, prob in probs.items():
        position = prob * (count - 1)
        low = int(position)
        high = min(low + 1, count - 1) if position > low else low
        expected = ordered[low] + (ordered[high] - ordered[low]) * (position - low)
        assert found[name] == pytest.approx(expected), name


def test_percentiles_per_group(frame):
    rows = [(g, float(v)) for g in "ab" for v in range(1 if g == "a" else 100)] + [("c", None)]
    found = {x.g: x.p50 for x in exact_percentiles(frame(rows, "g string, v double"), "v", {"p50": 0.5}, ["g"]).collect()}
    assert found == {"a": 0.0, "b": 49.5}


@pytest.mark.parametrize(
    "source, target, status, pct",
    [
        (100, 100, "PASS", 0), (1000, 1005, "WARN", 0.5), (1000, 1006, "FAIL", 0.6), (0, 0, "PASS", 0),
        (0, 1, "FAIL", 100), (None, 1, "ERROR", None), (1, None, "ERROR", None), (10**9, 10**9 + 4, "WARN", 0),
        (-1000, -1005, "WARN", 0.5),
    ],
)
def test_tolerance(frame, source, target, status, pct):
    df = frame([(source, target)], "source_value long, target_value long")
    found = rc.compared(df.withColumn("tolerance_pct", F.lit(0.5).cast("decimal(7,4)"))).first()
    assert found.status == status
    assert (None if found.diff_pct is None else float(found.diff_pct)) == pct


def test_keyed_diff(frame):
    schema = "k int, a string, b int"
    source = frame([(1, "x", 1), (2, None, 2), (3, "z", 3), (4, "w", None), (6, "d", 1), (6, "d", 1)], schema)
    target = frame([(1, "x", 1), (2, "y", 2), (4, "w", 4), (5, "v", 5), (6, "d", 1)], schema)
    diff = rc.keyed_diff(source, target, ["k"], ["a", "b"])
    found = {x.k: (x.status, x.changed_columns) for x in diff.collect()}
    assert found == {
        1: ("MATCH", []), 2: ("CHANGED", ["a"]), 3: ("MISSING_IN_TARGET", None), 4: ("CHANGED", ["b"]),
        5: ("MISSING_IN_SOURCE", None), 6: ("CHANGED", []),
    }
    assert sum(x.key_count for x in rc.diff_summary(diff).collect()) == 6
    found = {x.column_name: (x.compared, x.mismatches) for x in rc.column_mismatches(diff, ["a", "b"]).collect()}
    assert found == {"a": (4, 1), "b": (4, 1)}


def test_keyed_diff_with_a_hot_key(spark):
    """Many rows on one key on both sides stay one group of counts, never pairs."""
    hot = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") % 100).alias("v"))
    found = rc.keyed_diff(hot, hot.repartition(3), ["k"], ["v"]).collect()
    assert [(x.source_rows, x.target_rows, x.status) for x in found] == [(20000, 20000, "MATCH")]
    moved = hot.withColumn("v", F.when(F.col("v") == 5, 6).otherwise(F.col("v")))
    assert rc.keyed_diff(hot, moved, ["k"], ["v"]).first().status == "CHANGED"


def test_checks_of_every_type(frame):
    tables = {
        "s": frame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "k int, g string, v int"),
        "t": frame([(1, "a", 10), (2, "b", 21), (9, None, 30)], "k int, g string, v int"),
    }
    checks = [
        rc.Check(1, "rows", "row_count", "s", "t", source_where="g IS NOT NULL", tolerance_pct=60),
        rc.Check(2, "sum", "sum_check", "s", "t", measure="v"),
        rc.Check(3, "distinct", "distinct_check", "s", "t", measure="g"),
        rc.Check(4, "nulls", "null_check", "s", "t", measure="g"),
        rc.Check(5, "orphans", "orphan_check", "s", "t", measure="k", parent=("s", "k")),
        rc.Check(6, "hash", "hash_check", "s", "t", measure="k,g,v"),
        rc.Check(7, "idle", "row_count", "s", "t", active=False),
    ]
    found = {x.job_name: x.status for x in rc.reconcile(tables, checks, run_id="r", as_of="2024-01-01").collect()}
    assert found == {"rows": "WARN", "sum": "FAIL", "distinct": "PASS", "nulls": "PASS", "orphans": "FAIL", "hash": "FAIL"}
    same = rc.reconcile({"s": tables["s"], "t": tables["s"]}, checks[5:6], run_id="r", as_of="2024-01-01")
    assert same.first().status == "PASS"


def test_gaps_match_lag(frame):
    rng = random.Random(5)
    base = 1_700_000_000
    rows = [(rng.choice("ab"), base + rng.randint(0, 40000)) for _ in range(60)]
    df = frame(rows, "g string, s long").select("g", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "s")
    found = {(x.g, x.gap_seconds) for x in trends.gaps(df, "ts", longer_than_seconds=1800, by=["g"]).collect()}
    expected = set()
    for g in "ab":
        times = sorted(s for name, s in rows if name == g)
        expected |= {(g, float(b - a)) for a, b in zip(times, times[1:]) if b - a > 1800}
    assert found == expected
