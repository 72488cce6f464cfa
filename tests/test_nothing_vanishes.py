"""NULL groups, repeated keys and columns named like inner ones."""

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import attach as at
from tablewarden.operators import dedup, publish, quantiles, quarantine, trends
from tablewarden.operators.rules import Rule

SCHEMA = "g string, v double, group_mean int, _mean int, _v2 string"


def groups(frame):
    rows = [(g, 1.0 + i % 2, 7, 8, "x") for g in ("a", None) for i in range(30)] + [("a", 99.0, 7, 8, "x"), (None, 99.0, 7, 8, "x")]
    return frame(rows, SCHEMA)


@pytest.mark.parametrize("few", [10_000, 0])
def test_statistics_of_the_null_group(frame, monkeypatch, few):
    monkeypatch.setattr(at, "FEW", few)
    df = groups(frame)
    found = trends.zscore_rows(df, "v", by=["g"])
    assert {(r.g, r.v, r._mean, round(r.group_mean, 3)) for r in found.collect()} == {("a", 99.0, 8, 4.645), (None, 99.0, 8, 4.645)}
    assert {(r.g, r.row_count, r.above) for r in trends.outlier_counts(df, "v", by=["g"]).collect()} == {("a", 31, 1), (None, 31, 1)}
    assert {(r.g, r.p) for r in quantiles.exact_percentiles(df, "v", {"p": 0.5}, ["g"]).collect()} == {("a", 2.0), (None, 2.0)}


def test_columns_named_like_inner_ones_stay(frame):
    df = frame([(1, 1, 5, 0, 0), (1, 2, 6, 0, 0), (1, 2, 6, 0, 0), (2, 1, 7, 0, 0)], "k int, ts int, _rank int, _part int, _copies int")
    assert sorted(tuple(r) for r in dedup.latest_per_key(df, ["k"], "ts").collect()) == [(1, 2, 6, 0, 0), (2, 1, 7, 0, 0)]
    assert sorted(tuple(r) for r in dedup.surplus_rows(df, ["k"], ["ts"]).collect()) == [(1, 2, 6, 0, 0), (1, 2, 6, 0, 0)]
    named = frame([("a", 1, 2, 3)], "_key string, _range int, _start int, _wanted int")
    assert publish.number_rows(named, F.col("_key"), "sk").first().asDict() == {"_key": "a", "_range": 1, "_start": 2, "_wanted": 3, "sk": 1}


def test_very_many_copies_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(dedup, "CHUNK", 7)
    df = spark.range(100).select(F.lit(1).alias("k"), F.lit("x").alias("v")).repartition(3)
    found = dedup.surplus_rows(df, ["k"], ["v"])
    assert found.count() == 99 and found.distinct().count() == 1


def test_ids_are_unique_by_default(frame):
    rule = Rule("R", "R", "t", "validity", violation="v > 0")
    df = frame([(1, 1, 0), (1, 2, 0), (1, 2, 0), (None, 3, 0), (None, 3, 0), (2, 1, 0)], "k int, v int, _nth int")
    found = quarantine.quarantine(df, [rule], key=["k"], run_id="r", as_of="2024-01-01 00:00:00")
    assert found.select("quarantine_id").distinct().count() == found.count() == 6
    alone = quarantine.quarantine(df.where("k = 2"), [rule], key=["k"], run_id="r", as_of="2024-01-01 00:00:00", unique_key=True)
    assert alone.first().quarantine_id in {r.quarantine_id for r in found.collect()}
