"""Plans that must hold on large and skewed tables."""

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import dedup, evaluate, governance, publish, quarantine, reconcile
from tablewarden.operators.rules import Rule

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lines(spark):
    return spark.read.parquet(f"{SMALL}/lineitem.parquet")


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SMALL}/orders.parquet")


def no_pairs(text):
    return "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_capture_does_not_shuffle(orders):
    rules = [Rule(f"R{i}", "x", "orders", "validity", violation=f"o_totalprice > {i}") for i in range(5)]
    text = plan(quarantine.quarantine(orders, rules, key=["o_orderkey"], run_id="r", as_of="2024-01-01 00:00:00", unique_key=True))
    assert "Exchange" not in text and text.count("FileScan") == 1


def test_references_are_counted_before_the_join(lines, orders):
    rule = Rule("R", "R", "l", "integrity", column="l_orderkey", parent=("o", "o_orderkey"))
    text = plan(evaluate.evaluate_tables({"l": lines, "o": orders}, [rule], run_id="r", as_of="2024-01-01 00:00:00"))
    assert no_pairs(text)
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    # deepest first: scan, partial count, exchange, count, join
    assert text.index("Join") < text.index("partial_count(1)")


def test_diff_and_audit_never_join(orders):
    diff = plan(reconcile.keyed_diff(orders, orders, ["o_orderkey"], ["o_totalprice"]))
    audit = plan(governance.change_audit(orders, orders, "o_orderkey", table="o", as_of="2024-01-01 00:00:00"))
    assert "Join" not in diff and "Join" not in audit


def test_first_rows_are_limited_before_the_shuffle(lines):
    text = plan(dedup.keep_first(lines, ["l_orderkey"], ["l_shipdate"]))
    assert text.count("WindowGroupLimit") == 2


def test_numbers_need_no_global_sort(orders):
    text = plan(publish.number_rows(orders, F.col("o_orderkey"), "sk"))
    # the one window without partitions runs over the table of range sizes
    single = [line for line in text.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) == 1 and "rangepartitioning" not in text


def test_hot_key_results(spark):
    """A third of the rows on one key, for counting, first rows and surplus rows."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("v")
    )
    unique = Rule("U", "U", "t", "uniqueness", key=("k",))
    found = evaluate.evaluate_tables({"t": df}, [unique], run_id="r", as_of="2024-01-01 00:00:00").first()
    assert (found.total_rows, found.violation_count) == (30000, 9999)
    assert dedup.keep_first(df, ["k"], ["v"]).count() == 20001
    surplus = dedup.surplus_rows(df, ["k"], ["v"])
    assert surplus.count() == 9999
    assert surplus.where("k <> 0").count() == 0
    kept = dedup.keep_first(df, ["k"], ["v"])
    assert kept.unionByName(surplus).exceptAll(df).count() == 0


def test_orphans_with_a_hot_missing_reference(spark):
    child = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k")
    )
    parent = spark.range(9000).select(F.col("id").alias("p"))
    rule = Rule("P", "P", "c", "integrity", column="k", parent=("p", "p"))
    tables = {"c": child, "p": parent}
    rows = quarantine.rule_rows(tables, rule)
    counted = evaluate.evaluate_tables(tables, [rule], run_id="r", as_of="2024-01-01 00:00:00").first()
    assert rows.count() == counted.violation_count == 6000
    assert no_pairs(plan(rows))


def test_statistics_meet_rows_without_cross_join_or_hot_group(spark, monkeypatch):
    from tablewarden.operators import attach, trends
    from tablewarden.operators.quantiles import exact_percentiles

    rows = spark.createDataFrame([("a", float(i)) for i in range(50)] + [("b", 1.0)], "g string, v double")
    probs = {"p50": 0.5}
    for by in ([], ["g"]):
        text = plan(exact_percentiles(rows, "v", probs, by))
        assert "CartesianProduct" not in text
    assert "hashpartitioning(g" not in plan(trends.zscore_rows(rows, "v", by=["g"])).split("BroadcastExchange")[0]
    few = sorted((x.g, x.p50) for x in exact_percentiles(rows, "v", probs, ["g"]).collect())
    flagged = trends.zscore_rows(rows, "v", by=["g"], limit=1.5).count()
    monkeypatch.setattr(attach, "FEW", 1)
    assert sorted((x.g, x.p50) for x in exact_percentiles(rows, "v", probs, ["g"]).collect()) == few == [("a", 24.5), ("b", 1.0)]
    salted = trends.zscore_rows(rows, "v", by=["g"], limit=1.5)
    assert salted.count() == flagged and "_salt" in plan(salted)
