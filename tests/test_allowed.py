import pytest
from pyspark.sql import functions as F

from tablewarden.operators import allowed, evaluate, incremental, quarantine
from tablewarden.operators import rules as r
from tablewarden.operators.rules import Rule

AS_OF = "2024-05-01 08:00:00"


def counted(df, column, values, **options):
    return tuple(allowed.counts(df, column, values, **options).first())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [allowed.MOST, 0])
def test_counts_and_rows_equal_a_plain_search(spark, frame, most):
    rows = [(i, None if i % 11 == 0 else f"v{i % 700}") for i in range(3000)]
    df = frame(rows, "id int, code string")
    listed = {f"v{i}" for i in range(0, 700, 3)}
    values = allowed.allowed_values(frame([(v,) for v in listed] * 2 + [(None,)], "code string"), "code")
    stray = [i for i, code in rows if code is not None and code not in listed]
    assert counted(df, "code", values, most=most) == (3000, len(stray))
    assert sorted(x.id for x in allowed.stray_rows(df, "code", values, most=most).collect()) == stray


def test_filter_keeps_what_is_listed_and_rejects_most_of_the_rest(spark):
    values = spark.range(0, 40_000, 2).select(F.col("id").alias("value"))
    rows, value, sure = allowed.screened(spark.range(40_000), "id", values)
    rejected = {bool(x.odd): x.n for x in rows.where(sure).groupBy((F.col(value) % 2 == 1).alias("odd")).agg(F.count("*").alias("n")).collect()}
    assert False not in rejected
    assert rejected[True] > 19_000


def test_ten_million_values_need_no_list_and_no_unchecked_broadcast(spark):
    values = allowed.allowed_values(spark.range(0, 20_000_000, 2), "id")
    df = spark.range(0, 400_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 40).alias("code"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # what is broadcast now, is broadcast on purpose
    try:
        found = allowed.counts(df, "code", values)
        text = plan(found)
        beyond = plan(allowed.counts(df, "code", values, most=1 << 20))
        assert tuple(found.first()) == (400_000, 133_334)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 1 and "BroadcastExchange" not in beyond
    assert " IN (" not in text and "INSET" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_odd_inputs(spark, frame):
    none = allowed.allowed_values(frame([(None,)], "x int"), "x")
    some = allowed.allowed_values(frame([(0.0,), (float("nan"),)], "x double"), "x")
    assert counted(frame([(1,), (None,)], "x int"), "x", none) == (2, 1)  # nothing is allowed
    assert counted(frame([], "x int"), "x", none) == (0, 0)
    assert counted(frame([(-0.0,), (float("nan"),), (1.5,)], "x double"), "x", some) == (3, 1)
    with pytest.raises(ValueError, match="cast one of them"):
        allowed.counts(frame([(1,)], "x bigint"), "x", none)
    clashing = frame([(1, 2, 3, 4), (5, 6, 7, 8)], "_value int, _sure int, _filter_part int, value int")
    values = allowed.allowed_values(frame([(4,)], "x int"), "x")
    assert [tuple(x) for x in allowed.stray_rows(clashing, "value", values).collect()] == [(5, 6, 7, 8)]
    assert counted(clashing, "value", values) == (2, 1)
    long = "x" * 3_000_000
    values = allowed.allowed_values(frame([(long,), ("",)], "x string"), "x")
    assert counted(frame([(long,), (long + "y",), ("",), (" ",)], "x string"), "x", values) == (4, 2)


def test_rule_in_results_catalogue_and_quarantine(spark, frame):
    rule = Rule("A1", "currency is listed", "orders", "validity", "HIGH", "currency", 50, allowed=("currencies", "code"))
    tables = {
        "orders": frame([(1, "USD"), (2, "ZZZ"), (2, "ZZZ"), (3, None)], "id int, currency string"),
        "currencies": frame([("USD",), ("EUR",)], "code string"),
    }
    stored = r.from_catalog(r.catalog(spark, [rule]))
    assert stored == [rule]
    found = evaluate.evaluate_tables(tables, stored, run_id="n", as_of=AS_OF).first()
    assert (found.total_rows, found.violation_count, found.status) == (4, 2, "PASS")
    bad = quarantine.quarantine_selected(tables, rule, key=["id"], run_id="n", as_of=AS_OF).collect()
    assert len(bad) == 2 and len({x.quarantine_id for x in bad}) == 2
    with pytest.raises(ValueError, match="give one of"):
        Rule("A2", "two", "orders", "validity", "HIGH", "currency", violation="true", allowed=("currencies", "code"))
    with pytest.raises(ValueError, match="whole tables"):
        incremental.add_load(spark, "unused", {}, [rule], "1")
