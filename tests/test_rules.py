from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import evaluate as ev
from tablewarden.operators import rules as r
from tablewarden.operators import scoring
from tablewarden.operators.rules import Rule

AS_OF = "2024-01-01 00:00:00"


def rule(violation, minimum=100.0, rule_id="R1", dimension="validity", severity="HIGH"):
    return Rule(rule_id, rule_id, "t", dimension, severity, "x", minimum, violation=violation)


def run(df, *rules):
    return {x.rule_id: x for x in ev.evaluate(df, rules, run_id="r", as_of=AS_OF).collect()}


def test_rate_and_status_bands(frame):
    df = frame([(i,) for i in range(1000)], "x int")
    found = run(
        df,
        rule("x < 50", 95, "at"),
        rule("x < 51", 95, "warn"),
        rule("x < 100", 95, "edge"),
        rule("x < 101", 95, "fail"),
    )
    assert [found[k].status for k in ("at", "warn", "edge", "fail")] == ["PASS", "WARN", "WARN", "FAIL"]
    assert found["at"].pass_rate_pct == Decimal("95.0000")


def test_third_and_empty(frame):
    assert run(frame([(1,), (2,), (3,)], "x int"), rule("x = 1"))["R1"].pass_rate_pct == Decimal("66.6667")
    empty = run(frame([], "x int"), rule("x = 1"))["R1"]
    assert (empty.total_rows, empty.pass_rate_pct, empty.status) == (0, Decimal("100.0000"), "PASS")


def test_zero_is_a_legal_minimum(frame):
    assert run(frame([(1,)], "x int"), rule("x = 1", 0))["R1"].status == "PASS"
    assert r.min_pass(0.5) == 99.5


@pytest.mark.parametrize(
    "violation, expected",
    [
        (r.not_in_set("x", ["USD", "EUR"]), 1),
        (r.not_in_set("x", ["USD", "EUR", "ZZZ"], standardize=True), 0),
        (r.is_blank("x"), 2),
        (r.not_matching("x", r"^[A-Z]{3}$"), 0),
        (r.not_matching("x", r"^[a-z]{3}$", ignore_case=False), 3),
    ],
)
def test_text_predicates_and_nulls(frame, violation, expected):
    df = frame([("USD",), ("EUR",), ("ZZZ",), ("",), (None,)], "x string").where("x IS NULL OR x <> '' OR true")
    if "NOT IN" in violation:
        df = df.where("x IS NULL OR x <> ''")
    assert run(df, rule(violation))["R1"].violation_count == expected


def test_number_predicates_and_nulls(frame):
    df = frame([(-1,), (0,), (5,), (66,), (None,)], "x int")
    found = run(
        df,
        rule(r.not_positive("x"), rule_id="pass"),
        rule(r.not_positive("x", null_policy="fail"), rule_id="fail"),
        rule(r.outside_range("x", 0, 65), rule_id="range"),
    )
    assert [found[k].violation_count for k in ("pass", "fail", "range")] == [2, 3, 3]


def test_dates_in_text(frame):
    df = frame([("2023-12-31",), ("2024-06-01",), ("garbage",), (None,)], "x string")
    found = run(
        df, rule(r.after("x", AS_OF), rule_id="a"), rule(r.after("x", AS_OF, null_policy="fail"), rule_id="b")
    )
    assert (found["a"].violation_count, found["b"].violation_count) == (2, 3)


def test_fused_equals_one_by_one(frame):
    df = frame([(i % 7 if i % 5 else None,) for i in range(200)], "x int")
    rules = [rule(f"x > {i}", 50, f"R{i}") for i in range(6)]
    together = run(df, *rules)
    for one in rules:
        assert run(df, one)[one.rule_id] == together[one.rule_id]


def test_uniqueness_ignores_null_keys(frame):
    df = frame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "x string")
    unique = Rule("U", "U", "t", "uniqueness", column="x", key=("x",))
    found = ev.evaluate_tables({"t": df}, [unique], run_id="r", as_of=AS_OF).first()
    assert (found.total_rows, found.violation_count) == (6, 2)


def test_reference_counts_nulls_as_missing(frame):
    child = frame([(1,), (1,), (9,), (9,), (9,), (None,)], "x int")
    parent = frame([(1,), (1,), (2,)], "k int")
    rule_ = Rule("P", "P", "t", "REFERENTIAL", column="x", parent=("p", "k"))
    assert rule_.dimension == "integrity"
    found = ev.evaluate_tables({"t": child, "p": parent}, [rule_], run_id="r", as_of=AS_OF).first()
    assert (found.total_rows, found.violation_count) == (6, 4)


def test_selector_and_inactive(frame):
    df = frame([(1,), (2,), (3,)], "x int")
    chosen = Rule("S", "S", "t", "accuracy", selector=lambda tables: tables["t"].where("x > 1"))
    idle = Rule("I", "I", "t", "accuracy", violation="x > 0", active=False)
    found = ev.evaluate_tables({"t": df}, [chosen, idle], run_id="r", as_of=AS_OF).collect()
    assert [(x.rule_id, x.total_rows, x.violation_count) for x in found] == [("S", 3, 2)]


def test_broken_rules_become_errors_without_a_rate(frame):
    df = frame([(1,), (2,)], "x int")
    found = run(
        df, rule("x = 1", rule_id="ok"), rule("y = 1", rule_id="column"), rule("x >", rule_id="parse"), rule("x", rule_id="kind")
    )
    assert found["ok"].status == "FAIL"
    for name in ("column", "parse", "kind"):
        assert (found[name].status, found[name].pass_rate_pct, found[name].total_rows) == ("ERROR", None, 2)


def test_runtime_failure_is_isolated(spark, frame):
    df = frame([("1",), ("x",)], "x string")
    rules = [
        rule("x = '1'", rule_id="a"),
        rule("CAST(x AS int) > 5", rule_id="bad"),
        rule("x = 'q'", rule_id="c"),
    ]
    found = {x.rule_id: x for x in ev.run_isolated(spark, df, rules, run_id="r", as_of=AS_OF).collect()}
    assert {k: v.status for k, v in found.items()} == {"a": "FAIL", "bad": "ERROR", "c": "PASS"}


def test_run_isolated_when_all_fail(spark, frame):
    df = frame([("x",)], "x string")
    found = ev.run_isolated(spark, df, [rule("CAST(x AS int) > 5")], run_id="r", as_of=AS_OF).collect()
    assert [x.status for x in found] == ["ERROR"]


def test_rule_validation():
    with pytest.raises(ValueError):
        Rule("X", "X", "t", "nonsense", violation="true")
    with pytest.raises(ValueError):
        Rule("X", "X", "t", "validity", severity="WORST", violation="true")
    with pytest.raises(ValueError):
        Rule("X", "X", "t", "validity")


def test_catalog_round_trip(spark):
    rules = [rule("x > 1", 90, "A"), r.custom("B", "t", "x < 0", active=False)]
    back = r.from_catalog(r.catalog(spark, rules))
    assert [(x.rule_id, x.violation, x.min_pass_pct) for x in back] == [("A", "x > 1", 90.0)]


def test_weighted_score_renormalises(frame):
    schema = (
        "run_id string, schema_name string, table_name string, dimension string, pass_rate_pct decimal(7,4), "
        "violation_count long, status string"
    )
    d = Decimal
    rows = [
        ("r", "s", "t", "completeness", d(100), 0, "PASS"),
        ("r", "s", "t", "validity", d(50), 5, "FAIL"),
        ("r", "s", "t", "validity", None, 0, "ERROR"),
        ("r", "s", "u", "integrity", d(10), 9, "FAIL"),
    ]
    found = {x.table_name: x for x in scoring.quality_scores(frame(rows, schema)).collect()}
    assert found["t"].overall_score == d("77.7778")
    assert (found["t"].total_rules_run, found["t"].total_violations) == (3, 5)
    assert (found["u"].overall_score, found["u"].integrity_score) == (d("0.0000"), d("10.0000"))
    status = {x.run_id: x.status for x in scoring.run_status(frame(rows, schema)).collect()}
    assert status == {"r": "FAILED"}


def test_one_scan_for_all_row_rules(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    rules = [rule(f"l_quantity > {i}", rule_id=f"R{i}") for i in range(20)]
    plan = ev.evaluate(df, rules, run_id="r", as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_slices(frame):
    df = frame([("a", 1), ("a", 2), ("b", 3)], "g string, x int")
    found = ev.evaluate(df, [rule("x > 1")], run_id="r", as_of=AS_OF, slice_by=[F.col("g")]).collect()
    assert {x.g: (x.total_rows, x.violation_count) for x in found} == {"a": (2, 1), "b": (1, 1)}
