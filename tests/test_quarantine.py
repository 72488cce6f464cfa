import json

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import dedup
from tablewarden.operators import quarantine as q
from tablewarden.operators.rules import Rule

NOW = "2024-01-10 00:00:00"


def rule(rule_id, violation, severity="HIGH"):
    return Rule(rule_id, f"name {rule_id}", "t", "validity", severity, violation=violation)


RULES = [rule("A", "x > 1"), rule("B", "x > 2", "LOW"), rule("C", "s = 'z'")]


def test_capture_once_per_broken_rule(frame):
    df = frame([(1, 1, "z"), (2, 3, None), (3, None, "a"), (None, 2, "b")], "id int, x int, s string")
    rows = q.quarantine(df, RULES, key=["id"], run_id="r", as_of=NOW).collect()
    assert sorted((r.rule_id, r.business_key) for r in rows if r.business_key) == [("A", "2"), ("B", "2"), ("C", "1")]
    assert [r.business_key for r in rows].count(None) == 1  # a NULL key stays NULL
    two = next(r for r in rows if r.rule_id == "B")
    assert json.loads(two.payload) == {"id": 2, "x": 3, "s": None}
    assert (two.failure_reason, two.severity, two.status) == ("B — name B", "LOW", "OPEN")
    again = q.quarantine(df, RULES, key=["id"], run_id="r", as_of=NOW)
    assert {r.quarantine_id for r in again.collect()} == {r.quarantine_id for r in rows}
    assert len({r.quarantine_id for r in rows}) == len(rows)


def test_split_is_a_partition(frame):
    df = frame([(i % 5 if i % 3 else None, "z" if i % 4 == 0 else None) for i in range(60)], "x int, s string")
    clean, bad = q.split(df, RULES)
    assert clean.count() + bad.count() == 60
    assert clean.exceptAll(df).count() == bad.exceptAll(df).count() == 0
    assert bad.count() == df.where("coalesce(x > 1, false) OR coalesce(s = 'z', false)").count()


@pytest.mark.parametrize("copies", [1, 2, 500])
def test_surplus_against_brute_force(spark, copies):
    rows = [("a", 1, "x")] * copies + [("a", 2, "x"), ("b", 1, "y"), (None, 1, "n"), (None, 1, "n"), ("c", 5, "q"), ("c", 5, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(4)
    surplus = sorted(map(tuple, dedup.surplus_rows(df, ["k"], ["o"]).collect()), key=str)
    expected = [("a", 1, "x")] * (copies - 1) + [("a", 2, "x"), ("c", 5, "q")]
    assert surplus == sorted(expected, key=str)
    kept = dedup.keep_first(df.where("k IS NOT NULL"), ["k"], ["o"])
    assert kept.count() + len(surplus) == df.where("k IS NOT NULL").count()


def test_selected_rows_equal_the_violations(spark, frame):
    tables = {
        "t": frame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "id int, p string"),
        "p": frame([("a",), ("a",)], "p string"),
    }
    unique = Rule("U", "U", "t", "uniqueness", key=("id",))
    parent = Rule("P", "P", "t", "integrity", column="p", parent=("p", "p"))
    count = lambda r: q.quarantine_selected(tables, r, key=["id"], run_id="r", as_of=NOW).count()
    assert (count(unique), count(parent)) == (1, 2)


def bad(frame, rows):
    df = frame(
        rows, "quarantine_id string, severity string, status string, quarantined_at string, assigned_to string"
    )
    return df.withColumns(
        {
            "quarantined_at": F.col("quarantined_at").cast("timestamp_ntz"),
            "resolved_at": F.lit(None).cast("timestamp_ntz"),
            "resolution_note": F.lit("old"),
            "schema_name": F.lit("s"),
            "table_name": F.lit("t"),
            "rule_id": F.lit("A"),
            "data_domain": F.lit("d"),
        }
    )


def test_clocks_are_strict(frame):
    rows = [
        ("1", "CRITICAL", "OPEN", "2024-01-09 20:00:00", None), ("2", "CRITICAL", "OPEN", "2024-01-09 19:59:59", None),
        ("3", "HIGH", "IN_REVIEW", "2024-01-08 23:59:59", None), ("4", "LOW", "OPEN", "2024-01-04 00:00:00", None),
        ("5", "MEDIUM", "FIXED", "2023-01-01 00:00:00", None), ("6", "MEDIUM", "OPEN", "2024-01-06 00:00:00", None),
    ]
    late = q.sla_breaches(bad(frame, rows), as_of=NOW).collect()
    assert {r.quarantine_id for r in late} == {"2", "3", "6"}
    assert {r.quarantine_id: r.open_seconds for r in late}["2"] == 14401.0


def test_age_buckets(frame):
    rows = [
        ("1", "LOW", "OPEN", "2024-01-09 00:00:01", None), ("2", "LOW", "OPEN", "2024-01-09 00:00:00", None),
        ("3", "LOW", "OPEN", "2024-01-03 00:00:00", None), ("4", "LOW", "OPEN", "2024-01-02 23:59:59", None),
    ]
    found = q.backlog(bad(frame, rows), as_of=NOW).first()
    assert (found.open_rows, found.lt_1d, found.d1_7, found.gt_7d) == (4, 1, 2, 1)


def test_actions(frame):
    rows = [(str(i), "HIGH", "OPEN", "2024-01-09 00:00:00", "old" if i == 3 else None) for i in range(1, 6)]
    actions = frame(
        [
            ("1", "assign", "ann", "look", "2024-01-09 01:00:00"),
            ("1", "fix", None, "done", "2024-01-09 02:00:00"),
            ("2", "fix", None, None, "2024-01-09 01:00:00"),
            ("2", "assign", "bob", None, "2024-01-09 02:00:00"),
            ("3", "ignore", None, "skip", "2024-01-09 01:00:00"),
            ("4", "unknown", None, None, "2024-01-09 01:00:00"),
            ("9", "fix", None, None, "2024-01-09 01:00:00"),
        ],
        "quarantine_id string, action string, assignee string, note string, acted_at string",
    ).withColumn("acted_at", F.col("acted_at").cast("timestamp_ntz"))
    rows, log = q.apply_actions(bad(frame, rows), actions, user="me")
    found = {r.quarantine_id: r for r in rows.collect()}
    assert [found[k].status for k in "12345"] == ["FIXED", "IN_REVIEW", "IGNORED", "OPEN", "OPEN"]
    assert [found[k].assigned_to for k in "1234"] == ["ann", "bob", "old", None]
    assert [found[k].resolution_note for k in "1245"] == ["done", None, "old", "old"]
    assert [str(found[k].resolved_at)[11:16] for k in "123"] == ["02:00", "01:00", "01:00"]
    moves = {r.quarantine_id: (r.old_status, r.new_status, r.actor) for r in log.collect()}
    assert moves == {"1": ("OPEN", "FIXED", "ann"), "2": ("OPEN", "IN_REVIEW", "bob"), "3": ("OPEN", "IGNORED", "old")}


def test_an_action_without_effect_is_not_logged(frame):
    rows = bad(frame, [("1", "HIGH", "FIXED", "2024-01-09 00:00:00", None)])
    actions = frame([("1", "fix", None, "x", "2024-01-09 01:00:00")], "quarantine_id string, action string, assignee string, note string, acted_at string")
    _, log = q.apply_actions(rows, actions.withColumn("acted_at", F.col("acted_at").cast("timestamp_ntz")))
    assert log.count() == 0


def test_lists(frame):
    rows = bad(
        frame,
        [("1", "LOW", "OPEN", "2024-01-03 00:00:00", None), ("2", "CRITICAL", "OPEN", "2024-01-01 00:00:00", None),
         ("3", "CRITICAL", "FIXED", "2024-01-02 00:00:00", None)],
    ).withColumns({"failure_reason": F.lit("r" * 80), "business_key": F.lit("k")})
    assert [r.quarantine_id for r in q.listing(rows, limit=2).collect()] == ["1", "3"]
    assert [r.quarantine_id for r in q.listing(rows, severity="CRITICAL", status="OPEN").collect()] == ["2"]
    assert len(q.listing(rows).first().reason) == 60
    assert [r.quarantine_id for r in q.triage(rows).collect()] == ["2", "1"]


def test_crowded_keys_get_the_ids_of_a_single_ranking(spark, monkeypatch):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 1, F.lit("same")).otherwise((F.col("id") % 1500).cast("string")).alias("v"),
    )
    rules = [Rule("H", "hot", "t", "validity", violation="v <> ''"), Rule("S", "same", "t", "validity", violation="v = 'same'")]

    def ids():
        found = q.quarantine(rows, rules, key=["k"], run_id="r", as_of=NOW)
        assert found.count() == 4000
        return sorted((x.quarantine_id, x.rule_id, x.business_key or "", x.payload) for x in found.collect())

    plainly = ids()
    assert len({x[0] for x in plainly}) == 4000
    monkeypatch.setattr(q, "CROWD", 50)
    monkeypatch.setattr(q, "CHUNK", 64)
    assert ids() == plainly
    rows = rows.repartition(7)
    assert ids() == plainly


@pytest.mark.parametrize("crowd", [10_000, 3])
def test_row_and_key_rules_of_a_table_are_captured_together(spark, monkeypatch, crowd):
    monkeypatch.setattr(q, "CROWD", crowd)
    rows = spark.range(90).select(
        F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 17).alias("k"), (F.col("id") % 2).cast("int").alias("l"),
        F.when(F.col("id") % 4 == 0, "x").otherwise(F.col("id").cast("string")).alias("v"),
    )
    by_row = [Rule("X", "x", "t", "validity", violation="v = 'x'"), Rule("L", "l", "t", "validity", violation="l = 1")]
    by_key = Rule("U", "unique", "t", "uniqueness", key=("l", "k"))
    given = dict(key=["k", "l"], run_id="r", as_of=NOW)
    assert q.shares_key(rows, by_key, ["k", "l"]) and not q.shares_key(rows, by_key, ["k"])

    def shown(df):
        return sorted((x.quarantine_id, x.rule_id, x.business_key, x.payload) for x in df.collect())

    together = shown(q.quarantine_table(rows, [*by_row, by_key], **given))
    apart = shown(q.quarantine(rows, by_row, **given)) + shown(q.quarantine_selected({"t": rows}, by_key, **given))
    assert together == sorted(apart) and len({x[0] for x in together}) == len(together)


def test_records_are_made_where_rows_arrive(spark):
    """What is shuffled are rows; neither payloads nor ids travel."""
    rows = spark.range(20).select((F.col("id") % 5).alias("k"), F.col("id").cast("string").alias("v"))
    found = q.quarantine(rows, [Rule("A", "a", "t", "validity", violation="v <> '3'")], key=["k"], run_id="r", as_of=NOW)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(")
    assert len(plan) == 2 and "_digest" in plan[0] and "_digest" not in plan[1]
