import json
import random

import pytest
from pyspark.sql import functions as F

from tablewarden.operators.change_feed import feed_audit, replayed

SCHEMA = "k string, seq bigint, op string, a int, key string, at timestamp_ntz, who string"


def trigger(rows):
    """What a trigger on every row writes: (key, action, old, new, changed)."""
    table, out = {}, []
    for k, _, op, a, b, _, who in sorted(rows, key=lambda r: r[1]):
        old, new = table.get(k), None if op == "D" else {"a": a, "key": b}
        if old is None and new is None:
            continue
        changed = [c for c in ("a", "key") if old and new and old[c] != new[c]]
        table[k] = new
        if old is None or new is None or changed:
            action = "INSERT" if old is None else "DELETE" if new is None else "UPDATE"
            out.append((str(k), action, old, new, changed or None, who))
    return sorted(out, key=repr)


def audited(df, **options):
    found = feed_audit(
        df, "k", "seq", deletes=F.col("op") == "D", columns=["a", "key"], table="t", event_time="at", user="who", **options
    ).collect()
    return sorted(
        ((str(r.row_pk), r.action, r.old_row and json.loads(r.old_row), r.new_row and json.loads(r.new_row), r.changed_cols, r.db_user) for r in found),
        key=repr,
    )


@pytest.mark.parametrize("ranges", [2, 5, 64])
def test_each_change_is_audited_as_by_a_trigger(frame, ranges):
    draw = random.Random(ranges)
    rows = []
    for seq in range(400):  # one key has a third of the changes, some keys are NULL
        k = "hot" if draw.random() < 0.33 else draw.choice([None, "b", "c", "d", f"e{seq}"])
        rows.append((k, seq, draw.choice("IUUUD"), draw.choice([1, 2, None]), draw.choice(["x", None]), None, f"u{seq % 3}"))
    assert audited(frame(rows, SCHEMA), ranges=ranges) == trigger(rows)


def test_insert_update_update_delete(frame):
    rows = [("k", s, op, a, "x", None, "me") for s, (op, a) in enumerate([("I", 1), ("U", 2), ("U", 3), ("D", None)])]
    assert [(x[1], x[2] and x[2]["a"], x[3] and x[3]["a"]) for x in sorted(audited(frame(rows, SCHEMA), ranges=3), key=lambda x: (x[2] or {"a": 0})["a"])] == [
        ("INSERT", None, 1), ("UPDATE", 1, 2), ("UPDATE", 2, 3), ("DELETE", 3, None)]


def test_repeated_rows_ties_and_empty_feeds(frame):
    one = ("k", 1, "I", 1, "x", None, "me")
    assert audited(frame([one, one, one], SCHEMA)) == trigger([one])
    gone = ("k", 2, "D", None, None, None, "me")
    assert audited(frame([one, gone, gone], SCHEMA)) == trigger([one, gone])
    assert audited(frame([], SCHEMA)) == []
    unplaced = [("k", None, "I", 1, "x", None, "me"), ("k", 0, "U", 2, "x", None, "me")]  # a change without a place comes first
    assert [x[1] for x in audited(frame(unplaced, SCHEMA))] == ["INSERT", "UPDATE"]


def test_changes_of_a_hot_key_are_dealt(spark, frame):
    feed = spark.range(3000).selectExpr("'hot' AS k", "id AS seq", "'U' AS op", "CAST(id AS int) AS a", "'x' AS key", "CAST(NULL AS timestamp_ntz) AS at", "'me' AS who")
    found = replayed(feed, "k", "seq", deletes=F.lit(False), columns=["a"], ranges=30)
    assert found.where("o.a IS DISTINCT FROM n.a - 1").count() == 1  # the first change only
    assert "part" in found._jdf.queryExecution().optimizedPlan().toString()
