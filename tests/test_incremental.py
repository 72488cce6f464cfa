import uuid

import pytest

from tablewarden.operators import evaluate as ev
from tablewarden.operators import incremental as inc
from tablewarden.operators.rules import Rule, SqlSelector
from tablewarden.session import work_folder

RULES = [
    Rule("A1", "amount", "orders", "accuracy", violation="amount <= 0", min_pass_pct=80),
    Rule("A2", "unique", "orders", "uniqueness", key=("id",)),
    Rule("A3", "pair", "orders", "uniqueness", key=("id", "amount")),
    Rule("A4", "has customer", "orders", "integrity", column="customer", parent=("customers", "id")),
    Rule("A5", "idle", "orders", "accuracy", violation="true", active=False),
    Rule("A6", "named", "customers", "completeness", violation="name IS NULL"),
]
ORDERS, CUSTOMERS = "id string, customer string, amount int", "id string, name string"
LOADS = [
    {"orders": [("1", "c1", 5), ("1", "c1", 5), (None, "c2", 1), ("2", None, 0)], "customers": [("c1", "x"), (None, None)]},
    {"orders": [("1", "c9", 5), ("3", "c2", -1), (None, "c1", 2), ("x" * 300, "c9", 3)], "customers": [("c2", None)]},
    {"orders": [("x" * 300, "c9", 3), ("4", "c3", 9), ("2", "c1", 0)]},
]


def frames(frame, load):
    kinds = {"orders": ORDERS, "customers": CUSTOMERS}
    return {t: frame(rows, kinds[t]) for t, rows in load.items()}


def shown(found):
    return {r.rule_id: (r.rule_name, r.total_rows, r.violation_count, r.pass_rate_pct, r.status, r.min_pass_pct) for r in found.collect()}


def test_loads_equal_a_full_evaluation(spark, frame):
    folder = f"{work_folder(spark)}/loads-{uuid.uuid4().hex[:8]}"
    so_far = {"orders": [], "customers": []}
    for k, own in enumerate([0, 1, 2, 2, 0]):  # two of them are added again
        load = LOADS[own]
        inc.add_load(spark, folder, frames(frame, load), RULES, f"load {own}")
        if k < 3:
            for t, rows in load.items():
                so_far[t] += rows
        full = ev.evaluate_tables(frames(frame, so_far), RULES, run_id="r", as_of="2024-01-01 00:00:00")
        got = inc.results(spark, folder, RULES, run_id="r", as_of="2024-01-01 00:00:00")
        assert shown(got) == shown(full) and got.schema.names == full.schema.names, k
    per_load = {(r.load_id, r.rule_id): (r.total_rows, r.violation_count) for r in inc.loads(spark, folder).collect()}
    assert per_load["load 1", "A1"] == (4, 1) and per_load["load 2", "A2"] == (3, 2) and len(per_load) == 14


def test_nothing_loaded_and_empty_loads(spark, frame):
    folder = f"{work_folder(spark)}/loads-{uuid.uuid4().hex[:8]}"
    zero = {r: v[1:5] for r, v in shown(inc.results(spark, folder, RULES, run_id="r", as_of="2024-01-01 00:00:00")).items()}
    assert {v[:2] for v in zero.values()} == {(0, 0)} and {v[3] for v in zero.values()} == {"PASS"} and len(zero) == 5
    inc.add_load(spark, folder, frames(frame, {"orders": [], "customers": []}), RULES, "a")
    assert {v[1:3] for v in shown(inc.results(spark, folder, RULES, run_id="r", as_of="2024-01-01 00:00:00")).values()} == {(0, 0)}


def test_selectors_are_refused(spark):
    rule = Rule("S", "s", "orders", "validity", selector=SqlSelector("SELECT * FROM {orders}"))
    with pytest.raises(ValueError, match="whole tables"):
        inc.add_load(spark, "/nowhere", {}, [rule], "a")
