import datetime as dt
import uuid

from tablewarden.operators import runs
from tablewarden.operators import rules as r
from tablewarden.operators.reconcile import Check
from tablewarden.operators.rules import Rule
from tablewarden.session import work_folder

AS_OF = "2024-05-01 08:00:00"


def test_stages_share_a_run_and_can_be_repeated(spark, frame):
    folder = f"{work_folder(spark)}/test-run-{uuid.uuid4().hex[:8]}"
    orders = frame(
        [(1, "USD", 10), (2, "ZZZ", 20), (3, None, -5), (3, "EUR", 5), (4, "EUR", 0)], "id int, currency string, total int"
    )
    tables = {"orders": orders, "target": orders.where("id <> 2"), "items": frame([(1, 1), (2, 9)], "item int, id int")}
    rules = [
        Rule("R1", "currency", "orders", "validity", "HIGH", "currency", violation=r.not_in_set("currency", ["USD", "EUR"])),
        Rule("R2", "total", "orders", "accuracy", "LOW", "total", violation=r.not_positive("total")),
        Rule("R3", "ids", "orders", "uniqueness", "CRITICAL", "id", key=("id",)),
        Rule("R4", "items", "items", "referential", "CRITICAL", "id", parent=("orders", "id")),
        Rule("R5", "fine", "orders", "completeness", "LOW", "id", violation=r.is_null("id")),
    ]
    checks = [Check(1, "rows", "row_count", "orders", "target", tolerance_pct=50), Check(2, "sum", "sum_check", "orders", "target", measure="total")]
    keys = {"orders": ["id"], "items": ["item"]}
    ended = "2024-05-01 08:01:00"
    for _ in range(2):
        headers = [
            runs.run_rules(spark, tables, rules, folder, run_id="n1", as_of=AS_OF, ended_at=ended),
            runs.run_profile(spark, {"orders": orders}, folder, run_id="n1", as_of=AS_OF),
            runs.run_recon(spark, tables, checks, folder, run_id="n1", as_of=AS_OF),
            runs.run_quarantine(spark, tables, rules, keys, folder, run_id="n1", as_of=AS_OF),
        ]
    found = [h.first() for h in headers]
    assert [(h.run_type, h.status) for h in found] == [
        ("RULES", "COMPLETED_WITH_FAILURES"), ("PROFILE", "SUCCESS"), ("ETL_RECON", "COMPLETED_WITH_FAILURES"),
        ("QUARANTINE", "SUCCESS"),
    ]
    assert {h.run_id for h in found} == {"n1"}
    assert found[0].ended_at - found[0].started_at == dt.timedelta(minutes=1)
    results = spark.read.parquet(f"{folder}/rule_results")
    counts = {x.rule_id: x.violation_count for x in results.collect()}
    assert counts == {"R1": 1, "R2": 2, "R3": 1, "R4": 1, "R5": 0}
    bad = spark.read.parquet(f"{folder}/bad_rows").groupBy("rule_id").count().collect()
    assert {x.rule_id: x["count"] for x in bad} == {k: v for k, v in counts.items() if v}
    assert found[3].notes == "rules=4 quarantined=5"
    assert spark.read.parquet(f"{folder}/quality_scores").count() == 2
    assert spark.read.parquet(f"{folder}/profile_results").count() == 3


def test_one_table_only(spark, frame):
    folder = f"{work_folder(spark)}/test-run-{uuid.uuid4().hex[:8]}"
    rules = [r.custom("A", "a", "x > 1"), r.custom("B", "b", "x > 1")]
    tables = {n: frame([(1,)], "x int") for n in "ab"}
    header = runs.run_rules(spark, tables, rules, folder, run_id="n1", as_of=AS_OF, table="b").first()
    assert (header.status, header.notes) == ("SUCCESS", "rules=1 fail=0 error=0")
