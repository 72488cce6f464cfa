"""Cases in which rows, labels or differences used to get lost."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewarden.operators import evaluate as ev
from tablewarden.operators import governance, publish, reconcile, scoring
from tablewarden.operators import quarantine as q
from tablewarden.operators import reports as rp
from tablewarden.operators import rules as r
from tablewarden.operators.rules import Rule
from tablewarden.sources import writers
from tablewarden.streaming import sinks

AS_OF = "2024-01-01 00:00:00"


def rule(violation, rule_id="R1", **options):
    return Rule(rule_id, options.pop("name", rule_id), "t", "validity", violation=violation, **options)


def test_all_labels_are_kept(frame):
    got = scoring.ordered_labels(frame([("k", "zz"), ("k", "a"), ("k", None), ("k", "a"), ("n", None)], "k string, v string"), ["k"], "v", "vs")
    assert {x.k: x.vs for x in got.collect()} == {"k": "a,zz", "n": ""}


def test_slices_keep_their_names(frame):
    df = frame([("a", 1, 1), ("b", 1, 2)], "bad_flag string, total int, _total int")
    got = ev.evaluate(df, [rule("bad_flag = 'a'")], run_id="r", as_of=AS_OF, slice_by=["bad_flag", "total", "_total"])
    assert sorted((x.bad_flag, x.total, x._total, x.violation_count) for x in got.collect()) == [("a", 1, 1, 1), ("b", 1, 2, 0)]


def test_one_bad_row_of_many_is_no_pass(frame):
    counts = frame([(10_000_000, 1, 100.0), (10_000_000, 0, 100.0), (3_000_000_000, 2, 99.9999), (0, 0, 100.0), (20, 2, 95.0), (1000, 101, 95.0)],
                   "total_rows bigint, violation_count bigint, min_pass_pct decimal(7,4)".replace("decimal(7,4)", "double"))
    counts = counts.withColumn("min_pass_pct", F.col("min_pass_pct").cast("decimal(7,4)")).withColumn("error_msg", F.lit(None).cast("string"))
    got = {(x.total_rows, x.violation_count): x.status for x in ev.graded(counts, run_id="r", as_of=AS_OF).collect()}
    assert list(got.values()) == ["WARN", "PASS", "PASS", "PASS", "WARN", "FAIL"]


def test_one_lost_row_of_many_is_no_pass(frame):
    values = frame([(300_000_000, 299_999_999, 0.0), (300_000_000, 299_999_999, 0.01), (0, 0, 0.0), (0, 1, 50.0)],
                   "source_value bigint, target_value bigint, tolerance_pct double")
    assert [x.status for x in reconcile.compared(values).collect()] == ["FAIL", "WARN", "PASS", "FAIL"]


def test_row_texts_and_filtered_fingerprints(frame):
    source = frame([(1, "a|b", "c"), (2, None, "x"), (3, "", "y")], "id int, p string, q string")
    target = frame([(1, "a", "b|c"), (2, "~", "x"), (3, None, "y")], "id int, p string, q string")
    got = reconcile.row_hash_check(source, target, ["id"], ["p", "q"]).first()
    assert (got.matched, got.mismatched) == (0, 3)
    same = frame([(1, "a|b", "c"), (9, "other", "row")], "id int, p string, q string")
    job = reconcile.Check(1, "j", "hash_check", "s", "t", measure="id,p,q", source_where="id = 1", target_where="id = 1")
    found = reconcile.reconcile({"s": source, "t": same}, [job], run_id="r", as_of=AS_OF).first()
    assert found.status == "PASS" and found.source_value > 2**32


def test_a_repeated_run_without_rows_clears_its_partition(spark, frame, tmp_path):
    rows = frame([(1,), (2,)], "x int")
    path = str(tmp_path / "evidence")
    writers.write_evidence(rows, path, run_date="2024-01-01", run_id="007")
    writers.write_evidence(rows, path, run_date="2024-01-01", run_id="a/b c%")
    assert {x.run_id for x in writers.read_evidence(spark, path).collect()} == {"007", "a/b c%"}
    writers.write_evidence(rows.where("false"), path, run_date="2024-01-01", run_id="007")
    assert [x.run_id for x in writers.read_evidence(spark, path).collect()] == ["a/b c%"] * 2


def test_surplus_rows_of_one_key_have_ids_of_their_own(frame):
    df = frame([("k", "a"), ("k", "b"), ("k", "b"), ("k", "b"), ("z", "c")], "id string, v string")
    unique = Rule("U", "U", "t", "uniqueness", key=("id",))
    ids = [x.quarantine_id for x in q.quarantine_selected({"t": df}, unique, key=["id"], run_id="r", as_of=AS_OF).collect()]
    again = [x.quarantine_id for x in q.quarantine_selected({"t": df.repartition(3)}, unique, key=["id"], run_id="r", as_of=AS_OF).collect()]
    assert len(set(ids)) == 3 and sorted(ids) == sorted(again)
    rows = q.quarantine(df, [rule("v = 'b'")], key=["id"], run_id="r", as_of=AS_OF, unique_key=False)
    assert rows.select("quarantine_id").distinct().count() == 3


def test_merges_refuse_repeated_and_missing_keys(frame):
    schema = "id int, v string"
    one, twice, none = frame([(1, "a")], schema), frame([(1, "a"), (1, "b")], schema), frame([(None, "a")], schema)
    assert publish.merge_by_key(one, one, ["id"]).count() == 1
    for base, updates in ((one, twice), (twice, one), (one, none), (none, one)):
        with pytest.raises(PySparkException, match="there twice|is NULL"):
            publish.merge_by_key(base, updates, ["id"], on_conflict="update").collect()
    for before, after in ((twice, one), (one, none)):
        with pytest.raises(PySparkException, match="there twice|is NULL"):
            governance.change_audit(before, after, "id", table="t", as_of=AS_OF).collect()


def test_versions_without_a_key_stay(frame):
    schema = "sk bigint, id string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"
    dim = frame([(1, "a", "x", None, None, True), (2, None, "y", None, None, True)], schema)
    merged = publish.scd2_merge(
        dim, frame([("a", "z"), ("b", "w")], "id string, v string"), key="id", surrogate="sk", attributes=["v"], as_of=AS_OF
    )
    assert sorted((x.sk, x.id, x.v, x.is_current) for x in merged.collect()) == [
        (1, "a", "x", False), (2, None, "y", True), (3, "a", "z", True), (4, "b", "w", True),
    ]


def test_rule_names_with_any_characters(frame):
    names = ["""both ' and " quotes""", "back\\slash ' \" \\n", "plain"]
    rules = [rule("x > 1", rule_id=f"R{i}", name=n) for i, n in enumerate(names)]
    got = ev.evaluate(frame([(1,), (2,)], "x int"), rules, run_id="r", as_of=AS_OF)
    assert [x.rule_name for x in got.orderBy("rule_id").collect()] == names


def test_the_catalogue_keeps_every_kind_of_rule(spark, frame):
    rules = [
        rule("x > 1", rule_id="A"), Rule("B", "B", "t", "uniqueness", key=("x",)), Rule("C", "C", "t", "integrity", column="x", parent=("p", "k")),
        Rule("D", "D", "t", "accuracy", selector=r.SqlSelector("SELECT * FROM {t} WHERE x = 2")),
    ]
    back = r.from_catalog(r.catalog(spark, rules))
    assert back == rules
    tables = {"t": frame([(1,), (2,), (2,)], "x int"), "p": frame([(1,)], "k int")}
    got = {x.rule_id: x.violation_count for x in ev.evaluate_tables(tables, back, run_id="r", as_of=AS_OF).collect()}
    assert got == {"A": 2, "B": 1, "C": 2, "D": 2}
    with pytest.raises(ValueError, match="cannot be stored"):
        r.catalog(spark, [Rule("E", "E", "t", "accuracy", selector=lambda t: t["t"])])


def test_digests_tell_what_they_leave_out(frame):
    rows = [("RULE_FAIL", "HIGH", f"s{i}", float(i), "o", f"2024-01-01 00:00:{i:02d}") for i in range(7)]
    alerts = frame(rows, "alert_type string, severity string, subject string, magnitude double, object string, triggered_at string")
    got = rp.alert_routing(alerts, digest_size=3).groupBy("channel").agg(F.count("*").alias("n"), F.max("omitted").alias("o")).collect()
    assert {x.channel: (x.n, x.o) for x in got} == {"slack": (3, 4), "teams": (3, 4), "email": (7, 0)}


def test_append_streams_without_rows_can_be_read(spark, tmp_path):
    spark.range(5).withColumn("ts", F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/t.parquet")
    stream = sinks.read_stream(spark, str(tmp_path), "t").where("id > 100")
    got = sinks.table_of(stream, "none", mode="append")
    assert got.columns == ["id", "ts"] and got.count() == 0
