import random
from itertools import combinations

import pytest

from tablewarden.operators import keys, payload_index, quarantine, sketches
from tablewarden.session import new_path
from tablewarden.sources import writers


# --- sketches ----------------------------------------------------------------------------
def test_merged_sketches_hold_their_bounds(spark):
    rows = spark.range(20000).selectExpr("id", "id % 700 AS few", "CAST(id AS string) AS name", "id % 7 AS day", "sqrt(id) AS x")
    direct = sketches.sketch(rows, "t", columns=["id", "few", "name", "x"])
    kept = sketches.sketch(rows, "t", columns=["id", "few", "name", "x"], by=["day"])
    path = new_path(spark, "sketches")
    writers.write_evidence(kept, path, run_date="2024-01-01", run_id="1")
    read = writers.read_evidence(spark, path)
    twice = sketches.merged(sketches.merged(read, ["table_name", "column_name", "day"]))  # merged in two steps
    shown = []
    for found in (sketches.merged(direct), sketches.merged(read), twice):
        by_column = {r.column_name: r for r in sketches.estimates(found, {"p50": 0.5, "p95": 0.95}).collect()}
        shown.append({c: (r.row_count, r.null_count, r.distinct_estimate) for c, r in by_column.items()})
        for column, distinct in (("id", 20000), ("few", 700), ("name", 20000), ("x", 20000)):
            assert by_column[column].distinct_low <= distinct <= by_column[column].distinct_high
            assert by_column[column].row_count == 20000 and by_column[column].null_count == 0
        for p, q in ((0.5, "p50"), (0.95, "p95")):
            assert abs(by_column["id"][q] / 20000 - p) <= sketches.RANK_ERROR
            assert abs(by_column["x"][q] ** 2 / 20000 - p) <= sketches.RANK_ERROR
        assert by_column["name"].p50 is None
    for column, (rows_in, nulls, distinct) in shown[1].items():  # the same registers, summed in another order
        assert shown[2][column][:2] == (rows_in, nulls) and abs(shown[2][column][2] - distinct) <= 0.001 * distinct + 1


def test_sketches_of_odd_values(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(None, None, None), (None, nan, ""), ("g", nan, None), ("g", 0.0, "a"), ("g", -0.0, "a"), ("g", inf, "b"), ("h", None, None)]
    schema = "values string, x double, ranks string"  # names of the sketches' own columns
    plain = {r.column_name: r for r in sketches.estimates(sketches.sketch(frame(rows, schema), "t"), {"p50": 0.5}).collect()}
    assert (plain["x"].row_count, plain["x"].null_count, plain["x"].distinct_estimate, plain["x"].p50) == (7, 2, 3, 0.0)
    assert (plain["ranks"].null_count, plain["ranks"].distinct_estimate) == (3, 3)
    groups = {(r.g, r.column_name): r for r in sketches.estimates(sketches.sketch(frame(rows, "g string, x double, y string"), "t", by=["g"])).collect()}
    assert groups[None, "x"].row_count == 2 and groups["h", "x"].distinct_estimate == 0 and len(groups) == 6
    own = sketches.estimates(sketches.sketch(frame(rows, "_rows string, x double, y string"), "t", by=["_rows"])).where("column_name = 'x'")
    assert sorted((str(r["_rows"]), r.row_count) for r in own.collect()) == [("None", 2), ("g", 4), ("h", 1)]
    with pytest.raises(ValueError, match="rename"):
        sketches.sketch(frame(rows, schema), "t", by=["values"])
    empty = sketches.sketch(frame([], "x double"), "t").collect()
    assert [(r.row_count, r.null_count, r.ranks) for r in empty] == [(0, 0, None)]


def test_drift_of_distinct_values(spark):
    old = sketches.merged(sketches.sketch(spark.range(5000), "t"))
    same = sketches.merged(sketches.sketch(spark.range(5000), "t"))
    new = sketches.merged(sketches.sketch(spark.range(4000, 10000), "t"))
    assert [(r.row_change, r.beyond_error) for r in sketches.distinct_drift(old, same).collect()] == [(0, False)]
    row = sketches.distinct_drift(old, new).first()
    assert row.row_change == 1000 and row.beyond_error and abs(row.new_values - 5000) < 600


# --- keys --------------------------------------------------------------------------------
def brute_keys(rows, names, most):
    found = []
    for size in range(1, most + 1):
        for s in combinations(range(len(names)), size):
            values = [tuple(r[i] for i in s) for r in rows]
            whole = all(v is not None for x in values for v in x)
            if rows and whole and len(set(values)) == len(rows) and not any(set(k) <= set(s) for k in found):
                found.append(s)
    return [tuple(names[i] for i in s) for s in found]


@pytest.mark.parametrize("seed", range(3))
def test_minimal_keys_equal_brute_force(frame, seed):
    draw = random.Random(seed)
    rows = list({(draw.randrange(6), draw.randrange(5), draw.randrange(7), draw.choice("abc"), draw.choice([1, None])) for _ in range(40)})
    names = ["a", "b", "c", "_copies", "e"]
    df = frame(rows, "a int, b int, c int, _copies string, e int")
    assert keys.minimal_keys(df, max_size=4) == brute_keys(rows, names, 4)


def test_keys_of_odd_tables(frame):
    assert keys.minimal_keys(frame([], "a int")) == []
    assert keys.minimal_keys(frame([(1, 1), (1, 1)], "a int, b int")) == []  # a repeated row
    assert keys.minimal_keys(frame([(1, None)], "a int, b int")) == [("a",)]
    assert keys.minimal_keys(frame([(0.0, 1), (-0.0, 2)], "x double, b int")) == [("b",)]
    found = keys.composite_keys(frame([(1, 1), (1, 2), (2, 1)], "a int, b int"), "t").collect()
    assert [tuple(r) for r in found] == [("t", "a,b", 2)]
    with pytest.raises(ValueError, match="max_size"):
        keys.minimal_keys(frame([], "a int"), max_size=0)


# --- payload index -----------------------------------------------------------------------
PAYLOADS = [
    '{"kind": "error", "n": 1.50, "ok": true, "odd.name": "x"}', '{"kind": "error", "kind": "view"}', '{"kind": null, "n": 1}', "no json",
    '[{"kind": "error"}]', "", None, '{"kind": {"kind": "error"}, "n": "1"}', '{"kind": "Error ü", "list": [1, 2]}', "{}",
]


def test_index_finds_what_a_search_finds(spark, frame):
    rows = [(f"q{i}", p) for i, p in enumerate(PAYLOADS)] + [("q0", PAYLOADS[0])]
    bad, folder = frame(rows, "quarantine_id string, payload string"), new_path(spark, "index")
    for batch, wanted in (("a", "quarantine_id < 'q5'"), ("b/1", "quarantine_id >= 'q5'"), ("a", "quarantine_id < 'q5'")):
        payload_index.add_batch(bad.where(wanted), folder, batch, buckets=4)
    asked = [("kind", "error"), ("kind", "view"), ("n", "1"), ("n", "1.5"), ("n", "1.50"), ("ok", "true"), ("kind", "Error ü"), ("list", "[1,2]"),
             ("kind.kind", "error"), ("odd.name", "x"), ("nothing", "x"), ("kind", "")]
    for field, value in asked:
        found = sorted(map(tuple, payload_index.search(bad, folder, field, value, buckets=4).select(*bad.columns).collect()), key=repr)
        assert found == sorted(map(tuple, quarantine.search_payload(bad, field, value).collect()), key=repr), (field, value)
    assert payload_index.search(bad, folder, "kind", None, buckets=4).isEmpty()


def test_a_search_reads_one_bucket(spark, frame, capsys):
    bad = frame([(f"q{i}", f'{{"n": {i}}}') for i in range(200)], "quarantine_id string, payload string")
    folder = new_path(spark, "index")
    payload_index.add_batch(bad, folder, "a", buckets=16)
    found = payload_index.lookup(spark, folder, "n", "17", buckets=16)
    assert [r.quarantine_id for r in found.collect()] == ["q17"]
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert len(found.inputFiles()) >= 1
    payload_index.add_batch(bad.where("false"), folder, "a", buckets=16)
    assert payload_index.lookup(spark, folder, "n", "17", buckets=16).isEmpty()
