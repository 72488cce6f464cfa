import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewarden.functions import masking, standardize
from tablewarden.operators import defects, governance, publish


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "value, expected",
    [(None, "****"), ("", "****"), ("abc", "****"), ("abcd", "ab*cd"), ("Johnathan", "Jo*****an")],
)
def test_mask_partial(spark, value, expected):
    assert one(spark, masking.mask_partial(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize(
    "value, expected", [(None, "****"), ("j.doe@acme.com", "j***@acme.com"), ("a@b@c", "a***@b"), ("none", "****")]
)
def test_mask_email(spark, value, expected):
    assert one(spark, masking.mask_email(F.lit(value).cast("string"))) == expected


def test_hash_id(spark):
    assert one(spark, masking.hash_id(F.lit(42))).startswith("73475cb40a568")
    assert one(spark, masking.hash_id(F.lit(None))) == one(spark, masking.hash_id(F.lit("")))
    assert one(spark, masking.tokenize(F.lit(None), "s")) is None


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-05", dt.date(2024, 1, 5)), ("05/01/2024", dt.date(2024, 1, 5)), ("01/25/2024", dt.date(2024, 1, 25)),
        ("05-Jan-2024", dt.date(2024, 1, 5)), ("20240105", dt.date(2024, 1, 5)), ("05.01.2024", dt.date(2024, 1, 5)),
        ("", None), (None, None), ("2024-02-30", None),
    ],
)
def test_parse_date(spark, value, expected):
    assert one(spark, standardize.parse_date(F.lit(value).cast("string"))) == expected


def test_parse_date_order_is_the_callers(spark):
    american = ["MM/dd/yyyy", "dd/MM/yyyy"]
    assert one(spark, standardize.parse_date(F.lit("05/01/2024"), american)) == dt.date(2024, 5, 1)


def test_repairs_undo_the_defects(spark):
    people = spark.range(2000).select(
        F.concat(F.lit("k"), "id").alias("k"), F.concat(F.lit("ann"), "id", F.lit("@acme.io")).alias("email"),
        F.concat(F.lit("+1-555-"), F.col("id") % 900 + 100, F.lit("-"), F.col("id") % 9000 + 1000).alias("phone"),
    )
    key = F.col("k")
    dirty = people.select(
        "email", "phone",
        defects.inject_email(F.col("email"), key, prob=1.0).alias("bad_email"),
        defects.inject_phone(F.col("phone"), key, prob=1.0).alias("bad_phone"),
    ).where("bad_email LIKE '%@%'")
    fixed = dirty.where(standardize.clean_email(F.col("bad_email")) != F.col("email"))
    assert fixed.count() == 0
    phone = standardize.clean_phone(F.col("bad_phone"))
    assert dirty.where(~phone.eqNullSafe(standardize.clean_phone(F.col("phone")))).count() == 0


def test_defects_do_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("a.b@c.d").alias("e"))
    broken = lambda d: d.select("k", defects.inject_email(F.col("e"), F.col("k"), prob=0.3).alias("e"))
    assert broken(df).exceptAll(broken(df.repartition(7))).count() == 0
    share = broken(df).where("e <> 'a.b@c.d'").count() / 500
    assert 0.2 < share < 0.4


def test_duplicates_add_at_least_one_row(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("k"))
    assert defects.inject_duplicates(df, F.col("k"), rate=1e-9).count() == 21
    assert defects.inject_duplicates(df, F.col("k"), rate=0).count() == 20


def test_title_case(spark):
    from tablewarden.functions.text import title_case

    assert one(spark, title_case(F.lit("o'neil mc-DONALD 3rd été"))) == "o'neil mc-DONALD 3rd été".title()


def test_numbers_are_dense_and_unique(spark):
    df = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("k"))
    numbered = publish.number_rows(df, F.col("k"), "sk", start=100)
    found = numbered.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(found) == (101, 5100, 5000)
    again = publish.number_rows(df.repartition(9), F.col("k"), "sk", start=100)
    assert numbered.exceptAll(again).count() == 0


DIM = "sk long, bk string, a string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"


def test_scd2(frame):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    dim = frame(
        [(1, "x", "old", t0, t1, False), (2, "x", "1", t1, None, True), (3, "y", None, t0, None, True), (4, "z", "3", t0, None, True)],
        DIM,
    )
    new = frame([("x", "1"), ("y", "2"), ("w", "9")], "bk string, a string")
    merged = publish.scd2_merge(dim, new, key="bk", surrogate="sk", attributes=["a"], as_of="2022-01-01 00:00:00")
    rows = {(r.bk, r.a, r.is_current, r.effective_to is None) for r in merged.collect()}
    assert rows == {
        ("x", "old", False, False), ("x", "1", True, True), ("y", None, False, False), ("y", "2", True, True),
        ("z", "3", True, True), ("w", "9", True, True),
    }
    current = merged.where("is_current").groupBy("bk").count()
    assert current.where("count <> 1").count() == 0
    assert merged.select("sk").distinct().count() == 6
    assert {r.sk for r in merged.where("bk = 'w' OR (bk = 'y' AND is_current)").collect()} == {5, 6}
    again = publish.scd2_merge(merged, new, key="bk", surrogate="sk", attributes=["a"], as_of="2023-01-01 00:00:00")
    assert again.exceptAll(merged).count() == 0 and merged.exceptAll(again).count() == 0


def test_merge_by_key(frame):
    base = frame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = frame([(2, None, 9), (3, "c", 3)], "k int, s string, n int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(publish.merge_by_key(base, new, ["k"])) == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    updated = publish.merge_by_key(base, new, ["k"], on_conflict="update", columns=["s"])
    assert rows(updated) == [(1, "a", 1), (2, None, 2), (3, "c", 3)]
    assert rows(publish.insert_if_absent(base, new, ["k"]))[0][0] == 3


def test_change_audit(frame):
    old = frame([(1, "a"), (2, None), (3, "c"), (5, "e")], "id int, v string")
    new = frame([(1, "a"), (2, "b"), (4, "d"), (5, None)], "id int, v string")
    audit = governance.change_audit(old, new, "id", table="t", as_of="2024-01-01 00:00:00", include_unchanged=True)
    found = {r.row_pk: (r.action, r.changed_cols) for r in audit.collect()}
    assert found == {
        "1": ("UPDATE", None), "2": ("UPDATE", ["v"]), "3": ("DELETE", None), "4": ("INSERT", None), "5": ("UPDATE", ["v"]),
    }
    plain = governance.change_audit(old, new, "id", table="t", as_of="2024-01-01 00:00:00")
    assert plain.count() == 4
    assert plain.where("row_pk = '2'").first().old_row == '{"id":2,"v":null}'


def test_domains(frame):
    rows = frame([("GLOBAL", 1), ("a", 2), ("b", 3)], "data_domain string, n int")
    mapping = frame([("ann", "a"), ("ann", "a"), ("bob", "b")], "db_user string, data_domain string")
    seen = lambda user, *roles: sorted(
        r.n for r in governance.filter_by_domain(rows, user=user, roles=roles, mapping=mapping).collect()
    )
    assert (seen("ann"), seen("eve"), seen("eve", "dq_engineer")) == ([1, 2], [1], [1, 2, 3])


def test_policy_ignores_absent_columns(frame):
    df = frame([("secret", "a@b.c", "keep")], "s string, email string, other string")
    policy = [
        {"column_name": "s", "masking_strategy": "REDACT"}, {"column_name": "email", "masking_strategy": "PARTIAL"},
        {"column_name": "gone", "masking_strategy": "HASH"},
    ]
    assert tuple(governance.apply_policy(df, policy).first()) == ("***REDACTED***", "a***@b.c", "keep")
