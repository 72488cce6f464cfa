import os

import pytest
from pyspark.sql import functions as F

from tablewarden.operators.keyed_store import KeyedStore
from tablewarden.operators.publish import merge_by_key, scd2_merge
from tablewarden.session import new_path

SCHEMA = "id bigint, name string, _part int"  # a column named as the folders would be


def stored_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_upserts_equal_a_whole_merge_and_leave_other_parts(spark, frame, capsys):
    base = frame([(i, f"n{i}", i % 3) for i in range(200)], SCHEMA)
    store = KeyedStore(spark, new_path(spark, "keyed"), base.schema, ["id"], parts=32)
    store.create(base)
    before = files(f"{store.folder}/rows")
    updates = frame([(7, "seven", None), (1000, "new", 1)], "id int, name string, _part int")  # the key in a narrower type
    touched = store.upsert(updates, version=1)
    want = stored_rows(merge_by_key(base, updates, ["id"], on_conflict="update"))
    assert stored_rows(store.read()) == want and len(touched) <= 2
    assert before <= files(f"{store.folder}/rows")  # earlier folders stay as they are
    assert stored_rows(store.read(before=1)) == stored_rows(base)
    now = store.read().select(F.input_file_name().alias("f")).distinct().collect()
    assert len([r for r in now if f"{store.written}=1/" in r.f]) == len(touched)
    old = [r.f for r in now if f"{store.written}=0/" in r.f]
    assert not [f for f in old for p in touched if f"/{store.part}={p}/" in f] and len(old) >= len(before) - len(touched)
    store.read().explain("formatted")
    assert store.written in capsys.readouterr().out.split("PartitionFilters")[1].split("\n")[0]
    assert store.upsert(updates, version=1) == touched and stored_rows(store.read()) == want
    assert store.upsert(frame([(8, "kept", 0)], SCHEMA), version=2, on_conflict="ignore") and stored_rows(store.read()) == want
    with pytest.raises(ValueError, match="version"):
        store.upsert(updates, version=1)


def test_a_version_without_its_list_is_not_seen(spark, frame):
    base = frame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    store = KeyedStore(spark, new_path(spark, "keyed"), base.schema, ["id"], parts=2)
    store.create(base)
    base.selectExpr("id", "'lost' AS name", "1 AS _part", "0 AS p").withColumnRenamed("p", store.part).write.partitionBy(store.part).parquet(
        f"{store.folder}/rows/{store.written}=1"
    )
    assert stored_rows(store.read()) == stored_rows(base)


def test_empty_stores_and_empty_upserts(spark, frame):
    none = frame([], SCHEMA)
    store = KeyedStore(spark, new_path(spark, "keyed"), none.schema, ["id"], parts=4)
    assert store.read().isEmpty()
    store.create(none)
    assert store.upsert(none, version=1) == [] and store.read().isEmpty()
    store.upsert(frame([(1, None, None)], SCHEMA), version=2)
    assert stored_rows(store.read()) == [(1, None, None)]
    for rows in ([(None, "x", 1)], [(3, "x", 1), (3, "y", 1)]):  # as in a whole merge
        with pytest.raises(Exception, match="is NULL|is there twice"):
            store.upsert(frame(rows, SCHEMA), version=3)
    assert stored_rows(store.read()) == [(1, None, None)]


def test_versions_of_a_dimension(spark, frame):
    schema = "sk bigint, bk string, city string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"
    dim = frame([], schema).unionByName(spark.sql("""SELECT id + 1 AS sk, CAST(id AS string) AS bk, 'x' AS city,
        TIMESTAMP_NTZ'2020-01-01' AS effective_from, CAST(NULL AS timestamp_ntz) AS effective_to, true AS is_current FROM range(60)"""))
    dim = dim.unionByName(spark.sql("""SELECT 900 AS sk, CAST(NULL AS string) AS bk, 'old' AS city, TIMESTAMP_NTZ'2019-01-01' AS effective_from,
        CAST(NULL AS timestamp_ntz) AS effective_to, true AS is_current"""))
    store = KeyedStore(spark, new_path(spark, "keyed"), dim.schema, ["bk"], parts=16)
    store.create(dim)
    news = frame([("3", "y"), ("4", "x"), ("new", "z")], "bk string, city string")
    options = {"surrogate": "sk", "attributes": ["city"], "as_of": "2024-01-01 00:00:00"}
    assert len(store.merge_versions(news, version=1, **options)) <= 3
    assert stored_rows(store.read()) == stored_rows(scd2_merge(dim, news, key="bk", **options))
