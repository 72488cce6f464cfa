import uuid

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import digest_tree as dt
from tablewarden.operators import reconcile as rc
from tablewarden.session import work_folder

KEYS, COLUMNS = ["k"], ["a", "b"]


def tree(spark, df, **options):
    return dt.write_tree(df, KEYS, COLUMNS, f"{work_folder(spark)}/tree-{uuid.uuid4().hex[:8]}", **options)


def files_read(df):
    """Files that the scans of an executed plan opened, from the metrics."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    return sum(int(x.split()[-1]) for x in scan_metrics(plan))


def scan_metrics(plan):
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found.append(f"files {node.metrics().apply('numFiles').value()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def keys_of(diff):
    return sorted(((x.k, x.status, x.changed_columns, x.source_rows, x.target_rows) for x in diff.collect()), key=repr)


def both(spark, source, target, **options):
    found = dt.tree_diff(spark, tree(spark, source, **options), tree(spark, target, **options))
    expected = rc.keyed_diff(source, target, KEYS, COLUMNS).where("status <> 'MATCH'")
    assert keys_of(found) == keys_of(expected)
    return found


def test_one_key_reads_few_files(spark):
    source = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"), F.lit("x").alias("b"))
    target = source.withColumn("a", F.when(F.col("k") == 77, -1).otherwise(F.col("a")))
    trees = tree(spark, source), tree(spark, target)
    total = sum(len(spark.read.parquet(t.rows_path).inputFiles()) for t in trees)
    diff = dt.tree_diff(spark, *trees)
    assert files_read(diff) < 0.05 * total and total >= 512
    assert keys_of(diff) == [(77, "CHANGED", ["a"], 1, 1)]
    assert dt.differing_leaves(spark, *trees).count() == 1


def test_equal_tables_read_nothing(spark):
    source = spark.range(300).select(F.col("id").alias("k"), F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    diff = dt.tree_diff(spark, tree(spark, source), tree(spark, source.repartition(3)))
    assert files_read(diff) == 0 and diff.count() == 0


@pytest.mark.parametrize("depth", [1, 3])
def test_nulls_copies_and_missing_keys(spark, frame, depth):
    schema = "k string, a string, b int, _leaf int"
    source = [("1", "x", 1, 0), ("2", None, 2, 0), ("3", "z", 3, 0), (None, "w", None, 0), ("", "d", 1, 0), ("6", "d", 1, 0), ("6", "d", 1, 0)]
    target = [("1", "x", 1, 1), ("2", "", 2, 1), (None, "w", 4, 1), ("5", "v", 5, 1), ("6", "d", 1, 1), ("", "d", 1, 1)]
    both(spark, frame(source, schema), frame(target, schema), depth=depth)
    both(spark, frame(source, schema), frame([], schema), depth=depth)
    both(spark, frame([], schema), frame([], schema), depth=depth)


def test_a_key_with_very_many_rows(spark):
    hot = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.lit("a").alias("a"), (F.col("id") % 50).alias("b"))
    moved = hot.withColumn("b", F.when(F.col("b") == 5, 6).otherwise(F.col("b")))
    both(spark, hot, moved, rows_per_file=100)
    stored = tree(spark, hot, rows_per_file=100)
    per_leaf = spark.read.parquet(stored.rows_path).groupBy(F.input_file_name()).count()
    assert per_leaf.agg(F.max("count")).first()[0] <= 100


def test_other_trees_are_refused(spark):
    df = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("a"), F.lit(2).alias("b"))
    with pytest.raises(ValueError):
        dt.differing_leaves(spark, tree(spark, df), tree(spark, df, depth=1))
    with pytest.raises(ValueError):
        tree(spark, df, depth=5)


def test_keyed_diff_sorts_nothing(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.col("id").cast("string").alias("a"), F.lit(1).alias("b"))
    plan = rc.keyed_diff(df, df, KEYS, COLUMNS)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
