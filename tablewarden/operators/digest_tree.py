"""Comparison of two stored tables through trees of range digests: only ranges that differ are read.

Rows are spread over ranges by the MD5 of their key, which are the leaves of a tree with sixteen children to a node. A
node holds the number of rows below it and a digest of its children, so equal nodes need no look at what is below.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.hashing import hex_to_decimal, row_digest, row_text
from tablewarden.operators.attach import unused
from tablewarden.operators.reconcile import keyed_diff
from tablewarden.sources.writers import stored

DEPTH = 2  # levels below the root: 16 ** DEPTH leaves
MOST_LEAVES_DEPTH = 4  # the names of differing leaves reach the driver
ROWS_PER_FILE = 4_000_000


@dataclass(frozen=True)
class DigestTree:
    """A table stored by leaf, and its nodes stored by level."""

    folder: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    depth: int
    schema: T.StructType
    leaf: str  # name of the folder column

    @property
    def rows_path(self) -> str:
        return f"{self.folder}/rows"

    @property
    def nodes_path(self) -> str:
        return f"{self.folder}/nodes"

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("node string, digest string, row_count bigint, level int").parquet(self.nodes_path)

    def rows(self, spark: SparkSession, leaves: list[str]) -> DataFrame:
        """Rows of some leaves; only their folders are read."""
        stored_as = T.StructType([*self.schema.fields, T.StructField(self.leaf, T.StringType())])  # a leaf such as 00 is text
        return spark.read.schema(stored_as).parquet(self.rows_path).where(F.col(self.leaf).isin(leaves)).drop(self.leaf)


def leaf_of(keys: list[str], depth: int) -> Column:
    """The leaf a key belongs to: NULL and '' are keys like any other."""
    return F.substring(F.md5(row_text([F.col(f"`{k}`") for k in keys])), 1, depth)


def leaf_digests(rows: DataFrame, leaf: str, keys: list[str], columns: list[str]) -> DataFrame:
    """Digest and number of rows per leaf. Digests are totals of row hashes, so order does not matter and copies count."""
    whole = row_digest([F.col(f"`{c}`") for c in [*keys, *columns]])
    halves = [hex_to_decimal(F.substring(F.col("_whole"), start, 16)) for start in (1, 17)]
    totals = rows.select(F.col(f"`{leaf}`").alias("node"), whole.alias("_whole")).groupBy("node").agg(
        F.count("*").alias("row_count"), *[F.sum(half).alias(f"t{i}") for i, half in enumerate(halves)]
    )
    digest = F.md5(F.concat_ws("|", "row_count", "t0", "t1"))
    return totals.select("node", digest.alias("digest"), "row_count")


def levels(leaves: DataFrame, depth: int) -> DataFrame:
    """All nodes from the leaves (level ``depth``) up to the root (level 0, with an empty name)."""
    below, found = leaves, leaves.withColumn("level", F.lit(depth))
    for level in range(depth - 1, -1, -1):
        child = F.struct("node", "digest")
        below = below.groupBy(F.substring("node", 1, level).alias("node")).agg(
            F.md5(F.to_json(F.array_sort(F.collect_list(child)))).alias("digest"), F.sum("row_count").alias("row_count")
        )  # sixteen children at most
        found = found.unionByName(below.withColumn("level", F.lit(level)))
    return found


def write_tree(df: DataFrame, keys: list[str], columns: list[str], folder: str, *, depth: int = DEPTH, rows_per_file: int = ROWS_PER_FILE) -> DigestTree:
    """Store a table by leaf together with its tree; a leaf with very many rows is dealt to several files.

    Any key may repeat. The tree of a table without rows has no nodes.
    """
    if not 1 <= depth <= MOST_LEAVES_DEPTH:
        raise ValueError(f"depth must be 1 to {MOST_LEAVES_DEPTH}")
    wanted = df.select(*[f"`{c}`" for c in [*keys, *columns]])
    (leaf,) = unused(wanted.columns, "_leaf")
    tree = DigestTree(folder, tuple(keys), tuple(columns), depth, wanted.schema, leaf)
    wanted = wanted.withColumn(leaf, leaf_of(keys, depth))
    leaves = stored(leaf_digests(wanted, leaf, keys, columns), "leaf-digests")
    levels(leaves, depth).write.mode("overwrite").partitionBy("level").parquet(tree.nodes_path)
    node, files = unused(wanted.columns, "_node", "_files")
    sizes = leaves.select(F.col("node").alias(node), F.ceil(F.col("row_count") / rows_per_file).alias(files))
    dealt = F.pmod(F.xxhash64(*[f"`{c}`" for c in [*keys, *columns]], F.spark_partition_id()), F.col(files))
    spread = wanted.join(F.broadcast(sizes), F.col(leaf) == F.col(node))  # one row per leaf
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, else few bytes become one task
    writer = spread.repartition(tasks, F.col(leaf), dealt).drop(node, files).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(leaf).parquet(tree.rows_path)
    return tree


def differing_leaves(spark: SparkSession, one: DigestTree, other: DigestTree) -> DataFrame:
    """Leaves whose digests differ, found from the root downwards: a level is looked at below differing nodes only."""
    if (one.keys, one.columns, one.depth) != (other.keys, other.columns, other.depth):
        raise ValueError("the trees have other keys, columns or depths")
    sides = one.nodes(spark), other.nodes(spark)
    frontier = None
    for level in range(one.depth + 1):
        a, b = (s.where(F.col("level") == level).select("node", F.col("digest").alias(d)) for s, d in zip(sides, ("a", "b"), strict=True))
        if frontier is not None:
            parent = F.substring("node", 1, level - 1)
            a, b = (s.withColumn("parent", parent).join(frontier, "parent", "left_semi").drop("parent") for s in (a, b))
        frontier = a.join(b, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("node").alias("parent"))
    return frontier.select(F.col("parent").alias("leaf"))


def tree_diff(spark: SparkSession, source: DigestTree, target: DigestTree) -> DataFrame:
    """The keys that differ, as ``keyed_diff`` names them; rows of equal leaves are not read.

    Only the names of differing leaves reach the driver, 16 ** depth at most.
    """
    leaves = [r.leaf for r in differing_leaves(spark, source, target).collect()]
    sides = [tree.rows(spark, leaves) for tree in (source, target)]
    return keyed_diff(*sides, list(source.keys), list(source.columns)).where("status <> 'MATCH'")
