"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the smallest node that can be reached.

    Each round joins the neighbours of every node to the smallest one, first those above it, then those below it,
    and writes the new links to the shared folder. The rounds grow with the logarithm of the longest chain; the
    driver sees one count and one checksum a round. NULL nodes and links of a node to itself are left out.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = settled(links.where("a != b").distinct(), "links")
    seen = mark(links)
    while seen[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        above = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        above = above.where("a != b").distinct()
        lowest = above.groupBy("a").agg(F.min("b").alias("low"))
        below = above.join(lowest, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = settled(below.union(lowest).distinct(), "links")
        now = mark(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def mark(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())
