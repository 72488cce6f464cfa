"""First, latest and surplus rows per key, without sending a hot key to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.operators.attach import unused

CHUNK = 1024  # copies of a row written out at once


def top_per_key(df: DataFrame, key: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in the given order.

    Spark keeps only ``n`` rows per key and task before the shuffle (window group limit), so the
    size of a key does not matter. ``order`` must be total for a repeatable result.
    """
    (rank,) = unused(df.columns, "_rank")
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col(rank) <= n).drop(rank)


def latest_per_key(df: DataFrame, key: list[str], stamp: str, tie_break: list[str] | None = None) -> DataFrame:
    """Newest row per key; ties go to the largest tie-break values."""
    order = [F.desc(stamp), *[F.desc(c) for c in tie_break or []]]
    return top_per_key(df, key, order)


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key by the order columns, all other columns breaking ties."""
    rest = [c for c in df.columns if c not in key and c not in order]
    return top_per_key(df, key, [F.asc(c) for c in [*order, *rest]])


def surplus_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Every row but the first of its key, exact copies included.

    Only rows of repeated keys go on; with few of them Spark broadcasts the keys and the table is
    not shuffled at all. Identical rows are counted per input partition, so neither a hot key nor
    a third of the table being one and the same row lands in one task. The kept row of each key is
    found by an aggregate and taken out with a join on the whole row, whose values are well spread.
    NULL keys are no duplicates of each other.
    """
    columns = df.columns
    rest = [c for c in columns if c not in key and c not in order]
    n, part, copies, row, nth, kept, surplus, chunk, left, copy = unused(
        columns, "_n", "_part", "_copies", "_row", "_nth", "_kept", "_surplus", "_chunk", "_left", "_copy"
    )
    has_key = F.lit(True)
    for column in key:
        has_key = has_key & F.col(column).isNotNull()
    whole = F.struct(*key, *order, *rest)
    repeated = df.where(has_key).groupBy(*key).agg(F.count("*").alias(n)).where(F.col(n) > 1).select(*key)
    keyed = df.join(repeated, key, "left_semi").select(*columns)
    counted = (
        keyed.withColumn(part, F.spark_partition_id())
        .groupBy(*columns, part)
        .agg(F.count("*").alias(copies))
        .withColumn(row, whole)
    )
    # one entry per input partition and distinct row; the first entry gives up the kept copy
    first = keyed.groupBy(*key).agg(F.min(whole).alias(row)).select(row, F.lit(1).alias(kept))
    given_up = F.when(F.col(nth) == 1, F.coalesce(F.col(kept), F.lit(0))).otherwise(0)
    many = (
        counted.withColumn(nth, F.row_number().over(Window.partitionBy(row).orderBy(part)))
        .join(first, row, "left")
        .withColumn(surplus, F.col(copies) - given_up)
        .where(F.col(surplus) > 0)
    )
    # written out in chunks, so that no array is as long as a row has copies
    last = F.floor((F.col(surplus) - 1) / CHUNK)
    chunks = many.select(*columns, surplus, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias(chunk))
    held = F.least(F.col(surplus) - F.col(chunk) * CHUNK, F.lit(CHUNK)).cast("int")
    return chunks.withColumn(left, held).select(*columns, F.explode(F.sequence(F.lit(1), F.col(left))).alias(copy)).drop(copy)
