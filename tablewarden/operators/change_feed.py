"""Audit rows from a feed of changes: every change is replayed against the state its key was left in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.operators.governance import audit_rows

RANGES = 64  # parts of the sequence; one key's changes are spread over as many tasks


def replayed(feed: DataFrame, key: str, sequence: str, *, deletes: Column, columns: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """key, c (the change as a struct), o and n: the key's row before and after each change, NULL where there is none.

    Changes of a key are ordered by ``sequence`` (a number or a moment), ties and NULLs by the change itself. The sequence
    is cut into ranges of about as many changes: inside a range the row before is the one of the change before; the first
    change of a range takes what the latest earlier range of that key left, of which there is one row per key and range. So
    a key with a third of all changes is never in one task.
    """
    state = F.struct(*[F.col(f"`{c}`") for c in columns])
    place = F.struct(F.col(f"`{sequence}`").alias("at"), F.xxhash64("*").alias("tie"))
    at = F.col(f"`{sequence}`").cast("double")
    own = feed.select(
        F.col(f"`{key}`").alias("key"), F.struct("*").alias("c"), place.alias("place"), at.alias("at"),
        F.struct(F.when(~F.coalesce(deletes, F.lit(False)), state).alias("row")).alias("left"),
    )
    cuts = own.agg(F.percentile_approx("at", [i / ranges for i in range(1, ranges)], 10_000).alias("cuts"))
    part = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("at"))), F.lit(-1))  # one row of bounded size is broadcast
    dealt = own.join(F.broadcast(cuts)).withColumn("part", F.when(F.col("at").isNull(), -1).otherwise(part)).drop("cuts")
    within = Window.partitionBy("key", "part").orderBy("place")
    lasts = dealt.groupBy("key", "part").agg(F.max_by("left", "place").alias("left"))
    carried = lasts.withColumn("carried", F.lag("left").over(Window.partitionBy("key").orderBy("part")))
    carried = carried.select(F.col("key").alias("k"), F.col("part").alias("p"), "carried")
    found = dealt.withColumns({"earlier": F.lag("left").over(within), "nth": F.row_number().over(within)})
    # only the first change of a key in a range needs what was carried
    met = found.join(carried, (F.col("nth") == 1) & F.col("key").eqNullSafe(F.col("k")) & (F.col("part") == F.col("p")), "left")
    before = F.when(F.col("nth") == 1, F.col("carried.row")).otherwise(F.col("earlier.row"))
    return met.select("key", "c", before.alias("o"), F.col("left.row").alias("n"))


def feed_audit(
    feed: DataFrame,
    key: str,
    sequence: str,
    *,
    deletes: Column,
    columns: Sequence[str],
    table: str,
    event_time: str,
    user: str | None = None,
    schema: str = "main",
    include_unchanged: bool = False,
    ranges: int = RANGES,
) -> DataFrame:
    """INSERT, UPDATE and DELETE rows, one for each change that changes something, as a trigger on every row writes them.

    ``deletes`` marks changes that delete their key's row; any other one leaves ``columns`` as the row, whether it was
    there or not. Deleting what is not there writes nothing, and a change delivered twice changes nothing the second time.
    ``event_time`` and ``user`` name columns of the feed. The NULL key is a key.
    """
    pair = replayed(feed, key, sequence, deletes=deletes, columns=columns, ranges=ranges)
    pair = pair.where("o IS NOT NULL OR n IS NOT NULL")
    who = F.col(f"c.`{user}`").cast("string") if user else F.lit("system")
    return audit_rows(
        pair, list(columns), "key", table=table, schema=schema, event_time=F.col(f"c.`{event_time}`"), user=who,
        include_unchanged=include_unchanged,
    )
