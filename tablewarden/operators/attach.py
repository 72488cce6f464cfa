"""Joining a small table of statistics to many rows, without a hot group in one task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW = 10_000  # rows of statistics that are broadcast
SALTS = 64  # parts a group is spread over when there are more


def unused(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, each with as many underscores before it as it takes to be none of the taken ones."""
    lower = {t.lower() for t in taken}
    found = []
    for name in wanted:
        while name.lower() in lower:
            name = f"_{name}"
        lower.add(name.lower())
        found.append(name)
    return found


def same(pairs: Iterable[tuple[str, str]]) -> Column:
    """Whether columns hold the same values, NULL being the same as NULL."""
    condition = F.lit(True)
    for one, other in pairs:
        condition = condition & F.col(f"`{one}`").eqNullSafe(F.col(f"`{other}`"))
    return condition


def attach(rows: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with the columns of their group in ``stats``, which has one row per group (one row in all without ``by``).

    Rows whose group is NULL meet the statistics of the NULL group. Few groups are broadcast, after they have been
    counted. With more groups, each is dealt over SALTS tasks and its statistics are repeated for them.
    """
    if not by:
        return rows.join(F.broadcast(stats))
    taken = [*rows.columns, *stats.columns]
    *keys, salt, other = unused(taken, *[f"_by{i}" for i in range(len(by))], "_salt", "_other_salt")
    own = stats.withColumnsRenamed(dict(zip(by, keys, strict=True)))
    match = same(zip(by, keys, strict=True))
    if stats.select(*[f"`{c}`" for c in by]).limit(FEW + 1).count() <= FEW:
        return rows.join(F.broadcast(own), match).drop(*keys)
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c not in by]), F.lit(SALTS))
    repeated = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    joined = rows.withColumn(salt, dealt).join(own.withColumn(other, repeated), match & (F.col(salt) == F.col(other)))
    return joined.drop(salt, other, *keys)
