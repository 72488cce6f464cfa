"""Minimal unique column sets of a table, level by level."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.attach import unused
from tablewarden.operators.profiling import columns_of
from tablewarden.operators.sketches import _value

LG_REGISTERS = 14  # standard error 0.8 %
SIGMAS = 6  # a set whose estimate lies this many standard errors below the row count is no key
SETS_PER_SCAN = 200  # sketches in one aggregate


def _hashed(df: DataFrame, columns: Sequence[str]):
    return F.xxhash64(*[_value(c, df.schema[c].dataType) for c in columns])


def _estimates(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """Estimated distinct combinations of each set; one scan for SETS_PER_SCAN of them."""
    found = {}
    for low in range(0, len(sets), SETS_PER_SCAN):
        part = sets[low : low + SETS_PER_SCAN]
        sums = [F.hll_sketch_estimate(F.hll_sketch_agg(_hashed(df, s), LG_REGISTERS)).alias(f"e{i}") for i, s in enumerate(part)]
        found |= dict(zip(part, df.agg(*sums).first(), strict=True))
    return found


def is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether no two rows agree in the columns, by a count per combination; a NULL agrees with a NULL."""
    (copies,) = unused(columns, "_copies")
    repeated = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias(copies)).where(F.col(copies) > 1)
    return repeated.limit(1).isEmpty()


def minimal_keys(df: DataFrame, *, columns: Sequence[str] | None = None, max_size: int = 3) -> list[tuple[str, ...]]:
    """Sets of at most ``max_size`` columns without NULLs that no two rows agree in, and no part of which is such a set.

    A level's sets are those without a known key inside. A set is dropped unseen when the upper bounds of its columns'
    distinct values multiply to fewer than the rows, then when its own sketch lies far below them; what is left is
    counted exactly, so a set that is returned is a key for certain. The bounds span six standard errors. The driver
    holds column names and one number per set. A table without rows has no keys.
    """
    if max_size < 1:
        raise ValueError("max_size must be at least 1")
    names = list(columns or columns_of(df))
    head = df.agg(F.count("*").alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)]).first()
    rows = head["rows"]
    names = [c for i, c in enumerate(names) if head[f"n{i}"] == rows]
    if rows == 0 or not names:
        return []
    error = SIGMAS * 1.04 / (1 << LG_REGISTERS) ** 0.5
    single = _estimates(df, [(c,) for c in names])
    upper = {c: single[(c,)] * (1 + error) + 1 for c in names}
    keys: list[tuple[str, ...]] = []
    for size in range(1, max_size + 1):
        sets = [s for s in combinations(names, size) if not any(set(k) <= set(s) for k in keys)]
        sets = [s for s in sets if _product(upper[c] for c in s) >= rows]
        found = single if size == 1 else _estimates(df, sets)
        keys += [s for s in sets if found[s] * (1 + error) + 1 >= rows and is_unique(df, s)]
    return keys


def _product(numbers) -> float:
    result = 1.0
    for x in numbers:
        result *= x
    return result


def composite_keys(df: DataFrame, table: str, *, columns: Sequence[str] | None = None, max_size: int = 3) -> DataFrame:
    """The minimal keys as rows: table_name, key_columns (comma-joined, in the table's order), key_size."""
    rows = [(table, ",".join(k), len(k)) for k in minimal_keys(df, columns=columns, max_size=max_size)]
    return df.sparkSession.createDataFrame(rows, "table_name string, key_columns string, key_size int")
