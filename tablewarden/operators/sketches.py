"""Profiles from mergeable sketches: each load is read once, its sketches are kept and merged later.

Distinct values come from HyperLogLog sketches, quantiles from KLL sketches, beside exact row and NULL counts. The exact
profile is in ``profiling`` and ``quantiles``; sketches answer over any set of kept loads without reading rows again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators.attach import same, unused
from tablewarden.operators.profiling import columns_of

LG_REGISTERS = 12  # of an HLL sketch: 4,096 registers
KLL_K = 200  # items kept per level of a KLL sketch
RANK_ERROR = 0.0266  # fixed value: 99 % bound of a rank's error at k = 200, both sides
SIGMAS = 3  # how many standard errors a stated distinct bound spans
KEPT = ("table_name", "column_name", "row_count", "null_count", "values", "ranks")


def distinct_error(lg_registers: int = LG_REGISTERS) -> float:
    """Relative bound of a merged distinct estimate: SIGMAS standard errors of 1.04 / sqrt(registers)."""
    return SIGMAS * 1.04 / (1 << lg_registers) ** 0.5


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _value(column: str, kind: T.DataType) -> Column:
    """What the distinct sketch is fed: one 64-bit hash of the value; all zeros and all NaNs are one value each."""
    col = F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        col = F.when(col == 0, F.lit(0.0).cast(kind)).otherwise(col)
    return F.when(F.col(f"`{column}`").isNotNull(), F.xxhash64(col))


def sketch(
    df: DataFrame, table: str, *, columns: Sequence[str] | None = None, by: Sequence[str] = (), lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """One row per group and column: table_name, column_name, row_count, null_count, values (HLL), ranks (KLL, numbers only).

    One scan whatever the number of columns; groups may be days, loads or partitions, a NULL group is a group. NaN and
    infinite numbers count as values and have no rank. Sketches have a fixed size, so rows of the result do not grow with the data.
    """
    clash = {c.lower() for c in by} & set(KEPT)
    if clash:
        raise ValueError(f"rename the grouping columns {sorted(clash)}: sketches have columns of these names")
    chosen = [c for c in (columns or columns_of(df)) if c not in by]
    (rows,) = unused(by, "_rows")
    aggregates, described = [], []
    for i, column in enumerate(chosen):
        kind = df.schema[column].dataType
        number = F.col(f"`{column}`").cast("double")
        finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number) if _is_number(kind) else F.lit(None).cast("double")
        aggregates += [
            F.count(F.col(f"`{column}`")).alias(f"_n{i}"), F.hll_sketch_agg(_value(column, kind), lg_registers).alias(f"_v{i}"),
            F.count(finite).alias(f"_f{i}"),
        ]
        ranks = F.lit(None).cast("binary")
        if _is_number(kind):
            aggregates.append(F.kll_sketch_agg_double(finite, KLL_K).alias(f"_k{i}"))
            ranks = F.when(F.col(f"_f{i}") > 0, F.col(f"_k{i}"))
        described.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.col(rows).alias("row_count"),
            (F.col(rows) - F.col(f"_n{i}")).alias("null_count"), F.col(f"_v{i}").alias("values"), ranks.alias("ranks"),
        ))
    keys = [F.col(f"`{c}`") for c in by]
    found = df.groupBy(*keys).agg(F.count("*").alias(rows), *aggregates)
    return found.select(*keys, F.inline(F.array(*described)))


def merged(sketches: DataFrame, by: Sequence[str] = ("table_name", "column_name")) -> DataFrame:
    """Kept sketches of many groups or loads as one per ``by``; merged in any order and grouping, estimates agree but for rounding."""
    return sketches.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double("ranks").alias("ranks"),
        F.count("ranks").alias("_ranked"),
    ).withColumn("ranks", F.when(F.col("_ranked") > 0, F.col("ranks"))).drop("_ranked")


def estimates(sketches: DataFrame, quantiles: Mapping[str, float] | None = None, *, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Columns beside the sketches' keys: exact counts, the distinct estimate and its bounds, one column per quantile.

    A quantile is a value whose rank lies within RANK_ERROR of the asked one; it is NULL where a column has no finite number.
    """
    estimate, error = F.hll_sketch_estimate("values"), distinct_error(lg_registers)
    keys = [F.col(f"`{c}`") for c in sketches.columns if c not in ("row_count", "null_count", "values", "ranks")]
    asked = [
        F.when(F.col("ranks").isNotNull(), F.kll_sketch_get_quantile_double("ranks", F.lit(float(p)))).alias(name)
        for name, p in (quantiles or {}).items()
    ]
    return sketches.select(
        *keys, "row_count", "null_count", estimate.alias("distinct_estimate"),
        F.floor(estimate * (1 - error)).alias("distinct_low"), F.ceil(estimate * (1 + error)).alias("distinct_high"), *asked,
    )


def distinct_drift(before: DataFrame, after: DataFrame, *, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Change between two sets of merged sketches: rows, NULL share, and how many values are new in ``after``.

    ``new_values`` is the estimate of the union less that of ``before``, 0 at least; ``beyond_error`` tells whether it is
    larger than both bounds together.
    """
    key = ["table_name", "column_name"]
    old = before.select(*[F.col(c).alias(f"_{c}") for c in key], *[F.col(c).alias(f"old_{c}") for c in ("row_count", "null_count", "values")])
    joined = after.join(old, same((c, f"_{c}") for c in key), "left")
    both = F.hll_sketch_estimate(F.hll_union("old_values", "values"))
    known = F.coalesce(F.hll_sketch_estimate("old_values"), F.lit(0))
    union = F.coalesce(both, F.hll_sketch_estimate("values"))
    share = [F.round(F.col(f"{p}null_count") * 100.0 / F.nullif(F.col(f"{p}row_count"), F.lit(0)), 2) for p in ("", "old_")]
    return joined.select(
        *key, (F.col("row_count") - F.coalesce("old_row_count", F.lit(0))).alias("row_change"),
        (share[0] - share[1]).alias("null_pct_change"), F.greatest(union - known, F.lit(0)).alias("new_values"),
        (union - known > distinct_error(lg_registers) * (union + known)).alias("beyond_error"),
    )
