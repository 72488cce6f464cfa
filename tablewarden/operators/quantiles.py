"""Exact percentiles without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.operators.attach import attach, same, unused


def exact_percentiles(
    df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None, buckets: int = 256
) -> DataFrame:
    """Interpolated percentiles per group, as columns named by ``probs``; NULL is a group like others.

    Equal values are counted first. Approximate quantiles cut each group into ``buckets`` ranges
    (a power of two), and the rows counted per range tell which ranges hold the wanted ranks. Only
    those are sorted, about 1/buckets of a group each, so the result is exact whatever the cuts are.
    """
    by = by or []
    keyed = df.where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    counts = keyed.groupBy(*by, "_v").agg(F.count("*").alias("_n"))

    shares = [i / buckets for i in range(1, buckets)]
    cuts = keyed.groupBy(*by).agg(
        F.percentile_approx("_v", shares, 10000).alias("_cuts"), F.count("*").alias("_total")
    )
    placed = attach(counts, cuts, by).withColumn("_bucket", _cuts_below(buckets)).drop("_cuts")
    sizes = placed.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_size"), F.max("_total").alias("_all_rows"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))

    def ranks(total: str) -> list[tuple[str, Column]]:
        found = []
        for label, prob in probs.items():
            position = F.lit(float(prob)) * (F.col(total) - 1)
            found += [(f"_{label}_lo", F.floor(position)), (f"_{label}_hi", F.ceil(position))]
        return found

    wanted = F.lit(False)
    for _, rank in ranks("_all_rows"):
        wanted = wanted | ((F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_size")))
    keys = [*by, "_bucket"]
    names = unused([*placed.columns, "_start"], *[f"_w{i}" for i in range(len(keys))])
    held = starts.where(wanted).select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)], "_start")
    needed = placed.join(held, same(zip(keys, names, strict=True))).drop(*names)

    inside = Window.partitionBy(*by, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = needed.withColumn("_last", F.col("_start") + F.sum("_n").over(inside) - 1).withColumn(
        "_first", F.col("_last") - F.col("_n") + 1
    )
    wide = ranked.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        *[
            F.max(F.when((F.col("_first") <= rank) & (rank <= F.col("_last")), F.col("_v"))).alias(name)
            for name, rank in ranks("_total")
        ],
    )
    columns = []
    for label, prob in probs.items():
        position = F.lit(float(prob)) * (F.col("_total") - 1)
        part = position - F.floor(position)
        columns.append((F.col(f"_{label}_lo") * (1 - part) + F.col(f"_{label}_hi") * part).alias(label))
    return wide.where("_total IS NOT NULL").select(*by, *columns)


def _cuts_below(buckets: int) -> Column:
    """How many of the sorted cut points lie below the value, by halving steps."""
    steps, step = [], buckets // 2
    while step:
        steps.append(F.lit(step))
        step //= 2
    return F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda at, step: F.when(F.get(F.col("_cuts"), at + step - 1) < F.col("_v"), at + step).otherwise(at),
    )
