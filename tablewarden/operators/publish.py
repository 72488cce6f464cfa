"""Publishing the clean layer: keys, upserts, versions and facts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.timing import moment
from tablewarden.operators.attach import unused

KEY_RANGES = 3  # hexadecimal digits, so 4,096 ranges


def number_rows(
    df: DataFrame, key: Column, alias: str, *, where: Column | None = None, start: "int | Column" = 0,
    digits: int = KEY_RANGES,
) -> DataFrame:
    """Consecutive numbers from ``start + 1`` for rows with distinct text keys; rows without a key come first.

    Rows are spread over ranges of the key's MD5; a row's number is the size of the earlier ranges
    plus its rank in its own range. Only the table of range sizes (16**digits rows) is broadcast.
    With ``where``, only the rows it selects are numbered and the others get NULL.
    """
    wanted = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4: the table of range sizes is broadcast")
    text, chosen, part, rank, size, before, part_of = unused(
        [*df.columns, alias], "_key", "_wanted", "_range", "_rank", "_size", "_start", "_other_range"
    )
    # rows without a key are a range of their own
    spread = df.withColumns({text: key.cast("string"), chosen: wanted}).withColumn(
        part, F.coalesce(F.substring(F.md5(F.col(text)), 1, digits), F.lit(""))
    )
    sizes = spread.groupBy(F.col(part).alias(part_of)).agg(F.count_if(chosen).alias(size))
    earlier = Window.orderBy(part_of).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part_of, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(before))
    within = F.row_number().over(Window.partitionBy(part, chosen).orderBy(text))
    base = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    return (
        spread.withColumn(rank, within)
        .join(F.broadcast(starts), F.col(part) == F.col(part_of))
        .withColumn(alias, F.when(F.col(chosen), base + F.col(before) + F.col(rank)))
        .drop(text, chosen, part, part_of, rank, before)
    )


def meets(constraints: Iterable[str]) -> Column:
    """True when every constraint (Spark SQL text) holds; NULL counts as not broken, as in CHECK."""
    result = F.lit(True)
    for constraint in constraints:
        result = result & F.coalesce(F.expr(constraint), F.lit(True))
    return result


def publishable(df: DataFrame, *, required: Iterable[str], constraints: Iterable[str] = ()) -> DataFrame:
    """Rows that satisfy NOT NULL columns and CHECK constraints."""
    for column in required:
        df = df.where(F.col(column).isNotNull())
    return df.where(meets(constraints))


def insert_if_absent(target: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key the target does not have yet."""
    return rows.join(target.select(*key).distinct(), key, "left_anti")


def unique_by(df: DataFrame, key: list[str], side: str) -> DataFrame:
    """The same rows; a key that is there twice, or is NULL, ends the job with a message."""
    missing = F.lit(False)
    for column in key:
        missing = missing | F.col(column).isNull()
    copies = F.count("*").over(Window.partitionBy(*key))
    checked = F.when(missing, F.raise_error(F.lit(f"{side}: a key in {key} is NULL"))).when(
        copies > 1, F.raise_error(F.lit(f"{side}: a key in {key} is there twice"))
    )
    return df.withColumn("_checked", checked.cast("string")).where("_checked IS NULL").drop("_checked")


def merge_by_key(
    base: DataFrame, updates: DataFrame, key: list[str], *, on_conflict: str = "ignore", columns: list[str] | None = None
) -> DataFrame:
    """Upsert: new keys are added; known keys stay (ignore) or take the listed columns (update).

    Both sides hold a key once, else the job fails. A listed column is taken even when its new value is NULL.
    """
    base, updates = unique_by(base, key, "base"), unique_by(updates, key, "updates")
    rest = [c for c in base.columns if c not in key]
    listed = (rest if columns is None else columns) if on_conflict == "update" else []
    joined = base.select(*key, F.struct(*rest).alias("_b")).join(
        updates.select(*key, F.struct(*rest).alias("_u")), key, "full_outer"
    )
    known, offered = F.col("_b").isNotNull(), F.col("_u").isNotNull()

    def value(column: str) -> Column:
        take_update = ~known | offered if column in listed else ~known
        return F.when(take_update, F.col(f"_u.{column}")).otherwise(F.col(f"_b.{column}")).alias(column)

    return joined.select(*key, *[value(c) for c in rest])


def scd2_merge(
    dim: DataFrame, incoming: DataFrame, *, key: str, surrogate: str, attributes: list[str], as_of,
    last: int | None = None,
) -> DataFrame:
    """Type-2 merge: changed keys get their open version closed and a new one; others stay.

    Old and new versions of a key come out of one join; new versions continue the surrogate numbers. A key that is
    open or comes in twice, or comes in as NULL, ends the job with a message; versions with a NULL key stay as they are.
    ``last`` is the largest surrogate number there is, where ``dim`` is only a part of the dimension.
    """
    keyed = F.col("is_current") & F.col(key).isNotNull()
    open_rows = unique_by(dim.where(keyed), [key], "open versions").select(F.col(key), F.struct(*dim.columns).alias("_d"))
    fresh = unique_by(incoming, [key], "incoming").select(F.col(key), F.struct(*attributes).alias("_i"))
    joined = open_rows.join(fresh, key, "full_outer")
    known, offered = F.col("_d").isNotNull(), F.col("_i").isNotNull()
    same = F.lit(True)
    for column in attributes:
        same = same & F.col(f"_d.{column}").eqNullSafe(F.col(f"_i.{column}"))
    changed = known & offered & ~same

    def version(side: str, sk: Column, effective_from: Column, effective_to: Column, current: Column) -> Column:
        special = {
            surrogate: sk,
            key: F.col(key),
            "effective_from": effective_from,
            "effective_to": effective_to,
            "is_current": current,
        }
        return F.struct(
            *[special.get(c, F.col(f"{side}.{c}")).cast(dim.schema[c].dataType).alias(c) for c in dim.columns]
        )

    never = F.lit(None).cast("timestamp_ntz")
    old = version(
        "_d",
        F.col(f"_d.{surrogate}"),
        F.col("_d.effective_from"),
        F.when(changed, moment(as_of)).otherwise(F.col("_d.effective_to")),
        ~changed,
    )
    new = version("_i", F.lit(None), moment(as_of), never, F.lit(True))
    versions = joined.select(
        F.explode(F.array_compact(F.array(F.when(known, old), F.when(changed | ~known, new)))).alias("v")
    ).select("v.*")
    highest = dim.agg(F.coalesce(F.max(surrogate), F.lit(0).cast("bigint"))).scalar() if last is None else F.lit(last)
    numbered = number_rows(versions, F.col(key), "_number", where=F.col(surrogate).isNull())
    current = numbered.withColumn(surrogate, F.coalesce(F.col(surrogate), F.col("_number") + highest))
    return dim.where(~F.coalesce(keyed, F.lit(False))).unionByName(current.select(*dim.columns))


def publish_fact(
    rows: DataFrame, dim: DataFrame, *, dim_key: str, dim_surrogate: str, reference: str
) -> tuple[DataFrame, DataFrame]:
    """Swap the business key for the current surrogate key; (resolved, unresolved) rows."""
    lookup = dim.where("is_current").select(F.col(dim_key).alias(reference), F.col(dim_surrogate))
    joined = rows.join(lookup, reference, "left")
    found = F.col(dim_surrogate).isNotNull()
    return joined.where(found), joined.where(~found).drop(dim_surrogate)
