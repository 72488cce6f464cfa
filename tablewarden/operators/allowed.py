"""Allowed values as a table of any size: a Bloom filter settles most bad rows in the scan, a join settles the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.attach import unused
from tablewarden.sources.writers import stored

BITS = 16  # of the filter per allowed value
PROBES = 4  # bits a value sets, all in one word of 64 bits
WORDS = 64  # words per row of the filter
MOST = 64 << 20  # bytes of the filter that are broadcast; a larger set is joined without a filter


def allowed_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of an allowed set, written once because filter and join both read them."""
    return stored(df.select(_settled(df, column).alias("value")).where("value IS NOT NULL").distinct(), "allowed")


def _settled(df: DataFrame, column: str) -> Column:
    """A column whose equal values hash alike: zero has one sign."""
    value = F.col(f"`{column}`")
    return value + F.lit(0).cast(df.schema[column].dataType) if _kind(df, column) in ("float", "double") else value


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _place(value: Column, words: int) -> tuple[Column, Column]:
    """Word of the filter and the bits in it that a value sets, from two independent hashes."""
    bits = F.xxhash64(value, F.lit("bits"))
    mask = F.lit(0).cast("bigint")
    for i in range(PROBES):
        probe = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), probe))
    return F.pmod(F.xxhash64(value), F.lit(words).cast("bigint")), mask


def bloom(values: DataFrame, words: int) -> DataFrame:
    """The filter of ``values.value``: (part, bits), WORDS words of 64 bits in each row. ``words`` is a multiple of WORDS."""
    word, mask = _place(F.col("value"), words)
    spark = values.sparkSession
    empty = spark.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    per_word = values.select(word.alias("word"), mask.alias("mask")).unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "mask")))  # WORDS entries
    per_part = per_word.groupBy(F.floor(F.col("word") / WORDS).alias("part")).agg(in_order.alias("words"))
    return per_part.select("part", F.col("words.mask").alias("bits"))


def screened(df: DataFrame, column: str, values: DataFrame, most: int = MOST) -> tuple[DataFrame, str, str]:
    """``df`` with a value and a flag, and the names of both: the flag is true only where the value is surely not allowed.

    The filter is broadcast if it has at most ``most`` bytes; the allowed values are counted for that. Beyond, no flag is
    true and the join decides alone. NULL has no flag.
    """
    value, sure, part, bits = unused(df.columns, "_value", "_sure", "_filter_part", "_filter_bits")
    if _kind(df, column) != _kind(values, "value"):
        raise ValueError(f"{column} is {_kind(df, column)}, its allowed values are {_kind(values, 'value')}: cast one of them")
    rows = df.withColumn(value, _settled(df, column))
    words = -(-values.count() * BITS // (64 * WORDS)) * WORDS
    if not words:
        return rows.withColumn(sure, F.col(value).isNotNull()), value, sure
    if words * 8 > most:
        return rows.withColumn(sure, F.lit(False)), value, sure
    word, mask = _place(F.col(value), words)
    known = bloom(values, words).toDF(part, bits)
    joined = rows.join(F.broadcast(known), F.floor(word / WORDS) == F.col(part), "left")
    held = F.get(F.col(bits), (word % WORDS).cast("int"))
    absent = F.col(value).isNotNull() & (held.bitwiseAND(mask) != mask)
    return joined.withColumn(sure, absent).drop(part, bits), value, sure


def counts(df: DataFrame, column: str, values: DataFrame, most: int = MOST) -> DataFrame:
    """(total, bad): all rows, and rows whose value is not among ``values.value``; NULL passes, as with NOT IN.

    Rows the filter rejects are only counted. The others are counted per value before any shuffle, so that a hot value is
    one row per task, and the counts are joined with the allowed values.
    """
    rows, value, sure = screened(df, column, values, most)
    per_value = rows.groupBy(F.when(~F.col(sure), F.col(value)).alias("value")).agg(
        F.count("*").alias("copies"), F.count_if(sure).alias("rejected")
    )
    joined = per_value.join(values.withColumn("known", F.lit(True)), "value", "left")
    stray = F.when(F.col("value").isNotNull() & F.col("known").isNull(), F.col("copies")).otherwise(F.col("rejected"))
    return joined.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total"), F.coalesce(F.sum(stray), F.lit(0)).alias("bad"))


def stray_rows(df: DataFrame, column: str, values: DataFrame, most: int = MOST) -> DataFrame:
    """The rows whose value is not among ``values.value``.

    Those the filter rejects are taken as they are; of the others, values are made distinct and joined with the allowed
    ones, and only rows of the few values that the filter let through by mistake are joined.
    """
    rows, value, sure = screened(df, column, values, most)
    maybe = rows.where(~F.col(sure) & F.col(value).isNotNull())
    missing = maybe.select(F.col(value).alias("value")).distinct().join(values, "value", "left_anti").toDF(value)
    let_through = maybe.join(missing, value, "left_semi").select(*rows.columns)
    return rows.where(sure).unionByName(let_through).select(*[F.col(f"`{c}`") for c in df.columns])
