"""Typed and permissive loads, and the column catalogue."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.timing import moment

BAD_RECORD = "_corrupt_record"


def load_csv(spark: SparkSession, path: str, schema: str, *, keep_bad_lines: bool = True) -> DataFrame:
    """Typed CSV with a header; an empty field is NULL, a line that does not fit keeps its text aside."""
    reader = spark.read.option("header", True).option("nullValue", "").option("emptyValue", "")
    reader = reader.option("multiLine", False).option("mode", "PERMISSIVE")
    if keep_bad_lines:
        schema = f"{schema}, {BAD_RECORD} string"
        reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.schema(schema).csv(path)


def stage(df: DataFrame, *, load_id: int, load_ts, types: Mapping[str, str] | None = None) -> DataFrame:
    """Permissive staging: every column as text unless ``types`` names another type, plus the load columns."""
    wanted = types or {}
    columns = [F.col(c).try_cast(wanted.get(c, "string")).alias(c) for c in df.columns]
    return df.select(
        *columns, F.lit(load_id).cast("bigint").alias("load_id"), moment(load_ts).alias("load_ts")
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tables(spark: SparkSession, folder: str, names: list[str], only: str | None = None) -> dict[str, DataFrame]:
    """Several tables by name, or just the one asked for."""
    return {n: table(spark, folder, n) for n in names if only is None or n == only}


def optional_filters(df: DataFrame, equal: Mapping[str, object] | None = None, since: tuple | None = None) -> DataFrame:
    """Keep rows equal to every value that is given; None means no condition. ``since`` is (column, moment)."""
    for column, value in (equal or {}).items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    if since is not None and since[1] is not None:
        df = df.where(F.col(since[0]) >= moment(since[1]))
    return df


def column_catalog(spark: SparkSession, tables: Mapping[str, DataFrame], schema: str = "main") -> DataFrame:
    """One row per column: schema, table, column, type and position."""
    rows = [
        (schema, name, field.name, field.dataType.simpleString(), position)
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "schema_name string, table_name string, column_name string, data_type string, ordinal int"
    )


def populated_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with a value per table and column, one scan per table."""
    result = None
    for name, df in tables.items():
        wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("populated_rows")) for c in df.columns])
        one = wide.select(F.lit(name).alias("table_name"), F.inline(rows))
        result = one if result is None else result.unionByName(one)
    return result


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of many tables as one result."""
    frames = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def guarded_number(column: Column, pattern: str, kind: str = "decimal(18,2)") -> Column:
    """Number from text that matches the pattern, else NULL."""
    return F.when(column.rlike(pattern), column.try_cast(kind))
