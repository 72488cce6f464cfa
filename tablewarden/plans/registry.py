"""Query registry and small helpers shared by the bindings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.sources.readers import table




@dataclass(frozen=True)
class Registered:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Registered] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(load)``; ``load`` returns a table of the data folder by name."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(function(Loader(spark, folder)))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Registered(name, run, sql)
        return function

    return register


class Loader:
    """Tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


def plain(df: DataFrame) -> DataFrame:
    """Types both engines spell alike: decimals as doubles, moments and days as text, arrays joined."""
    columns = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(col, ",")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        columns.append(col.alias(field.name))
    return df.select(*columns)


# --- SQL snippets --------------------------------------------------------------------
def stamp_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def day_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def draw_sql(key: str, op: str) -> str:
    return f"('0x' || substr(md5('42|{op}|' || {key}), 1, 8))::BIGINT"


def chosen_sql(key: str, op: str, prob: float) -> str:
    return f"{draw_sql(key, op)} < {int(prob * 2**32)}"


def rate_sql(total: str, bad: str) -> str:
    return f"CASE WHEN {total} = 0 THEN 100.0::DOUBLE ELSE round(({total} - {bad}) * 100.0::DOUBLE / {total}, 4) END"


def grade_sql(total: str, bad: str, minimum: str) -> str:
    """Status by exact counts: the minimum has four decimals at most."""
    good, least = f"({total} - {bad}) * 1000000::HUGEINT", f"round({minimum} * 10000)::HUGEINT"
    return (
        f"CASE WHEN {good} >= {least} * {total} THEN 'PASS' WHEN {good} >= ({least} - 50000) * {total} THEN 'WARN' ELSE 'FAIL' END"
    )
