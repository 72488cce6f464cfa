"""Evidence tables and report exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.session import new_path


def write_evidence(df: DataFrame, path: str, *, run_date: str, run_id: str) -> None:
    """Add the rows of one run. Writing the run again replaces its partition, nothing else, also by no rows."""
    folder = f"{path}/run_date={_escaped(run_date)}/run_id={_escaped(run_id)}"
    # ids and payloads are most of the evidence; zstd halves them
    df.drop("run_date", "run_id").write.mode("overwrite").option("compression", "zstd").parquet(folder)


def _escaped(value: str) -> str:
    """A partition value as a folder name, as Spark reads it back."""
    return "".join(c if c.isalnum() or c in "-_." else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def read_evidence(spark, path: str) -> DataFrame:
    """All runs of an evidence table; run_date and run_id are text, whatever they look like."""
    found = spark.read.parquet(path).schema
    text = T.StructType([T.StructField(n, T.StringType()) for n in ("run_date", "run_id")])
    own = T.StructType([f for f in found.fields if f.name not in ("run_date", "run_id")] + text.fields)
    return spark.read.schema(own).parquet(path)


def export_reports(
    reports: Mapping[str, DataFrame],
    folder: str,
    *,
    stamp: str,
    fmt: str = "csv",
    execution_id: int | None = None,
    since: str | None = None,
) -> list[str]:
    """One output per report, named ``<report>_<stamp>``, filtered where the report has the column."""
    paths = []
    for name, df in reports.items():
        if execution_id is not None and "execution_id" in df.columns:
            df = df.where(F.col("execution_id") == execution_id)
        if since is not None:
            for column in ("started_at", "run_date"):
                if column in df.columns:
                    df = df.where(F.col(column) >= F.lit(since).cast(df.schema[column].dataType))
                    break
        path = f"{folder}/{name}_{stamp}"
        writer = df.write.mode("error")
        writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)
        paths.append(path)
    return paths


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result once to the shared folder and read it back, for plans that use it several times."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
