"""Counts taken while rows are written: rows in, out and diverted, and each rule's violations, without a second scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators.attach import unused
from tablewarden.operators.evaluate import _described, _rows, any_violation, graded
from tablewarden.operators.rules import Rule


@dataclass(frozen=True)
class Split:
    """What was written to a folder, and what was counted on the way."""

    path: str
    schema: T.StructType
    flag: str
    counts: dict[str, int]
    violations: dict[str, int]

    def _read(self, spark: SparkSession, diverted: bool) -> DataFrame:
        kept = T.StructType([*self.schema.fields, T.StructField(self.flag, T.BooleanType())])
        rows = spark.read.schema(kept).parquet(self.path).where(F.col(self.flag) == diverted)
        return rows.select(*[F.col(f"`{c}`") for c in self.schema.names])

    def clean(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, False)

    def diverted(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, True)

    def run_row_counts(self, spark: SparkSession) -> DataFrame:
        """The one row of ``evaluate.run_row_counts``."""
        names = ["records_in", "records_out", "records_diverted"]
        return spark.range(1).select(*[F.lit(self.counts[n]).cast("bigint").alias(n) for n in names])

    def results(self, spark: SparkSession, rules: Sequence[Rule], *, run_id: str, as_of) -> DataFrame:
        """Rule results as ``evaluate`` gives them, from the counts of the write."""
        described = [_described(r, str(self.counts["records_in"]), str(self.violations[r.rule_id])) for r in rules if r.active]
        return graded(spark.range(1).select(_rows(described)), run_id=run_id, as_of=as_of)


def write_split(df: DataFrame, rules: Sequence[Rule], path: str) -> Split:
    """Write rows to ``path``, those that break a row rule apart from the others, and count in the same job.

    The input is read once. Counts come from the tasks that write, whose updates Spark takes once each, also when a task is
    run again. The folder is replaced. Rules that are not predicates of a row cannot be counted on the way.
    """
    active = [r for r in rules if r.active]
    for rule in active:
        if rule.violation is None:
            raise ValueError(f"{rule.rule_id}: only row rules can be counted while rows are written")
    (flag,) = unused(df.columns, "diverted")
    watch, bad = Observation(), F.coalesce(F.col(flag), F.lit(False))
    each = [F.count_if(F.coalesce(r.bad, F.lit(False))).alias(f"rule_{i}") for i, r in enumerate(active)]
    tagged = df.withColumn(flag, any_violation(active)).observe(
        watch, F.count(F.lit(1)).alias("records_in"), F.count_if(~bad).alias("records_out"),
        F.count_if(bad).alias("records_diverted"), *each,
    )
    tagged.write.mode("overwrite").partitionBy(flag).parquet(path)
    seen = watch.get
    violations = {r.rule_id: int(seen[f"rule_{i}"]) for i, r in enumerate(active)}
    return Split(path, df.schema, flag, {n: int(v) for n, v in seen.items() if n.startswith("records_")}, violations)
