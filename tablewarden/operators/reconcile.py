"""Source-to-target reconciliation: scalar checks with a tolerance, and keyed comparison."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.hashing import hex_to_decimal, row_digest
from tablewarden.functions.timing import moment
from tablewarden.operators.dedup import latest_per_key
from tablewarden.schemas import CHECK_TYPES

NUMBER = "decimal(38,6)"


@dataclass(frozen=True)
class Check:
    """One reconciliation job.

    measure: for sum_check a number expression, for distinct_check, null_check and orphan_check a column,
             for hash_check a comma-separated column list. ``target_measure`` if it differs in the target.
    where:   filters on either side.
    parent:  (table, column) for orphan_check, whose source side is always 0.
    """

    job_id: int
    job_name: str
    check_type: str
    source: str
    target: str
    measure: str | None = None
    target_measure: str | None = None
    source_where: str = "true"
    target_where: str = "true"
    tolerance_pct: float = 0.0
    parent: tuple[str, str] | None = None
    active: bool = True

    def __post_init__(self):
        if self.check_type not in CHECK_TYPES:
            raise ValueError(f"unknown check type {self.check_type}")


# --- comparison ----------------------------------------------------------------
def diff_pct(source: Column, target: Column) -> Column:
    """Absolute difference in percent of the source (of 1 when the source is 0), 6 decimals."""
    base = F.when(source == 0, F.lit(1).cast(NUMBER)).otherwise(F.abs(source))
    return F.round(F.abs(target - source) * 100 / base, 6)


def recon_status(source: Column, target: Column, tolerance: Column) -> Column:
    """ERROR without both values, PASS without difference, WARN within tolerance, else FAIL.

    The exact difference decides, not the rounded percentage: one lost row of any number is no PASS.
    """
    gap, base = F.abs(target - source), F.when(source == 0, F.lit(1).cast(NUMBER)).otherwise(F.abs(source))
    return (
        F.when(source.isNull() | target.isNull(), "ERROR")
        .when(gap == 0, "PASS")
        .when(gap.cast("double") * 100 <= tolerance.cast("double") * base.cast("double"), "WARN")
        .otherwise("FAIL")
    )


def compared(values: DataFrame) -> DataFrame:
    """Add diff, diff_pct and status to (source_value, target_value, tolerance_pct) rows."""
    source, target = F.col("source_value").cast(NUMBER), F.col("target_value").cast(NUMBER)
    return (
        values.withColumn("diff", target - source)
        .withColumn("diff_pct", diff_pct(source, target))
        .withColumn("status", recon_status(source, target, F.col("tolerance_pct")))
    )


# --- scalars ---------------------------------------------------------------------
def fingerprint(columns: list[str], keep: Column) -> Column:
    """Order-independent total of the 64-bit hashes of the kept rows. A sum, since XOR would cancel duplicate rows."""
    total = F.sum(F.when(keep, hex_to_decimal(row_digest([F.col(c.strip()) for c in columns]))))
    return F.coalesce(total, F.lit(0).cast("decimal(30,0)"))


def _scalar(check: Check, measure: str | None, where: str) -> Column:
    keep = F.expr(where)
    if check.check_type == "row_count":
        return F.count_if(keep)
    if check.check_type == "sum_check":
        return F.coalesce(F.sum(F.when(keep, F.expr(measure))), F.lit(0))
    if check.check_type == "distinct_check":
        return F.count_distinct(F.when(keep, F.col(measure)))
    if check.check_type == "null_check":
        return F.count_if(keep & F.col(measure).isNull())
    if check.check_type == "hash_check":
        return fingerprint(measure.split(","), keep)
    raise ValueError(check.check_type)


def _orphans(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """Target rows whose reference is missing; references are counted before the join."""
    table, column = check.parent
    references = (
        tables[check.target]
        .where(F.expr(check.target_where))
        .groupBy(F.col(check.measure).alias("reference"))
        .agg(F.count("*").alias("copies"))
    )
    known = tables[table].select(F.col(column).alias("reference")).distinct()
    return references.join(known, "reference", "left_anti").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast(NUMBER).alias("value")
    )


def reconcile(tables: Mapping[str, DataFrame], checks: Iterable[Check], *, run_id: str, as_of) -> DataFrame:
    """All active jobs: one aggregate per table holds every scalar of that table."""
    active = [c for c in checks if c.active]
    wanted: dict[str, list[tuple[int, str, Column]]] = {}
    sides = []
    for c in active:
        if c.check_type == "orphan_check":
            found = _orphans(tables, c)
            zero = F.lit(0).cast(NUMBER)
            rows = F.array(
                F.struct(F.lit(c.job_id).alias("job_id"), F.lit("s").alias("side"), zero.alias("value")),
                F.struct(F.lit(c.job_id).alias("job_id"), F.lit("t").alias("side"), F.col("value")),
            )
            sides.append(found.select(F.inline(rows)))
            continue
        wanted.setdefault(c.source, []).append((c.job_id, "s", _scalar(c, c.measure, c.source_where)))
        target_measure = c.target_measure or c.measure
        wanted.setdefault(c.target, []).append((c.job_id, "t", _scalar(c, target_measure, c.target_where)))
    for table, scalars in wanted.items():
        wide = tables[table].agg(*[v.cast(NUMBER).alias(f"v{i}") for i, (_, _, v) in enumerate(scalars)])
        rows = F.array(
            *[
                F.struct(F.lit(job).alias("job_id"), F.lit(side).alias("side"), F.col(f"v{i}").alias("value"))
                for i, (job, side, _) in enumerate(scalars)
            ]
        )
        sides.append(wide.select(F.inline(rows)))
    values = sides[0]
    for side in sides[1:]:
        values = values.unionByName(side)
    pairs = values.groupBy("job_id").agg(
        F.max(F.when(F.col("side") == "s", F.col("value"))).alias("source_value"),
        F.max(F.when(F.col("side") == "t", F.col("value"))).alias("target_value"),
    )
    return compared(_described(pairs, active)).withColumn("run_id", F.lit(run_id)).withColumn(
        "executed_at", moment(as_of)
    )


def _described(pairs: DataFrame, checks: list[Check]) -> DataFrame:
    """Attach name, type and tolerance of each job."""

    def pick(values: dict[int, object], kind: str) -> Column:
        lookup = F.create_map(*[F.lit(x) for item in values.items() for x in item])
        return lookup[F.col("job_id")].cast(kind)

    return pairs.select(
        "job_id",
        pick({c.job_id: c.job_name for c in checks}, "string").alias("job_name"),
        pick({c.job_id: c.check_type for c in checks}, "string").alias("check_type"),
        "source_value",
        "target_value",
        pick({c.job_id: float(c.tolerance_pct) for c in checks}, "decimal(7,4)").alias("tolerance_pct"),
    )


# --- keyed comparison ----------------------------------------------------------------
def _both_sides(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Source and target rows below each other, marked by side."""
    wanted = [*keys, *columns]
    return (
        source.select(*wanted).withColumn("_source", F.lit(True))
        .unionByName(target.select(*wanted).withColumn("_source", F.lit(False)))
    )


def keyed_diff(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Status and changed columns per key: MATCH, CHANGED, MISSING_IN_TARGET or MISSING_IN_SOURCE.

    The sides are stacked and aggregated by key rather than joined: a key that holds very many rows
    is reduced before the shuffle and never paired with itself. Values are compared by 64-bit hashes, whose
    totals and maxima have a fixed size, so hash aggregates apply and nothing is sorted. With several rows per
    key, the number of rows and the total of their hashes must agree as well.
    """
    from_source = F.col("_source")
    signed = F.when(from_source, F.lit(1)).otherwise(F.lit(-1)).cast("decimal(1,0)")

    def total(*of: str) -> Column:
        return F.sum(F.xxhash64(*of).cast("decimal(20,0)") * signed)

    sides = [(f"_s{i}", f"_t{i}", f"_d{i}", c) for i, c in enumerate(columns)]
    measures = []
    for s, t, d, c in sides:
        measures += [F.max(F.when(from_source, F.xxhash64(c))).alias(s), F.max(F.when(~from_source, F.xxhash64(c))).alias(t), total(c).alias(d)]
    per_key = _both_sides(source, target, keys, columns).groupBy(*keys).agg(
        F.count_if(from_source).alias("source_rows"),
        F.count_if(~from_source).alias("target_rows"),
        total(*columns).alias("_hash"),
        *measures,
    )
    equal_rows = F.col("source_rows") == F.col("target_rows")
    different = [F.when((F.col(s) != F.col(t)) | (equal_rows & (F.col(d) != 0)), F.lit(c)) for s, t, d, c in sides]
    paired = (F.col("source_rows") > 0) & (F.col("target_rows") > 0)
    changed = (F.size("changed_columns") > 0) | ~equal_rows | (F.col("_hash") != 0)
    return (
        per_key.withColumn("changed_columns", F.when(paired, F.array_compact(F.array(*different))))
        .withColumn(
            "status",
            F.when(F.col("target_rows") == 0, "MISSING_IN_TARGET")
            .when(F.col("source_rows") == 0, "MISSING_IN_SOURCE")
            .when(changed, "CHANGED")
            .otherwise("MATCH"),
        )
        .drop("_hash", *[n for names in sides for n in names[:3]])
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count("*").alias("key_count"))


def column_mismatches(diff: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: matched keys and how many of them differ in it."""
    paired = diff.where(F.col("status").isin("MATCH", "CHANGED"))
    wide = paired.agg(
        F.count("*").alias("compared"),
        *[F.count_if(F.array_contains("changed_columns", c)).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col("compared"), F.col(f"m{i}").alias("mismatches"))
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(rows))


def row_hash_check(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Compare MD5 row hashes by key; one row of counts."""
    hashed = [df.select(*keys, row_digest([F.col(c) for c in columns]).alias("digest")) for df in (source, target)]
    diff = keyed_diff(hashed[0], hashed[1], keys, ["digest"])
    return diff.agg(
        F.count_if(F.col("status") == "MATCH").alias("matched"),
        F.count_if(F.col("status") == "CHANGED").alias("mismatched"),
        F.count_if(F.col("status") == "MISSING_IN_TARGET").alias("source_only"),
        F.count_if(F.col("status") == "MISSING_IN_SOURCE").alias("target_only"),
    )


def key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary-key test: rows, NULL keys and surplus copies."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, F.col("copies"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~missing, F.col("copies") - 1)), F.lit(0)).alias("duplicate_rows"),
    )


def foreign_key_check(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key test: rows, NULL references and references that do not resolve."""
    references = child.groupBy(F.col(column).alias("reference")).agg(F.count("*").alias("copies"))
    known = parent.select(F.col(parent_column).alias("reference")).distinct().withColumn("known", F.lit(True))
    reference = F.col("reference")
    return references.join(known, "reference", "left").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(reference.isNull(), F.col("copies"))), F.lit(0)).alias("null_references"),
        F.coalesce(
            F.sum(F.when(reference.isNotNull() & F.col("known").isNull(), F.col("copies"))), F.lit(0)
        ).alias("orphans"),
    )


def latest_results(results: DataFrame) -> DataFrame:
    """Newest result per job."""
    return latest_per_key(results, ["job_name"], "executed_at", ["execution_id"])
