"""Rule evaluation: all row rules of a table in one scan, counts graded into results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.hashing import compact
from tablewarden.functions.timing import moment
from tablewarden.operators import allowed
from tablewarden.operators.rules import Rule, Tables, literal
from tablewarden.schemas import PCT

WARN_BAND = 5  # fixed value: percentage points below the minimum that only warn


# --- grading ------------------------------------------------------------------
def pass_rate(total: Column, violations: Column) -> Column:
    """Percentage of good rows, 4 decimals half up; an empty table passes."""
    good = ((total - violations) * 100).cast("decimal(20,0)")
    rate = F.round(good / F.nullif(total, F.lit(0)).cast("decimal(20,0)"), 4)
    return F.when(total == 0, F.lit(100)).otherwise(rate).cast(PCT)


def grade(total: Column, violations: Column, minimum: Column) -> Column:
    """Status from the exact counts: a rounded rate of 100 still fails a minimum of 100 when one row is bad."""
    good = ((total - violations) * 100).cast("decimal(24,0)")

    def reached(least: Column) -> Column:
        return good >= least * total.cast("decimal(20,0)")

    return F.when(reached(minimum), "PASS").when(reached(minimum - F.lit(WARN_BAND)), "WARN").otherwise("FAIL")


def _described(rule: Rule, total: str, violations: str, error: str | None = None) -> str:
    """One result row as a struct expression: literals of the rule plus its two counts."""
    fields = {
        "rule_id": literal(rule.rule_id),
        "rule_name": literal(rule.name),
        "schema_name": literal(rule.schema),
        "table_name": literal(rule.table),
        "column_name": "CAST(NULL AS string)" if rule.column is None else literal(rule.column),
        "dimension": literal(rule.dimension),
        "severity": literal(rule.severity),
        "data_domain": literal(rule.domain),
        "min_pass_pct": f"CAST({float(rule.min_pass_pct)!r} AS {PCT.simpleString()})",
        "total_rows": f"CAST({total} AS bigint)",
        "violation_count": f"CAST({violations} AS bigint)",
        "error_msg": "CAST(NULL AS string)" if error is None else literal(error),
    }
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _rows(described: Iterable[str]) -> Column:
    return F.expr(f"inline(array({', '.join(described)}))")


def graded(counts: DataFrame, *, run_id: str, as_of) -> DataFrame:
    """Pass rate and status for (total_rows, violation_count) rows; errors get neither a rate nor a pass."""
    failed = F.col("error_msg").isNotNull()
    rate = F.when(~failed, pass_rate(F.col("total_rows"), F.col("violation_count")))
    status = grade(F.col("total_rows"), F.col("violation_count"), F.col("min_pass_pct"))
    return (
        counts.withColumn("pass_rate_pct", rate)
        .withColumn("status", F.when(failed, "ERROR").otherwise(status))
        .withColumn("run_id", F.lit(run_id))
        .withColumn("executed_at", moment(as_of))
    )


# --- error isolation ------------------------------------------------------------
def analysis_error(df: DataFrame, rule: Rule) -> str | None:
    """Why Spark cannot analyse the rule on this table, or None. Only plans, never runs."""
    try:
        kind = df.select(rule.bad.alias("bad")).schema["bad"].dataType.typeName()
    except (AnalysisException, ParseException) as problem:
        return problem.getCondition() or type(problem).__name__
    return None if kind in ("boolean", "void") else f"NOT_BOOLEAN: {kind}"


def analysed(df: DataFrame, rules: list[Rule]) -> list[tuple[Rule, str | None]]:
    """Each rule with its analysis error; the rules are looked at one by one only if they fail together."""
    try:
        together = df.select(*[r.bad.alias(f"bad_{i}") for i, r in enumerate(rules)]).schema
    except (AnalysisException, ParseException):
        return [(rule, analysis_error(df, rule)) for rule in rules]
    if all(f.dataType.typeName() in ("boolean", "void") for f in together.fields):
        return [(rule, None) for rule in rules]
    return [(rule, analysis_error(df, rule)) for rule in rules]


# --- counting --------------------------------------------------------------------
def row_rule_counts(df: DataFrame, rules: Iterable[Rule], slice_by: list[Column] | None = None) -> DataFrame:
    """Total and violations of every row rule, from one aggregate over one scan."""
    checks = analysed(df, list(rules))
    counts = [F.count("*")] + [F.count_if(rule.bad) for rule, error in checks if not error]
    named = [i for i, (_, error) in enumerate(checks) if not error]
    grouped = df.groupBy(*slice_by) if slice_by else df.groupBy()
    wide = grouped.agg(*counts)
    slices = wide.columns[: len(wide.columns) - len(counts)]
    # counts get names that no slice column has
    mark = "_" * (1 + max([len(c) - len(c.lstrip("_")) for c in slices], default=0))
    aliases = [f"{mark}total"] + [f"{mark}bad_{i}" for i in named]
    wide = wide.toDF(*slices, *aliases)
    rows = _rows(
        _described(rule, f"{mark}total", "0" if error else f"{mark}bad_{i}", error) for i, (rule, error) in enumerate(checks)
    )
    return wide.select(*[F.col(f"`{c}`") for c in slices], rows)


def unique_rule_counts(df: DataFrame, rule: Rule) -> DataFrame:
    """Surplus copies over all keys. Copies are counted before the shuffle, so a hot key costs one row per task."""
    has_key = F.lit(True)
    for column in rule.key:
        has_key = has_key & F.col(column).isNotNull()
    # long texts are shuffled as digests
    keys = [
        F.expr(compact(f"`{c}`")).alias(c) if df.schema[c].dataType.typeName() == "string" else F.col(c) for c in rule.key
    ]
    per_key = df.select(*keys).groupBy(*rule.key).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(has_key, F.col("copies") - 1)), F.lit(0)).alias("bad"),
    ).select(_rows([_described(rule, "total", "bad")]))


def reference_rule_counts(df: DataFrame, rule: Rule, parent: DataFrame) -> DataFrame:
    """Rows whose reference is missing in the parent (NULL included).

    References are counted first and joined afterwards: one row per distinct reference, however hot it is.
    """
    _, parent_column = rule.parent
    references = df.groupBy(F.col(rule.column).alias("reference")).agg(F.count("*").alias("copies"))
    known = parent.select(F.col(parent_column).alias("reference")).distinct().withColumn("known", F.lit(True))
    joined = references.join(known, "reference", "left")
    return joined.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("copies"))), F.lit(0)).alias("bad"),
    ).select(_rows([_described(rule, "total", "bad")]))


def allowed_rule_counts(df: DataFrame, rule: Rule, table: DataFrame) -> DataFrame:
    """Rows whose value is not in the table of allowed values."""
    values = allowed.allowed_values(table, rule.allowed[1])
    return allowed.counts(df, rule.column, values).select(_rows([_described(rule, "total", "bad")]))


def selector_rule_counts(rule: Rule, tables: Tables) -> DataFrame:
    """Total from the table, violations from the rows the selector returns; counted side by side."""
    both = (
        tables[rule.table]
        .agg(F.count("*").alias("total"), F.lit(0).cast("bigint").alias("bad"))
        .unionByName(
            rule.selector(tables).agg(F.lit(0).cast("bigint").alias("total"), F.count("*").alias("bad"))
        )
    )
    return both.agg(F.sum("total").alias("total"), F.sum("bad").alias("bad")).select(_rows([_described(rule, "total", "bad")]))


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


# --- the operators -----------------------------------------------------------------
def evaluate(df: DataFrame, rules: Iterable[Rule], *, run_id: str, as_of, slice_by=None) -> DataFrame:
    """Results of the row rules of one table, optionally per slice (month, batch, domain)."""
    return graded(row_rule_counts(df, rules, slice_by), run_id=run_id, as_of=as_of)


def evaluate_tables(tables: Tables, rules: Iterable[Rule], *, run_id: str, as_of) -> DataFrame:
    """Results of all active rules: one fused scan per table for row rules, one aggregate per other rule."""
    active = [r for r in rules if r.active]
    frames = []
    for table in dict.fromkeys(r.table for r in active):
        row_rules = [r for r in active if r.table == table and r.violation is not None]
        if row_rules:
            frames.append(row_rule_counts(tables[table], row_rules))
    for rule in active:
        if rule.key:
            frames.append(unique_rule_counts(tables[rule.table], rule))
        elif rule.parent:
            frames.append(reference_rule_counts(tables[rule.table], rule, tables[rule.parent[0]]))
        elif rule.allowed:
            frames.append(allowed_rule_counts(tables[rule.table], rule, tables[rule.allowed[0]]))
        elif rule.selector:
            frames.append(selector_rule_counts(rule, tables))
    return graded(_union(frames), run_id=run_id, as_of=as_of)


def run_isolated(spark: SparkSession, df: DataFrame, rules: list[Rule], *, run_id: str, as_of) -> DataFrame:
    """Like evaluate, but runs the job now: a rule that fails while running becomes an ERROR row.

    The fused job is tried first; if it fails, the rules are halved until the faulty ones stand alone.
    """
    rows, failures = [], []

    def attempt(part: list[Rule]):
        try:
            rows.extend(row_rule_counts(df, part).collect())  # one row per rule
        except PySparkException as problem:
            if len(part) == 1:
                failures.append((part[0], problem.getCondition() or type(problem).__name__))
                return
            middle = len(part) // 2
            attempt(part[:middle])
            attempt(part[middle:])

    attempt(list(rules))
    shape = row_rule_counts(df, rules[:1]).schema
    frames = [spark.createDataFrame(rows, shape)]
    for rule, error in failures:
        described = _described(rule, "total", "0", error)
        frames.append(df.agg(F.count("*").alias("total")).select(_rows([described])))
    return graded(_union(frames), run_id=run_id, as_of=as_of)


def run_row_counts(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Rows in, rows without any violation, and rows diverted, in one scan."""
    bad = any_violation(rules)
    return df.agg(
        F.count("*").alias("records_in"),
        F.count_if(~bad).alias("records_out"),
        F.count_if(bad).alias("records_diverted"),
    )


def any_violation(rules: Iterable[Rule]) -> Column:
    """True when a row breaks at least one row rule; never NULL."""
    bad = F.lit(False)
    for rule in rules:
        bad = bad | F.coalesce(rule.bad, F.lit(False))
    return bad
