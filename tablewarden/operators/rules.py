"""Rule definitions: a row predicate, a key, a parent reference, a table of allowed values or a selector of bad rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden import schemas

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Rule:
    """One check on one table. Exactly one of violation, key, parent, allowed or selector is given.

    violation: boolean Spark SQL text, true for a bad row (NULL counts as good, as in WHERE)
    key:       columns that must be unique together; surplus copies are the bad rows
    parent:    (table, column) that ``column`` must exist in
    selector:  function from the tables to the bad rows
    allowed:   (table, column) with the values that ``column`` may take, any number of them; NULL passes
    """

    rule_id: str
    name: str
    table: str
    dimension: str
    severity: str = "HIGH"
    column: str | None = None
    min_pass_pct: float = 100.0
    violation: str | None = None
    key: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    selector: Callable[[Tables], DataFrame] | None = None
    schema: str = "main"
    active: bool = True
    domain: str = "GLOBAL"
    description: str = ""
    allowed: tuple[str, str] | None = None

    def __post_init__(self):
        dimension = self.dimension.lower()
        dimension = "integrity" if dimension == "referential" else dimension
        object.__setattr__(self, "dimension", dimension)
        if dimension not in schemas.DIMENSIONS:
            raise ValueError(f"{self.rule_id}: unknown dimension {self.dimension}")
        if self.severity not in schemas.SEVERITIES:
            raise ValueError(f"{self.rule_id}: unknown severity {self.severity}")
        given = [self.violation is not None, bool(self.key), self.parent is not None, self.selector is not None]
        given.append(self.allowed is not None)
        if sum(given) != 1:
            raise ValueError(f"{self.rule_id}: give one of violation, key, parent, allowed, selector")
        if self.allowed is not None and self.column is None:
            raise ValueError(f"{self.rule_id}: name the column that takes the allowed values")

    @property
    def bad(self) -> Column:
        return F.expr(self.violation)


def min_pass(max_fail_pct: float) -> float:
    """Turn a tolerated failure rate into the pass rate the engine compares with."""
    return 100.0 - max_fail_pct


# --- predicate texts -----------------------------------------------------------
def name(column: str) -> str:
    return f"`{column}`"


def literal(value) -> str:
    """A Spark SQL literal; text is a raw string, so regular expressions survive, or escaped if it has both quotes."""
    if isinstance(value, str):
        quote = '"' if "'" in value else "'"
        if quote in value:
            escaped = value.replace("\\", "\\\\").replace("'", "\\'")
            return f"'{escaped}'"
        return f"r{quote}{value}{quote}"
    return repr(value)


def _null_policy(column: str, test: str, null_policy: str) -> str:
    if null_policy == "fail":
        return f"{name(column)} IS NULL OR {test}"
    if null_policy == "pass":
        return test
    raise ValueError(f"null_policy is pass or fail, not {null_policy}")


def is_blank(column: str) -> str:
    """Completeness: NULL or empty text."""
    return f"{name(column)} IS NULL OR {name(column)} = ''"


def is_null(column: str) -> str:
    return f"{name(column)} IS NULL"


def not_matching(column: str, pattern: str, *, ignore_case: bool = True) -> str:
    """Validity: text that the pattern does not match; NULL and '' are left to completeness rules."""
    flag = "(?i)" if ignore_case else ""
    return f"{name(column)} <> '' AND NOT {name(column)} RLIKE {literal(flag + pattern)}"


def not_positive(column: str, *, null_policy: str = "pass") -> str:
    return _null_policy(column, f"{name(column)} <= 0", null_policy)


def outside_range(column: str, low, high, *, null_policy: str = "fail") -> str:
    """Accuracy: outside the closed range."""
    return _null_policy(column, f"{name(column)} < {low} OR {name(column)} > {high}", null_policy)


def after(column: str, as_of: str, *, null_policy: str = "pass") -> str:
    """Timeliness: later than the given moment. Text that is no date is bad as well."""
    stamp = f"try_cast({name(column)} AS timestamp_ntz)"
    late = f"{stamp} > timestamp_ntz'{as_of}'"
    unreadable = f"({name(column)} IS NOT NULL AND {stamp} IS NULL)"
    return _null_policy(column, f"{late} OR {unreadable}", null_policy)


def not_in_set(column: str, allowed: Iterable, *, standardize: bool = False) -> str:
    """Validity: not in a short list of allowed values. NULL passes, as with NOT IN."""
    value = f"upper(trim({name(column)}))" if standardize else name(column)
    return f"{value} NOT IN ({', '.join(literal(v) for v in allowed)})"


# --- the catalogue as a table ----------------------------------------------------
@dataclass(frozen=True)
class SqlSelector:
    """Bad rows as a SELECT over tables written in braces, such as ``{orders}``; unlike a function it can be stored."""

    sql: str

    def __call__(self, tables: Tables) -> DataFrame:
        used = {name for _, name, _, _ in Formatter().parse(self.sql) if name}
        frames = {name: tables[name] for name in used}
        return next(iter(frames.values())).sparkSession.sql(self.sql, **frames)


def catalog(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rule definitions of every kind as rows; selectors must be SQL."""
    rows = []
    for r in rules:
        if r.selector is not None and not isinstance(r.selector, SqlSelector):
            raise ValueError(f"{r.rule_id}: a selector in Python cannot be stored, use SqlSelector")
        rows.append(
            (r.rule_id, r.name, r.schema, r.table, r.column, r.dimension, r.severity, r.violation,
             float(r.min_pass_pct), r.active, r.domain, r.description, list(r.key) or None,
             r.parent and r.parent[0], r.parent and r.parent[1], r.selector and r.selector.sql,
             r.allowed and r.allowed[0], r.allowed and r.allowed[1])
        )
    return spark.createDataFrame(rows, schemas.RULES)


def from_catalog(rows: DataFrame, *, table: str | None = None) -> list[Rule]:
    """Active rules of a catalogue table, optionally of one table only. A row without a definition is an error."""
    wanted = rows.where("is_active")
    if table is not None:
        wanted = wanted.where(F.col("table_name") == table)
    return [
        Rule(
            rule_id=r.rule_id, name=r.rule_name, schema=r.schema_name, table=r.table_name,
            column=r.column_name, dimension=r.dimension, severity=r.severity, violation=r.expr,
            min_pass_pct=r.min_pass_pct, domain=r.data_domain, description=r.description or "",
            key=tuple(r.key_columns or ()), parent=(r.parent_table, r.parent_column) if r.parent_table else None,
            selector=SqlSelector(r.selector) if r.selector else None,
            allowed=(r.allowed_table, r.allowed_column) if r.allowed_table else None,
        )
        for r in wanted.orderBy("rule_id").collect()  # one row per rule, never data rows
    ]


def custom(rule_id: str, table: str, expr: str, **options) -> Rule:
    """A user-written rule: any boolean Spark SQL expression over the table's columns."""
    options.setdefault("name", rule_id)
    options.setdefault("dimension", "validity")
    return Rule(rule_id=rule_id, table=table, violation=expr, **options)


def vocabulary_violations(rows: DataFrame, allowed: Mapping[str, list[str]]) -> DataFrame:
    """Values outside the vocabulary of their column, with the number of rows that hold them."""
    bad = [
        F.when(~F.col(column).isin(values), F.struct(F.lit(column).alias("column_name"), F.col(column).alias("value")))
        for column, values in allowed.items()
    ]
    return (
        rows.select(F.explode(F.array_compact(F.array(*bad))).alias("bad"))
        .groupBy("bad.column_name", "bad.value")
        .agg(F.count("*").alias("row_count"))
    )
