"""Bindings for rules, results and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden import schemas
from tablewarden.functions.hashing import chosen
from tablewarden.functions.text import EMAIL_LOOSE, EMAIL_NO_SPACE, EMAIL_STRICT
from tablewarden.functions.timing import moment
from tablewarden.operators import evaluate as ev
from tablewarden.operators import in_flight, incremental, publish, quarantine, runs, scoring
from tablewarden.operators import rules as r
from tablewarden.operators.rules import Rule, min_pass
from tablewarden.plans import inputs
from tablewarden.plans.registry import Loader, chosen_sql, grade_sql, query, rate_sql
from tablewarden.session import new_path
from tablewarden.sources import readers, writers

AS_OF = "2001-01-01 00:00:00"
RUN = "run-1"


# --- rule sets ------------------------------------------------------------------------
def row_rule(rule_id, table, column, dimension, severity, min_pass_pct, violation, name=None) -> Rule:
    return Rule(
        rule_id=rule_id, name=name or f"{table}.{column} {dimension}", table=table, column=column,
        dimension=dimension, severity=severity, min_pass_pct=min_pass_pct, violation=violation,
    )


# (rule, the same predicate for DuckDB)
LINEITEM_RULES = [
    (row_rule("LIN01", "lineitem", "l_returnflag", "completeness", "HIGH", 100, r.is_blank("l_returnflag")),
     "l_returnflag IS NULL OR l_returnflag = ''"),
    (row_rule("LIN02", "lineitem", "l_linestatus", "completeness", "HIGH", 100, r.is_blank("l_linestatus")),
     "l_linestatus IS NULL OR l_linestatus = ''"),
    (row_rule("LIN03", "lineitem", "l_orderkey", "completeness", "CRITICAL", 100, r.is_null("l_orderkey")),
     "l_orderkey IS NULL"),
    (row_rule("LIN04", "lineitem", "l_partkey", "completeness", "CRITICAL", 100, r.is_null("l_partkey")),
     "l_partkey IS NULL"),
    (row_rule("LIN05", "lineitem", "l_suppkey", "completeness", "CRITICAL", 100, r.is_null("l_suppkey")),
     "l_suppkey IS NULL"),
    (row_rule("LIN06", "lineitem", "l_quantity", "accuracy", "HIGH", 95, r.outside_range("l_quantity", 1, 45)),
     "l_quantity IS NULL OR l_quantity < 1 OR l_quantity > 45"),
    (row_rule("LIN07", "lineitem", "l_extendedprice", "accuracy", "HIGH", 100, r.not_positive("l_extendedprice")),
     "l_extendedprice <= 0"),
    (row_rule("LIN08", "lineitem", "l_extendedprice", "accuracy", "MEDIUM", 99, r.outside_range("l_extendedprice", 1, 90000)),
     "l_extendedprice IS NULL OR l_extendedprice < 1 OR l_extendedprice > 90000"),
    (row_rule("LIN09", "lineitem", "l_discount", "validity", "MEDIUM", 92, r.outside_range("l_discount", 0, 0.08)),
     "l_discount IS NULL OR l_discount < 0 OR l_discount > 0.08"),
    (row_rule("LIN10", "lineitem", "l_tax", "validity", "LOW", 85, r.outside_range("l_tax", 0, 0.07)),
     "l_tax IS NULL OR l_tax < 0 OR l_tax > 0.07"),
    (row_rule("LIN11", "lineitem", "l_returnflag", "validity", "HIGH", 100, r.not_in_set("l_returnflag", "ANR")),
     "l_returnflag NOT IN ('A', 'N', 'R')"),
    (row_rule("LIN12", "lineitem", "l_returnflag", "validity", "MEDIUM", min_pass(30), r.not_in_set("l_returnflag", "AN")),
     "l_returnflag NOT IN ('A', 'N')"),
    (row_rule("LIN13", "lineitem", "l_linestatus", "validity", "HIGH", 100, r.not_in_set("l_linestatus", "FO", standardize=True)),
     "upper(trim(l_linestatus)) NOT IN ('F', 'O')"),
    (row_rule("LIN14", "lineitem", "l_shipdate", "timeliness", "HIGH", 90, r.after("l_shipdate", AS_OF)),
     "l_shipdate > TIMESTAMP '2001-01-01'"),
    (row_rule("LIN15", "lineitem", "l_shipdate", "timeliness", "CRITICAL", 99.5, r.after("l_shipdate", "2001-10-01 00:00:00")),
     "l_shipdate > TIMESTAMP '2001-10-01'"),
    (row_rule("LIN16", "lineitem", "l_linestatus", "consistency", "MEDIUM", 95,
              "l_linestatus = 'O' AND l_shipdate < timestamp_ntz'1995-06-17 00:00:00'"),
     "l_linestatus = 'O' AND l_shipdate < TIMESTAMP '1995-06-17'"),
    (row_rule("LIN17", "lineitem", "l_returnflag", "consistency", "LOW", 80, "l_returnflag = 'N' AND l_linestatus = 'F'"),
     "l_returnflag = 'N' AND l_linestatus = 'F'"),
    (row_rule("LIN18", "lineitem", "l_quantity", "accuracy", "LOW", 100, "l_quantity <> floor(l_quantity)"),
     "l_quantity <> floor(l_quantity)"),
    (row_rule("LIN19", "lineitem", "l_extendedprice", "consistency", "MEDIUM", 90,
              "try_divide(l_extendedprice, l_quantity) < 900"),
     "l_extendedprice / l_quantity < 900"),
    (row_rule("LIN20", "lineitem", "l_linenumber", "validity", "LOW", 90, r.outside_range("l_linenumber", 1, 6)),
     "l_linenumber IS NULL OR l_linenumber < 1 OR l_linenumber > 6"),
]

OTHER_RULES = [
    (row_rule("ORD01", "orders", "o_orderpriority", "validity", "HIGH", 78,
              r.not_in_set("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"], standardize=True)),
     "upper(trim(o_orderpriority)) NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"),
    (row_rule("ORD02", "orders", "o_orderdate", "timeliness", "HIGH", 99.5, r.after("o_orderdate", AS_OF)),
     "o_orderdate > TIMESTAMP '2001-01-01'"),
    (row_rule("ORD03", "orders", "o_totalprice", "accuracy", "HIGH", 100, r.not_positive("o_totalprice", null_policy="fail")),
     "o_totalprice IS NULL OR o_totalprice <= 0"),
    (row_rule("ORD04", "orders", "o_orderstatus", "completeness", "CRITICAL", 100, r.is_blank("o_orderstatus")),
     "o_orderstatus IS NULL OR o_orderstatus = ''"),
    (row_rule("CUS01", "customer", "c_acctbal", "accuracy", "HIGH", 90, r.not_positive("c_acctbal")),
     "c_acctbal <= 0"),
    (row_rule("CUS02", "customer", "c_mktsegment", "consistency", "MEDIUM", 80,
              r.not_in_set("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"], standardize=True)),
     "upper(trim(c_mktsegment)) NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')"),
    (row_rule("SUP01", "supplier", "s_acctbal", "accuracy", "HIGH", 95, r.outside_range("s_acctbal", 0, 9000)),
     "s_acctbal IS NULL OR s_acctbal < 0 OR s_acctbal > 9000"),
    (row_rule("EVT01", "events", "value", "accuracy", "MEDIUM", 98, r.outside_range("value", 0, 100)),
     "value IS NULL OR value < 0 OR value > 100"),
]

UNIQUE_RULE = Rule("LIN21", "line keys unique", "lineitem", "uniqueness", "CRITICAL", "l_orderkey",
                   key=("l_orderkey", "l_linenumber"), min_pass_pct=80)
TEXT_RULE = Rule("DOC01", "texts unique", "documents", "uniqueness", "HIGH", "text", key=("text",), min_pass_pct=99)
PARENT_RULE = Rule("LIN22", "lines have an order", "lineitem", "referential", "CRITICAL", "l_orderkey",
                   parent=("orders", "o_orderkey"))
CHILD_RULE = Rule("ORD05", "orders have lines", "orders", "integrity", "HIGH", "o_orderkey",
                  parent=("lineitem", "l_orderkey"), min_pass_pct=99)


def unbalanced_orders(tables):
    """Orders whose total differs from their lines by more than the order's own amount."""
    amount = (inputs.money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    lines = tables["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(amount).alias("line_total"))
    total = inputs.money("o_totalprice")
    return tables["orders"].join(lines, "o_orderkey").where(F.abs(total - F.col("line_total")) > total)


UNBALANCED = r.SqlSelector(
    "SELECT o.* FROM {orders} o JOIN (SELECT l_orderkey, sum(CAST(CAST(l_extendedprice AS decimal(18,2)) "
    "* (1 - CAST(l_discount AS decimal(4,2))) AS decimal(18,2))) AS line_total FROM {lineitem} GROUP BY l_orderkey) "
    "ON l_orderkey = o_orderkey WHERE abs(CAST(o_totalprice AS decimal(18,2)) - line_total) > CAST(o_totalprice AS decimal(18,2))"
)
TOTAL_RULE = Rule("ORD06", "totals agree with lines", "orders", "consistency", "HIGH", "o_totalprice",
                  selector=UNBALANCED, min_pass_pct=90)

RULES = [x for x, _ in LINEITEM_RULES + OTHER_RULES] + [
    UNIQUE_RULE, TEXT_RULE, PARENT_RULE, CHILD_RULE, TOTAL_RULE,
]


# --- the same counts as SQL ---------------------------------------------------------------
def described_sql(rule: Rule, counts: str) -> str:
    return (
        f"SELECT '{rule.rule_id}' AS rule_id, '{rule.name}' AS rule_name, '{rule.table}' AS table_name, "
        f"'{rule.column}' AS column_name, '{rule.dimension}' AS dimension, '{rule.severity}' AS severity, "
        f"{rule.min_pass_pct}::DOUBLE AS min_pass_pct, total::BIGINT AS total_rows, bad::BIGINT AS violation_count "
        f"FROM ({counts})"
    )


def row_counts_sql(rule: Rule, predicate: str, source: str | None = None) -> str:
    return described_sql(
        rule, f"SELECT count(*) AS total, count(*) FILTER (WHERE {predicate}) AS bad FROM {source or rule.table}"
    )


SPECIAL_COUNTS = [
    described_sql(UNIQUE_RULE, "SELECT sum(c) AS total, coalesce(sum(c - 1), 0) AS bad FROM "
                               "(SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)"),
    described_sql(TEXT_RULE, "SELECT sum(c) AS total, coalesce(sum(c - 1), 0) AS bad FROM "
                             "(SELECT count(*) AS c FROM documents GROUP BY text)"),
    described_sql(PARENT_RULE, "SELECT count(*) AS total, count(*) FILTER (WHERE o_orderkey IS NULL) AS bad "
                               "FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"),
    described_sql(CHILD_RULE, "SELECT count(*) AS total, count(*) FILTER (WHERE o_orderkey NOT IN "
                              "(SELECT l_orderkey FROM lineitem)) AS bad FROM orders"),
    described_sql(TOTAL_RULE, "SELECT (SELECT count(*) FROM orders) AS total, (SELECT count(*) FROM orders JOIN "
                  "(SELECT l_orderkey, sum(round(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)), 2)) AS s "
                  "FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey "
                  "WHERE abs(o_totalprice::DECIMAL(18,2) - s) > o_totalprice::DECIMAL(18,2)) AS bad"),
]


def results_sql(parts: list[str]) -> str:
    """CTEs ``counts`` and ``results`` from one SELECT per rule."""
    rate = rate_sql("total_rows", "violation_count")
    return (
        f"counts AS ({' UNION ALL '.join(parts)}), rated AS (SELECT *, {rate} AS pass_rate_pct FROM counts), "
        f"results AS (SELECT *, {grade_sql('total_rows', 'violation_count', 'min_pass_pct')} AS status FROM rated)"
    )


LINEITEM_COUNTS = [row_counts_sql(x, p) for x, p in LINEITEM_RULES]
ALL_COUNTS = LINEITEM_COUNTS + [row_counts_sql(x, p) for x, p in OTHER_RULES] + SPECIAL_COUNTS
ALL_RESULTS = f"WITH {results_sql(ALL_COUNTS)}"
SHOWN = [
    "rule_id", "rule_name", "table_name", "column_name", "dimension", "severity", "min_pass_pct",
    "total_rows", "violation_count", "pass_rate_pct", "status",
]
SHOWN_SQL = ", ".join(SHOWN)


def tables_of(load: Loader) -> dict:
    return {t: load(t) for t in ("lineitem", "orders", "customer", "supplier", "events", "documents")}


def all_results(load: Loader):
    return ev.evaluate_tables(tables_of(load), RULES, run_id=RUN, as_of=AS_OF)


# --- whole rule runs --------------------------------------------------------------------------
@query("rule_results", f"{ALL_RESULTS} SELECT {SHOWN_SQL} FROM results")
def rule_results(load):
    return all_results(load).select(*SHOWN)


@query("rule_results_from_catalog", f"{ALL_RESULTS} SELECT {SHOWN_SQL} FROM results")
def rule_results_from_catalog(load):
    """Every kind of rule goes through its stored form."""
    stored = r.from_catalog(r.catalog(load.spark, RULES))
    return ev.evaluate_tables(tables_of(load), stored, run_id=RUN, as_of=AS_OF).select(*SHOWN)


@query("rule_results_fused", f"WITH {results_sql(LINEITEM_COUNTS)} SELECT {SHOWN_SQL} FROM results")
def rule_results_fused(load):
    rules = [x for x, _ in LINEITEM_RULES]
    return ev.evaluate(load("lineitem"), rules, run_id=RUN, as_of=AS_OF).select(*SHOWN)


KEPT_RULES = [x for x in RULES if x.selector is None and x.table in ("lineitem", "orders", "documents")]
KEPT_COUNTS = [row_counts_sql(x, p) for x, p in LINEITEM_RULES + OTHER_RULES if x.table in ("lineitem", "orders", "documents")]


@query("rule_results_incremental", f"WITH {results_sql(KEPT_COUNTS + SPECIAL_COUNTS[:4])} SELECT {SHOWN_SQL} FROM results")
def rule_results_incremental(load):
    """Three loads of every table; lines arrive apart from their orders, so references are missing for a while."""
    folder, part = new_path(load.spark, "loads"), {"lineitem": "l_partkey", "orders": "o_orderkey", "documents": "doc_id"}
    for k in range(3):
        rows = {t: load(t).where(F.pmod(F.coalesce(F.col(c), F.lit(0)), F.lit(3)) == k) for t, c in part.items()}
        incremental.add_load(load.spark, folder, rows, KEPT_RULES, f"load-{k}")
    return incremental.results(load.spark, folder, KEPT_RULES, run_id=RUN, as_of=AS_OF).select(*SHOWN)


# --- single predicates on dirty staging tables ----------------------------------------------------
def single(name: str, rule: Rule, predicate: str, source: str, ctes: str, loader):
    """Register one row rule over one derived table."""
    sql = f"WITH {ctes}, {results_sql([row_counts_sql(rule, predicate, source)])} SELECT {SHOWN_SQL} FROM results"

    @query(name, sql)
    def run(load):
        return ev.evaluate(loader(load), [rule], run_id=RUN, as_of=AS_OF).select(*SHOWN)


single("rule_completeness",
       row_rule("STG01", "dirty_customers", "email", "completeness", "CRITICAL", 100, r.is_blank("email")),
       "email IS NULL OR email = ''", "dirty_customers", inputs.DIRTY_CUSTOMERS, inputs.dirty_customers)
single("rule_positive",
       row_rule("STG02", "dirty_sales", "amount", "accuracy", "HIGH", 97, r.not_positive("amount", null_policy="fail")),
       "amount IS NULL OR amount <= 0", "dirty_sales", inputs.DIRTY_SALES, inputs.dirty_sales)
single("rule_range",
       row_rule("STG03", "dirty_sales", "amount", "accuracy", "HIGH", 95, r.outside_range("amount", 1000, 450000)),
       "amount IS NULL OR amount < 1000 OR amount > 450000", "dirty_sales", inputs.DIRTY_SALES, inputs.dirty_sales)
single("rule_not_future",
       row_rule("STG04", "dirty_sales", "order_date", "timeliness", "HIGH", 90,
                r.after("order_date", AS_OF, null_policy="fail")),
       "order_date IS NULL OR try_cast(order_date AS TIMESTAMP) IS NULL "
       "OR try_cast(order_date AS TIMESTAMP) > TIMESTAMP '2001-01-01'",
       "dirty_sales", inputs.DIRTY_SALES, inputs.dirty_sales)
single("rule_in_set",
       row_rule("STG05", "dirty_customers", "segment", "consistency", "MEDIUM", 80,
                r.not_in_set("segment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"], standardize=True)),
       "upper(trim(segment)) NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')",
       "dirty_customers", inputs.DIRTY_CUSTOMERS, inputs.dirty_customers)

EMAIL_RULES = [
    (row_rule("EML01", "dirty_customers", "email", "validity", "HIGH", 95, r.not_matching("email", EMAIL_STRICT)),
     f"email <> '' AND NOT regexp_matches(email, '{EMAIL_STRICT}', 'i')"),
    (row_rule("EML02", "dirty_customers", "email", "validity", "HIGH", 95, r.not_matching("email", EMAIL_LOOSE, ignore_case=False)),
     f"email <> '' AND NOT regexp_matches(email, '{EMAIL_LOOSE}')"),
    (row_rule("EML03", "dirty_customers", "email", "validity", "MEDIUM", min_pass(1.0), r.not_matching("email", EMAIL_NO_SPACE)),
     f"email <> '' AND NOT regexp_matches(email, '{EMAIL_NO_SPACE}', 'i')"),
]


@query(
    "rule_regex_email",
    f"WITH {inputs.DIRTY_CUSTOMERS}, "
    f"{results_sql([row_counts_sql(x, p) for x, p in EMAIL_RULES])} SELECT {SHOWN_SQL} FROM results",
)
def rule_regex_email(load):
    rules = [x for x, _ in EMAIL_RULES]
    return ev.evaluate(inputs.dirty_customers(load), rules, run_id=RUN, as_of=AS_OF).select(*SHOWN)


# --- keys, references, totals ---------------------------------------------------------------------
@query("rule_uniqueness", f"WITH {results_sql(SPECIAL_COUNTS[:2])} SELECT {SHOWN_SQL} FROM results")
def rule_uniqueness(load):
    return ev.evaluate_tables(tables_of(load), [UNIQUE_RULE, TEXT_RULE], run_id=RUN, as_of=AS_OF).select(*SHOWN)


STRAY_RULE = Rule("SAL01", "sales have a customer", "dirty_sales", "integrity", "CRITICAL", "customer_id",
                  parent=("clean_customers", "customer_id"), min_pass_pct=99)
STRAY_SQL = described_sql(
    STRAY_RULE,
    "SELECT count(*) AS total, count(*) FILTER (WHERE c.customer_id IS NULL) AS bad "
    "FROM dirty_sales s LEFT JOIN clean_customers c ON s.customer_id = c.customer_id",
)


@query(
    "rule_orphan",
    f"WITH {inputs.CLEAN_CUSTOMERS}, {inputs.DIRTY_SALES}, "
    f"{results_sql([STRAY_SQL, SPECIAL_COUNTS[2], SPECIAL_COUNTS[3]])} SELECT {SHOWN_SQL} FROM results",
)
def rule_orphan(load):
    tables = {
        **tables_of(load),
        "dirty_sales": inputs.dirty_sales(load),
        "clean_customers": inputs.staged_customers(load),
    }
    return ev.evaluate_tables(tables, [STRAY_RULE, PARENT_RULE, CHILD_RULE], run_id=RUN, as_of=AS_OF).select(*SHOWN)


# --- allowed values in a table -----------------------------------------------------------
LISTED_PARTS = f"listed_parts AS (SELECT p_partkey FROM part WHERE {chosen_sql('p_partkey', 'listed', 0.9)})"
LISTED_RULE = Rule("LIN23", "parts are listed", "lineitem", "validity", "HIGH", "l_partkey",
                   allowed=("listed_parts", "p_partkey"), min_pass_pct=90)
BUYER_RULE = Rule("STG08", "customers are known or not named", "dirty_sales", "validity", "HIGH", "customer_id",
                  allowed=("clean_customers", "customer_id"), min_pass_pct=95)
ALLOWED_COUNTS = [
    described_sql(LISTED_RULE, "SELECT count(*) AS total, count(*) FILTER (WHERE l_partkey IS NOT NULL AND p_partkey IS NULL) AS bad "
                               "FROM lineitem LEFT JOIN listed_parts ON l_partkey = p_partkey"),
    described_sql(BUYER_RULE, "SELECT count(*) AS total, count(*) FILTER (WHERE s.customer_id IS NOT NULL AND c.customer_id IS NULL) "
                              "AS bad FROM dirty_sales s LEFT JOIN clean_customers c ON s.customer_id = c.customer_id"),
]


def listed_parts(load: Loader):
    """The parts that may be sold, as a table."""
    return load("part").where(chosen(F.col("p_partkey"), "listed", 0.9)).select("p_partkey")


def tables_with_lists(load: Loader) -> dict:
    own = {"dirty_sales": inputs.dirty_sales(load), "clean_customers": inputs.staged_customers(load)}
    return {"lineitem": load("lineitem"), "listed_parts": listed_parts(load), **own}


@query(
    "rule_in_table",
    f"WITH {LISTED_PARTS}, {inputs.CLEAN_CUSTOMERS}, {inputs.DIRTY_SALES}, {results_sql(ALLOWED_COUNTS)} SELECT {SHOWN_SQL} FROM results",
)
def rule_in_table(load):
    """Allowed values that stand in a table, by rules that went through the stored catalogue."""
    stored = r.from_catalog(r.catalog(load.spark, [LISTED_RULE, BUYER_RULE]))
    return ev.evaluate_tables(tables_with_lists(load), stored, run_id=RUN, as_of=AS_OF).select(*SHOWN)


@query(
    "rows_not_in_table",
    f"WITH {LISTED_PARTS} SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey FROM lineitem "
    "WHERE l_partkey NOT IN (SELECT p_partkey FROM listed_parts)",
)
def rows_not_in_table(load):
    tables = {"lineitem": load("lineitem"), "listed_parts": listed_parts(load)}
    return quarantine.rule_rows(tables, LISTED_RULE).select("l_orderkey", "l_linenumber", "l_partkey")


# --- the catalogue over time ------------------------------------------------------------------
RECALIBRATED = "2001-02-01 00:00:00"


@query(
    "rule_versions",
    f"""{ALL_RESULTS}, aims AS (SELECT *, CASE WHEN status = 'FAIL' THEN floor(pass_rate_pct) ELSE min_pass_pct END AS aim
      FROM results)
    SELECT rule_id, severity, min_pass_pct, '{AS_OF}' AS effective_from,
      CASE WHEN aim <> min_pass_pct THEN '{RECALIBRATED}' END AS effective_to, aim = min_pass_pct AS is_current FROM aims
    UNION ALL SELECT rule_id, severity, aim, '{RECALIBRATED}', NULL, true FROM aims WHERE aim <> min_pass_pct""",
)
def rule_versions(load):
    """History of the rule catalogue: failing rules get the rate they reach as their aim, and a second version."""
    results = writers.stored(all_results(load).select("rule_id", "status", "pass_rate_pct"), "results")
    definitions = r.catalog(load.spark, RULES)
    attributes = definitions.columns[1:]
    first = definitions.select(
        F.lit(None).cast("bigint").alias("rule_sk"), "*", moment(AS_OF).alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"), F.lit(True).alias("is_current"),
    )
    first = writers.stored(publish.number_rows(first.drop("rule_sk"), F.col("rule_id"), "rule_sk"), "rule_versions")
    aim = F.when(F.col("status") == "FAIL", F.floor("pass_rate_pct").cast("double")).otherwise(F.col("min_pass_pct"))
    second = definitions.join(results, "rule_id").withColumn("min_pass_pct", aim).select("rule_id", *attributes)
    merged = publish.scd2_merge(first, second, key="rule_id", surrogate="rule_sk", attributes=attributes, as_of=RECALIBRATED)
    return merged.select("rule_id", "severity", "min_pass_pct", "effective_from", "effective_to", "is_current")


# --- whole runs that write evidence -------------------------------------------------------
RUN_KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
            "supplier": ["s_suppkey"], "events": ["event_id"], "documents": ["doc_id"]}


@query(
    "run_quarantine",
    f"{ALL_RESULTS} SELECT rule_id, table_name, severity, violation_count AS quarantined, violation_count AS ids "
    "FROM results WHERE violation_count > 0",
)
def run_quarantine(load):
    """Rules are run and the rows behind their violations captured, twice under one run id; the evidence is read back."""
    tables, folder = tables_of(load), new_path(load.spark, "run")
    runs.run_rules(load.spark, tables, RULES, folder, run_id=RUN, as_of=AS_OF)
    for _ in range(2):
        runs.run_quarantine(load.spark, tables, RULES, RUN_KEYS, folder, run_id=RUN, as_of=AS_OF)
    captured = writers.read_evidence(load.spark, f"{folder}/bad_rows")
    return captured.groupBy("rule_id", "table_name", "severity").agg(
        F.count("*").alias("quarantined"), F.count_distinct(F.unhex("quarantine_id")).alias("ids")
    )


@query(
    "rule_total_consistency",
    "SELECT o_orderkey, o_totalprice, s::DOUBLE AS line_total FROM orders JOIN "
    "(SELECT l_orderkey, sum(round(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(4,2)), 2)) AS s "
    "FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey "
    "WHERE abs(o_totalprice::DECIMAL(18,2) - s) > o_totalprice::DECIMAL(18,2)",
)
def rule_total_consistency(load):
    return unbalanced_orders(tables_of(load)).select("o_orderkey", "o_totalprice", "line_total")


@query(
    "guarded_cast_sum",
    f"""WITH {inputs.DIRTY_SALES}, texts AS (
      SELECT CASE WHEN employee_id LIKE 'ORPH%' THEN employee_id ELSE amount::VARCHAR END AS amount_text FROM dirty_sales)
    SELECT count(*) AS row_count,
      count(*) FILTER (WHERE regexp_matches(amount_text, '^-?[0-9]+(\\.[0-9]+)?$')) AS numeric_rows,
      sum(CASE WHEN regexp_matches(amount_text, '^-?[0-9]+(\\.[0-9]+)?$') THEN amount_text::DECIMAL(18,2) END)::DOUBLE AS total
    FROM texts""",
)
def guarded_cast_sum(load):
    text = F.when(F.col("employee_id").startswith("ORPH"), F.col("employee_id")).otherwise(
        F.col("amount").cast("string")
    )
    number = readers.guarded_number(F.col("amount_text"), r"^-?[0-9]+(\.[0-9]+)?$")
    return (
        inputs.dirty_sales(load)
        .select(text.alias("amount_text"))
        .agg(
            F.count("*").alias("row_count"),
            F.count(number).alias("numeric_rows"),
            F.sum(number).alias("total"),
        )
    )


@query(
    "publish_constraints",
    f"""WITH {inputs.DIRTY_EMPLOYEES} SELECT employee_id, hire_date, salary FROM dirty_employees
    WHERE employee_id IS NOT NULL AND hire_date IS NOT NULL AND salary > 0 AND salary < 1000000
      AND (manager_id IS NULL OR manager_id <> employee_id)
      AND coalesce(try_cast(hire_date AS DATE) <= DATE '2025-12-31', true)""",
)
def publish_constraints(load):
    kept = publish.publishable(
        inputs.dirty_employees(load),
        required=["employee_id", "hire_date"],
        constraints=[
            "salary > 0 AND salary < 1000000",
            "manager_id <> employee_id",
            "try_to_timestamp(hire_date, 'yyyy-MM-dd') <= timestamp'2025-12-31 00:00:00'",
        ],
    )
    return kept.select("employee_id", "hire_date", "salary")


@query(
    "catalog_vocabulary_check",
    """SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value, count(*) AS row_count FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY ALL
       UNION ALL
       SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY ALL""",
)
def catalog_vocabulary_check(load):
    allowed = {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": ["F", "O"]}
    return r.vocabulary_violations(load("orders"), allowed)


# --- isolation, custom rules, status ---------------------------------------------------------------
BROKEN_RULES = [
    row_rule("BAD01", "orders", "no_such_column", "validity", "HIGH", 100, "no_such_column > 1"),
    row_rule("BAD02", "orders", "o_totalprice", "validity", "HIGH", 100, "o_totalprice >"),
    row_rule("BAD03", "orders", "o_totalprice", "validity", "HIGH", 100, "o_totalprice + 1"),
]


def error_sql(rule: Rule) -> str:
    return (
        f"SELECT '{rule.rule_id}', '{rule.name}', '{rule.table}', '{rule.column}', '{rule.dimension}', "
        f"'{rule.severity}', {rule.min_pass_pct}::DOUBLE, count(*), 0::BIGINT, NULL::DOUBLE, 'ERROR', true FROM orders"
    )


ORDER_RULES = [(x, p) for x, p in OTHER_RULES if x.table == "orders"]
ORDER_COUNTS = [row_counts_sql(x, p) for x, p in ORDER_RULES]
WITH_ERRORS = f"""WITH {results_sql(ORDER_COUNTS)}, with_errors AS (
  SELECT {SHOWN_SQL}, false AS has_error FROM results
  UNION ALL {' UNION ALL '.join(error_sql(x) for x in BROKEN_RULES)})"""


def results_with_errors(load):
    rules = [x for x, _ in ORDER_RULES] + BROKEN_RULES
    return ev.evaluate(load("orders"), rules, run_id=RUN, as_of=AS_OF)


@query("rule_error_isolation", f"{WITH_ERRORS} SELECT {SHOWN_SQL}, has_error FROM with_errors")
def rule_error_isolation(load):
    return results_with_errors(load).select(*SHOWN, F.col("error_msg").isNotNull().alias("has_error"))


@query(
    "run_status",
    f"""{WITH_ERRORS}, runs AS (
      SELECT 'broken' AS run_id, status FROM with_errors
      UNION ALL SELECT 'plain', status FROM with_errors WHERE NOT has_error
      UNION ALL SELECT 'good', status FROM with_errors WHERE status = 'PASS')
    SELECT run_id, count(*) AS checks, count(*) FILTER (WHERE status = 'FAIL') AS fail_count,
      count(*) FILTER (WHERE status = 'ERROR') AS error_count,
      CASE WHEN count(*) FILTER (WHERE status = 'ERROR') > 0 THEN 'FAILED'
           WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'COMPLETED_WITH_FAILURES' ELSE 'SUCCESS' END AS status
    FROM runs GROUP BY run_id""",
)
def run_status(load):
    results = results_with_errors(load).drop("run_id")
    runs = (
        results.withColumn("run_id", F.lit("broken"))
        .unionByName(results.where("error_msg IS NULL").withColumn("run_id", F.lit("plain")))
        .unionByName(results.where("status = 'PASS'").withColumn("run_id", F.lit("good")))
    )
    return scoring.run_status(runs)


CUSTOM = r.custom("USR01", "events", "get_json_object(props, '$.k') > 90 AND event_type <> 'error'",
                  name="custom payload rule", column="props", min_pass_pct=90, severity="LOW")


@query(
    "custom_sql_rule",
    f"""WITH {results_sql([row_counts_sql(CUSTOM, "(props->>'$.k')::INT > 90 AND event_type <> 'error'")])}
    SELECT {SHOWN_SQL} FROM results""",
)
def custom_sql_rule(load):
    return ev.evaluate(load("events"), [CUSTOM], run_id=RUN, as_of=AS_OF).select(*SHOWN)


MONTHLY = f"""monthly AS (
  SELECT date_trunc('month', o_orderdate) AS month, count(*) AS total,
    {', '.join(f"count(*) FILTER (WHERE {p}) AS {x.rule_id}" for x, p in ORDER_RULES)}
  FROM orders GROUP BY 1)"""


@query(
    "rule_results_by_month",
    f"""WITH {MONTHLY}, counts AS ({' UNION ALL '.join(
        f"SELECT strftime(month, '%Y-%m') AS month, '{x.rule_id}' AS rule_id, {x.min_pass_pct}::DOUBLE AS min_pass_pct, "
        f"total, {x.rule_id} AS bad FROM monthly" for x, _ in ORDER_RULES)}),
    rated AS (SELECT *, {rate_sql('total', 'bad')} AS pass_rate_pct FROM counts)
    SELECT month, rule_id, total AS total_rows, bad AS violation_count, pass_rate_pct,
      {grade_sql('total', 'bad', 'min_pass_pct')} AS status FROM rated""",
)
def rule_results_by_month(load):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    rules = [x for x, _ in ORDER_RULES]
    results = ev.evaluate(load("orders"), rules, run_id=RUN, as_of=AS_OF, slice_by=[month])
    return results.select("month", "rule_id", "total_rows", "violation_count", "pass_rate_pct", "status")


ANY_ORDER = " OR ".join(f"coalesce({p}, false)" for _, p in ORDER_RULES)


ROW_COUNTS = f"""SELECT count(*) AS records_in, count(*) FILTER (WHERE NOT ({ANY_ORDER})) AS records_out,
      count(*) FILTER (WHERE {ANY_ORDER}) AS records_diverted FROM orders"""


@query("run_row_counts", ROW_COUNTS)
def run_row_counts(load):
    return ev.run_row_counts(load("orders"), [x for x, _ in ORDER_RULES])


@query("row_counts_in_flight", ROW_COUNTS)
def row_counts_in_flight(load):
    """The same counts, taken while the rows are written."""
    written = in_flight.write_split(load("orders"), [x for x, _ in ORDER_RULES], new_path(load.spark, "split-orders"))
    return written.run_row_counts(load.spark)


# --- scores ------------------------------------------------------------------------------------------
# mean of rates with 4 decimals, rounded half up in whole numbers
MEAN_RATE = (
    "((2 * sum(round(pass_rate_pct * 10000)::BIGINT) + count(pass_rate_pct)) // (2 * count(pass_rate_pct)))::DOUBLE / 10000"
)
DIMS = f"""{ALL_RESULTS}, dims AS (
  SELECT table_name, dimension, {MEAN_RATE} AS dim_score, count(*) AS rules_run,
    sum(violation_count)::BIGINT AS total_violations FROM results GROUP BY table_name, dimension)"""
WEIGHT_ROWS = ", ".join(f"('{d}', {w}::DOUBLE)" for d, w in schemas.DEFAULT_WEIGHTS.items())
OVERALL = f"""{DIMS}, weights(dimension, weight) AS (VALUES {WEIGHT_ROWS}), overall AS (
  SELECT table_name, coalesce(round(sum(dim_score * weight) / sum(CASE WHEN dim_score IS NOT NULL THEN weight END), 4), 0)
    AS overall_score FROM dims LEFT JOIN weights USING (dimension) GROUP BY table_name)"""


@query("dimension_scores", f"{DIMS} SELECT * FROM dims")
def dimension_scores(load):
    scores = scoring.dimension_scores(all_results(load))
    return scores.select("table_name", "dimension", "dim_score", "rules_run", "total_violations")


@query(
    "quality_scores",
    f"""{OVERALL} SELECT table_name,
      {', '.join(f"max(dim_score) FILTER (WHERE dimension = '{d}') AS {d}_score" for d in schemas.DIMENSIONS)},
      sum(rules_run)::BIGINT AS total_rules_run, sum(total_violations)::BIGINT AS total_violations,
      max(overall_score) AS overall_score
    FROM dims JOIN overall USING (table_name) GROUP BY table_name""",
)
def quality_scores(load):
    return scoring.quality_scores(all_results(load)).drop("run_id", "schema_name")


@query(
    "quality_scores_long",
    f"""{OVERALL} SELECT table_name, dimension, dim_score AS dimension_score,
      coalesce(weight, 0) * 100 AS weight_pct, round(dim_score * coalesce(weight, 0), 4) AS weighted_score
    FROM dims LEFT JOIN weights USING (dimension)
    UNION ALL SELECT table_name, 'Overall', overall_score, 100, overall_score FROM overall""",
)
def quality_scores_long(load):
    return scoring.quality_scores_long(all_results(load)).drop("run_id", "schema_name")


@query(
    "failed_rules",
    f"""{ALL_RESULTS} SELECT rule_id, rule_name, table_name, severity, violation_count, status
    FROM results WHERE violation_count > 0""",
)
def failed_rules(load):
    found = scoring.failed_rules(all_results(load), r.catalog(load.spark, RULES))
    return found.select("rule_id", "rule_name", "table_name", "severity", "violation_count", "status")


@query(
    "run_summary",
    f"""{ALL_RESULTS} SELECT dimension, count(*) AS rules, count(*) FILTER (WHERE status = 'PASS') AS passed,
      count(*) FILTER (WHERE status = 'FAIL') AS failed, sum(violation_count)::BIGINT AS failed_rows
    FROM results GROUP BY dimension""",
)
def run_summary(load):
    return scoring.run_summary(all_results(load), as_of="2001-01-01 00:05:00")


@query(
    "ordered_string_agg",
    """SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS event_types
    FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id""",
)
def ordered_string_agg(load):
    return scoring.ordered_labels(load("events"), ["user_id"], "event_type", "event_types")


@query(
    "slow_rules",
    """SELECT event_type AS rule_name, round(avg(value), 6) AS avg_ms, max(value) AS max_ms FROM events
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def slow_rules(load):
    slow = scoring.slow_rules(load("events").withColumnRenamed("event_type", "rule_name"), duration="value")
    return slow.withColumn("avg_ms", F.round("avg_ms", 6))
