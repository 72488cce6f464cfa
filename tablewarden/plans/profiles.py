"""Bindings for profiling."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tablewarden.functions.text import SEMANTIC_PATTERNS
from tablewarden.operators import governance, keys, profiling, runs, sketches, trends
from tablewarden.operators.quantiles import exact_percentiles
from tablewarden.plans import inputs
from tablewarden.plans.registry import query
from tablewarden.session import new_path
from tablewarden.sources import writers

# columns of the profiled tables with their Spark types, for the SQL side
COLUMNS = {
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                 "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                 "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
             "p_retailprice": "double"},
    "dirty_customers": {c: "string" for c in
                        ("customer_id", "name", "segment", "email", "phone", "country", "signup_date")},
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double",
               "props": "string"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "clean_customers": {c: "string" for c in
                        ("customer_id", "name", "segment", "email", "phone", "country", "signup_date")},
}
NUMBERS = ("bigint", "int", "double")


def pct_sql(part: str, whole: str) -> str:
    return f"coalesce(round({part} * 100.0::DOUBLE / nullif({whole}, 0), 2), 0)"


def label_sql(value: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({value}, '{p}') THEN '{t}'" for t, p in SEMANTIC_PATTERNS.items())
    return f"CASE {cases} END"


TIE_SQL = "sha256(v)"  # order of tied values


def column_sql(table: str, column: str, kind: str) -> str:
    """Profile row of one column, statement by statement as a reader would check it."""
    number = kind in NUMBERS
    stats = (
        f"round(avg({column}::DOUBLE), 8) AS mean_value, round(stddev_samp({column}::DOUBLE), 8) AS stddev_value, "
        "NULL::BIGINT AS min_length, NULL::BIGINT AS max_length"
        if number
        else "NULL::DOUBLE AS mean_value, NULL::DOUBLE AS stddev_value, "
        f"min(length({column}::VARCHAR)) AS min_length, max(length({column}::VARCHAR)) AS max_length"
    )
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type,
      (SELECT CASE WHEN count(*) = 0 THEN 'unknown' ELSE coalesce(
          (SELECT label FROM (SELECT {label_sql("trim(v)")} AS label, count(*) AS n FROM
            (SELECT {column}::VARCHAR AS v FROM {table} WHERE {column} IS NOT NULL) GROUP BY 1)
           WHERE label IS NOT NULL AND n >= 0.6 * (SELECT count({column}) FROM {table})), 'text') END
       FROM {table} WHERE {column} IS NOT NULL) AS inferred_type,
      count(*) AS row_count, count(*) - count({column}) AS null_count,
      {pct_sql(f'(count(*) - count({column}))', 'count(*)')} AS null_pct,
      count(DISTINCT {column}) AS distinct_count,
      {pct_sql(f'count(DISTINCT {column})', 'count(*)')} AS distinct_pct,
      min({column})::VARCHAR AS min_value, max({column})::VARCHAR AS max_value, {stats},
      (SELECT string_agg(v || ':' || n, '|' ORDER BY n DESC, {TIE_SQL}) FROM
        (SELECT {column}::VARCHAR AS v, count(*) AS n FROM {table} WHERE {column} IS NOT NULL
         GROUP BY 1 ORDER BY n DESC, {TIE_SQL} LIMIT 5)) AS top_values
      FROM {table}"""


def profile_sql(*tables: str) -> str:
    return " UNION ALL ".join(column_sql(t, c, k) for t in tables for c, k in COLUMNS[t].items())


def rounded(profiles):
    return profiles.withColumns(
        {"mean_value": F.round("mean_value", 8), "stddev_value": F.round("stddev_value", 8)}
    ).drop("schema_name")


def base_profiles(load, *names: str):
    return rounded(profiling.profile_tables({n: load(n) for n in names}))


def customer_profiles(load):
    """Counts and types of the customers before and after the defects."""
    return profiling.type_profiles(
        {"clean_customers": inputs.staged_customers(load), "dirty_customers": inputs.dirty_customers(load)}
    )


CUSTOMERS = f"{inputs.DIRTY_CUSTOMERS}, profiles AS ({profile_sql('clean_customers', 'dirty_customers')})"
# all given tables but embeddings: vectors have neither an order nor a text form both engines share
BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages",
        "benchmark", "labels", "conversations")


@query("profile_table", profile_sql("lineitem"))
def profile_table(load):
    return base_profiles(load, "lineitem")


@query("profile_all_tables", profile_sql(*BASE))
def profile_all_tables(load):
    return base_profiles(load, *BASE)


@query("run_profile", f"SELECT 'n1' AS run_id, * FROM ({profile_sql('orders', 'customer')})")
def run_profile(load):
    """Two tables are profiled twice under one run id; the evidence is read back."""
    folder = new_path(load.spark, "run")
    for _ in range(2):
        tables = {n: load(n) for n in ("orders", "customer")}
        runs.run_profile(load.spark, tables, folder, run_id="n1", as_of="2001-01-01 00:00:00")
    return rounded(writers.read_evidence(load.spark, f"{folder}/profile_results").drop("run_date", "profiled_at"))


@query("profile_long_texts", profile_sql("documents"))
def profile_long_texts(load):
    return base_profiles(load, "documents")


COUNTS = "table_name, column_name, row_count, null_count, null_pct, distinct_count, distinct_pct"


@query("profile_counts", f"WITH {CUSTOMERS} SELECT {COUNTS} FROM profiles")
def profile_counts(load):
    return customer_profiles(load).select(*COUNTS.split(", "))


NUMERIC = "column_name, min_value, max_value, mean_value, stddev_value"


@query(
    "profile_numeric",
    f"SELECT {NUMERIC} FROM ({profile_sql('lineitem')}) WHERE data_type IN {NUMBERS}",
)
def profile_numeric(load):
    numbers = [c for c, k in COLUMNS["lineitem"].items() if k in NUMBERS]
    stats = profiling.value_stats(load("lineitem"), numbers)
    return stats.select(
        "column_name",
        "min_value",
        "max_value",
        F.round("mean_value", 8).alias("mean_value"),
        F.round("stddev_value", 8).alias("stddev_value"),
    )


@query(
    "profile_text",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c}) AS min_value, max({c}) AS max_value, "
        f"min(length({c})) AS min_length, max(length({c})) AS max_length FROM documents"
        for c in ("text", "lang", "source")
    ),
)
def profile_text(load):
    stats = profiling.value_stats(load("documents"), ["text", "lang", "source"])
    return stats.select("column_name", "min_value", "max_value", "min_length", "max_length")


@query("profile_top_values", f"SELECT column_name, top_values FROM ({profile_sql('orders')})")
def profile_top_values(load):
    orders, columns = load("orders"), list(COLUMNS["orders"])
    return profiling.top_values(profiling.value_counts(orders, columns), profiling.long_texts(orders, columns))


@query("profile_semantic_type", f"WITH {CUSTOMERS} SELECT table_name, column_name, inferred_type FROM profiles")
def profile_semantic_type(load):
    return customer_profiles(load).select("table_name", "column_name", "inferred_type")


@query(
    "profile_drift",
    f"""WITH {CUSTOMERS}, a AS (SELECT * FROM profiles WHERE table_name = 'clean_customers'),
      b AS (SELECT * FROM profiles WHERE table_name = 'dirty_customers')
    SELECT 'customers' AS table_name, column_name, round(b.null_pct - a.null_pct, 2) AS null_pct_change,
      round(b.distinct_pct - a.distinct_pct, 2) AS distinct_pct_change,
      a.inferred_type AS old_inferred_type, b.inferred_type AS new_inferred_type,
      a.inferred_type IS DISTINCT FROM b.inferred_type AS type_changed
    FROM a FULL JOIN b USING (column_name)""",
)
def profile_drift(load):
    before = profiling.type_profiles({"customers": inputs.staged_customers(load)})
    after = profiling.type_profiles({"customers": inputs.dirty_customers(load)})
    return profiling.drift(before, after)


@query(
    "suggest_rules",
    f"""WITH {CUSTOMERS}
    SELECT table_name, column_name, 'validity' AS dimension, 'email format' AS rule FROM profiles WHERE inferred_type = 'email'
    UNION ALL SELECT table_name, column_name, 'completeness', 'not null' FROM profiles WHERE null_count = 0
    UNION ALL SELECT table_name, column_name, 'uniqueness', 'unique' FROM profiles WHERE distinct_count = row_count""",
)
def suggest_rules(load):
    return profiling.suggest_rules(customer_profiles(load))


@query(
    "candidate_keys",
    f"""SELECT table_name, column_name, row_count FROM ({profile_sql(*BASE)})
    WHERE null_count = 0 AND distinct_count = row_count""",
)
def candidate_keys(load):
    return profiling.candidate_keys(profiling.type_profiles({n: load(n) for n in BASE}))


DECLARED = {"email": "email", "phone": "phone_us", "signup_date": "date_iso", "customer_id": "integer"}


@query(
    "rule_semantic",
    f"""WITH {CUSTOMERS}, declared(column_name, declared_type) AS (VALUES {', '.join(str(x) for x in DECLARED.items())})
    SELECT table_name, column_name, declared_type, inferred_type,
      CASE WHEN declared_type = inferred_type THEN 'PASS' ELSE 'FAIL' END AS status
    FROM profiles JOIN declared USING (column_name)""",
)
def rule_semantic(load):
    return profiling.semantic_rule(customer_profiles(load), DECLARED)


@query(
    "suggest_classification",
    f"""WITH {CUSTOMERS} SELECT table_name, column_name, inferred_type,
      CASE WHEN inferred_type IN ('email', 'phone_e164', 'phone_us') THEN 'PII' ELSE 'INTERNAL' END AS sensitivity,
      CASE WHEN inferred_type IN ('email', 'phone_e164', 'phone_us') THEN 'PARTIAL'
           WHEN inferred_type = 'uuid' THEN 'HASH' ELSE 'NONE' END AS masking_strategy
    FROM profiles""",
)
def suggest_classification(load):
    return governance.suggest_classification(customer_profiles(load))


# --- percentiles and outliers ---------------------------------------------------------------
@query(
    "duration_percentiles",
    """SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
      round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type""",
)
def duration_percentiles(load):
    found = exact_percentiles(load("events"), "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["event_type"])
    return found.select("event_type", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


@query(
    "profile_outliers",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
        quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
      f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence FROM q)
    SELECT l_returnflag, round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3,
      round(any_value(low_fence), 4) AS low_fence, round(any_value(high_fence), 4) AS high_fence,
      count(*) AS row_count, count(*) FILTER (WHERE l_extendedprice < low_fence) AS below,
      count(*) FILTER (WHERE l_extendedprice > high_fence) AS above
    FROM lineitem JOIN f USING (l_returnflag) GROUP BY l_returnflag""",
)
def profile_outliers(load):
    found = trends.outlier_counts(load("lineitem"), "l_extendedprice", by=["l_returnflag"])
    return found.withColumns({c: F.round(c, 4) for c in ("q1", "q3", "low_fence", "high_fence")})


# --- sketches and keys ----------------------------------------------------------------------
SKETCHED = "lineitem"
MONTH = "l_shipdate"


@query(
    "profile_sketches",
    " UNION ALL ".join(
        f"""SELECT '{SKETCHED}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
      count(DISTINCT {c}) AS distinct_count, TRUE AS distinct_within, {'TRUE' if k in NUMBERS else 'NULL::BOOLEAN'} AS median_within
    FROM {SKETCHED}""" for c, k in COLUMNS[SKETCHED].items()
    ),
)
def profile_sketches(load):
    """Sketches per month are kept as evidence, read again and merged; beside them the exact counts and whether the bounds hold."""
    rows, path = load(SKETCHED), new_path(load.spark, "sketches")
    months = rows.withColumn("month", F.date_format(MONTH, "yyyy-MM"))
    kept = sketches.sketch(months, SKETCHED, columns=list(COLUMNS[SKETCHED]), by=["month"])
    writers.write_evidence(kept, path, run_date="2001-01-01", run_id="all")
    whole = sketches.merged(writers.read_evidence(load.spark, path))
    found = writers.stored(sketches.estimates(whole, {"median": 0.5}), "estimates")
    medians = {r.column_name: r["median"] for r in found.select("column_name", "median").collect()}  # one per column
    exact = []
    for i, (column, kind) in enumerate(COLUMNS[SKETCHED].items()):
        exact.append(F.countDistinct(column).alias(f"d{i}"))
        if kind in NUMBERS and medians[column] is not None:
            exact += [F.count_if(F.col(column) < medians[column]).alias(f"b{i}"), F.count_if(F.col(column) <= medians[column]).alias(f"u{i}")]
        else:
            exact += [F.lit(None).cast("bigint").alias(f"b{i}"), F.lit(None).cast("bigint").alias(f"u{i}")]
    counted = rows.agg(*exact).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("distinct_count"), F.col(f"b{i}").alias("below"), F.col(f"u{i}").alias("upto"))
        for i, c in enumerate(COLUMNS[SKETCHED])
    ])))
    known = F.col("row_count") - F.col("null_count")
    middle = (F.col("below") <= known * (0.5 + sketches.RANK_ERROR)) & (F.col("upto") >= known * (0.5 - sketches.RANK_ERROR))
    return found.join(counted, "column_name").select(
        "table_name", "column_name", "row_count", "null_count", "distinct_count",
        F.col("distinct_count").between(F.col("distinct_low"), F.col("distinct_high")).alias("distinct_within"),
        middle.alias("median_within"),
    )


KEYED, KEY_SIZE = ("lineitem", "events", "conversations", "orders"), 2


def keys_sql(table: str, most: int) -> str:
    """All sets of columns, those that are unique and without NULLs, those without a smaller one inside."""
    sets = [s for n in range(1, most + 1) for s in combinations(COLUMNS[table], n)]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{','.join(s)}' AS key_columns, [{', '.join(repr(c) for c in s)}] AS parts, {len(s)} AS key_size "
        f"WHERE (SELECT count(*) > 0 AND count(*) = (SELECT count(*) FROM (SELECT DISTINCT {', '.join(s)} FROM {table}"
        f" WHERE {' AND '.join(f'{c} IS NOT NULL' for c in s)})) FROM {table})"
        for s in sets
    )


@query(
    "composite_keys",
    f"""WITH k AS ({' UNION ALL '.join(keys_sql(t, KEY_SIZE) for t in KEYED)})
    SELECT table_name, key_columns, key_size::BIGINT AS key_size FROM k WHERE NOT EXISTS (SELECT 1 FROM k AS o
      WHERE o.table_name = k.table_name AND o.key_size < k.key_size AND list_has_all(k.parts, o.parts))""",
)
def composite_keys(load):
    found = None
    for name in KEYED:
        one = keys.composite_keys(load(name).select(*COLUMNS[name]), name, max_size=KEY_SIZE)
        found = one if found is None else found.unionByName(one)
    return found
