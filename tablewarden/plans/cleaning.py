"""Bindings for loading, defects, deduplication and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions import standardize
from tablewarden.functions.hashing import chosen
from tablewarden.operators import dedup, defects, publish
from tablewarden.operators.keyed_store import KeyedStore
from tablewarden.operators.quarantine import rule_rows
from tablewarden.operators.rules import Rule, not_in_set, not_positive
from tablewarden.plans import inputs, profiles
from tablewarden.plans.registry import Loader, chosen_sql, day_sql, draw_sql, query, stamp_sql
from tablewarden.plans.rules import row_rule
from tablewarden.session import new_path
from tablewarden.sources import readers, writers

TABLES = [*profiles.BASE, "embeddings"]


# --- loading --------------------------------------------------------------------------------
@query(
    "stage_load",
    """SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus, o_totalprice,
      o_orderdate::VARCHAR AS o_orderdate, o_orderpriority, 7::BIGINT AS load_id, '2001-08-02 00:00:00' AS load_ts
    FROM orders""",
)
def stage_load(load):
    staged = readers.stage(
        load("orders"), load_id=7, load_ts="2001-08-02 00:00:00", types={"o_totalprice": "decimal(14,2)"}
    )
    return staged


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_counts(load):
    return readers.table_counts({t: load(t) for t in TABLES})


CATALOG = {t: list(profiles.COLUMNS[t].items()) for t in profiles.BASE}
CATALOG["embeddings"] = [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")]
CATALOG_SQL = "columns_found AS (" + " UNION ALL ".join(
    f"SELECT 'main' AS schema_name, '{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, "
    f"{i}::BIGINT AS ordinal, count({c}) AS populated_rows FROM {t}"
    for t, columns in CATALOG.items()
    for i, (c, k) in enumerate(columns, start=1)
) + ")"


def catalog(load: Loader):
    """Columns of all given tables with the number of rows that fill them."""
    tables = {t: load(t) for t in CATALOG}
    found = readers.column_catalog(load.spark, tables)
    return found.join(readers.populated_counts(tables), ["table_name", "column_name"])


@query("column_catalog", f"WITH {CATALOG_SQL} SELECT * FROM columns_found")
def column_catalog(load):
    return catalog(load)


# --- single defects ---------------------------------------------------------------------------
def customer_defect(name: str, column: str, spark_side, sql_side: str):
    """One defect on one column of the clean customers."""

    @query(name, f"WITH {inputs.CLEAN_CUSTOMERS} SELECT customer_id, {sql_side} AS {column} FROM clean_customers")
    def run(load):
        key = F.col("customer_id")
        return inputs.staged_customers(load).select("customer_id", spark_side(F.col(column), key).alias(column))


customer_defect("inject_null", "email", lambda v, k: defects.inject_null(v, k, prob=0.3),
                inputs.null_sql("email", "customer_id", 0.3, "null"))
customer_defect("inject_empty", "country", lambda v, k: defects.inject_empty(v, k, prob=0.3),
                f"CASE WHEN {chosen_sql('customer_id', 'empty', 0.3)} THEN '' ELSE country END")
customer_defect("inject_date_drift", "signup_date", lambda v, k: defects.inject_date_drift(v, k, prob=0.5),
                inputs.date_drift_sql("signup_date", "customer_id", 0.5))
customer_defect("inject_email", "email", lambda v, k: defects.inject_email(v, k, prob=0.5),
                inputs.email_defect_sql("email", "customer_id", 0.5))
customer_defect("inject_phone", "phone", lambda v, k: defects.inject_phone(v, k, prob=0.5),
                inputs.phone_defect_sql("phone", "customer_id", 0.5))
customer_defect("inject_casing", "name", lambda v, k: defects.inject_casing(v, k, prob=0.5),
                inputs.casing_sql("name", "customer_id", 0.5))
customer_defect("inject_whitespace", "segment", lambda v, k: defects.inject_whitespace(v, k, prob=0.5),
                inputs.space_sql("segment", "customer_id", 0.5))


@query(
    "inject_numeric",
    f"""WITH {inputs.CLEAN_SALES} SELECT order_id, ({inputs.numeric_sql('amount', 'order_id', 0.5, 'numeric')})::DOUBLE
      AS amount FROM clean_sales""",
)
def inject_numeric(load):
    key = F.col("order_id")
    return inputs.staged_sales(load).select(
        "order_id", defects.inject_numeric(F.col("amount"), key, prob=0.5).alias("amount")
    )


@query(
    "inject_orphan",
    f"""WITH {inputs.CLEAN_SALES} SELECT order_id, {inputs.orphan_sql('customer_id', 'order_id', 0.2, 'orphan')}
      AS customer_id, CASE WHEN {chosen_sql('order_id', 'pool', 0.1)} THEN
        CASE {draw_sql('order_id', 'pool/mode')} % 2 WHEN 0 THEN 'EMP-X' ELSE 'EMP-Y' END ELSE employee_id END
      AS employee_id FROM clean_sales""",
)
def inject_orphan(load):
    key = F.col("order_id")
    return inputs.staged_sales(load).select(
        "order_id",
        defects.inject_orphan(F.col("customer_id"), key, prob=0.2).alias("customer_id"),
        defects.inject_orphan(F.col("employee_id"), key, prob=0.1, pool=["EMP-X", "EMP-Y"], op="pool").alias(
            "employee_id"
        ),
    )


@query(
    "inject_duplicates",
    f"""WITH {inputs.CLEAN_SALES} SELECT order_id, customer_id, amount::DOUBLE AS amount FROM
      ({inputs.duplicates_sql('clean_sales', 'order_id', 0.02)})""",
)
def inject_duplicates(load):
    sales = inputs.staged_sales(load)
    return defects.inject_duplicates(sales, F.col("order_id"), rate=0.02).select("order_id", "customer_id", "amount")


# --- table plans ---------------------------------------------------------------------------------
@query(
    "defect_plan",
    f"WITH {inputs.DIRTY_SALES} SELECT * REPLACE (amount::DOUBLE AS amount) FROM dirty_sales",
)
def defect_plan(load):
    return inputs.dirty_sales(load)


@query("defect_plan_customers", f"WITH {inputs.DIRTY_CUSTOMERS} SELECT * FROM dirty_customers")
def defect_plan_customers(load):
    return inputs.dirty_customers(load)


@query("defect_plan_employees", f"WITH {inputs.DIRTY_EMPLOYEES} SELECT * FROM dirty_employees")
def defect_plan_employees(load):
    return inputs.dirty_employees(load)


# --- the demo: defects in source and target, and what the rules find ---------------------------------
DEMO_AS_OF = "2001-08-02 00:00:00"
_D = defects.RATES["demo"]
CURRENCIES = ["USD", "EUR", "GBP", "JPY"]


def demo_inputs(load: Loader):
    """Clean orders whose totals agree with their items, and the items."""
    items = load("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
    )
    totals = items.groupBy("order_id").agg(
        F.sum((F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")).cast("decimal(18,2)").alias("total_amount")
    )
    currency = F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), (F.col("o_custkey") % 4 + 1).cast("int"))
    orders = (
        load("orders")
        .select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"), currency.alias("currency"))
        .join(totals, "order_id")
    )
    return orders, items


def demo(load: Loader):
    orders, items = demo_inputs(load)
    dirty_orders, dirty_items, target = defects.corrupt_demo(orders, items, as_of=DEMO_AS_OF)
    return {"orders": dirty_orders, "items": dirty_items, "target": target}


def demo_unbalanced(tables):
    lines = tables["items"].groupBy("order_id").agg(F.sum("line_amount").alias("line_total"))
    joined = tables["orders"].join(lines, "order_id")
    return joined.where(F.abs(F.col("total_amount") - F.col("line_total")) > 0.01)


DEMO_RULES = {
    "bad_currency": row_rule("known_currency", "orders", "currency", "validity", "HIGH", 99.5,
                             not_in_set("currency", CURRENCIES)),
    "future_date": row_rule("no_order_after_the_run", "orders", "order_date", "timeliness", "HIGH", 99.5,
                            f"order_date > timestamp_ntz'{DEMO_AS_OF}'"),
    "negative_quantity": row_rule("quantities_above_zero", "items", "quantity", "validity", "HIGH", 99.5,
                                  not_positive("quantity")),
    "orphan_line": Rule("items_belong_to_an_order", "items_belong_to_an_order", "items", "referential", "CRITICAL", "order_id",
                        parent=("orders", "order_id")),
    "wrong_total": Rule("total_equals_items", "total_equals_items", "orders", "consistency", "HIGH",
                        "total_amount", selector=demo_unbalanced, min_pass_pct=98),
}
DEMO_KEYS = {"bad_currency": "order_id", "future_date": "order_id", "negative_quantity": "item_id",
             "orphan_line": "item_id", "wrong_total": "order_id"}

DEMO = f"""items AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS item_id,
    l_orderkey AS order_id, l_quantity::INT AS quantity, l_extendedprice::DECIMAL(12,2) AS unit_price FROM lineitem),
  totals AS (SELECT order_id, sum(quantity * unit_price)::DECIMAL(18,2) AS total_amount FROM items GROUP BY 1),
  clean_orders AS (SELECT o_orderkey AS order_id, o_orderdate AS order_date,
    ['USD', 'EUR', 'GBP', 'JPY'][o_custkey % 4 + 1] AS currency, total_amount
    FROM orders JOIN totals ON o_orderkey = order_id),
  demo_orders AS (SELECT order_id,
    CASE WHEN {chosen_sql('order_id', 'future', _D['future_date'])} THEN TIMESTAMP '{DEMO_AS_OF}'
      + to_days(({draw_sql('order_id', 'future/mode')} % 56 + 5)::INT) ELSE order_date END AS order_date,
    CASE WHEN {chosen_sql('order_id', 'currency', _D['bad_currency'])} THEN 'ZZZ' ELSE currency END AS currency,
    (CASE WHEN {chosen_sql('order_id', 'total', _D['wrong_total'])} THEN
      round(total_amount * (1.05 + ({draw_sql('order_id', 'total/mode')} % 16) / 100)::DECIMAL(5,2), 2)
      ELSE total_amount END)::DECIMAL(18,2) AS total_amount FROM clean_orders),
  quantities AS (SELECT item_id, order_id, unit_price,
    CASE WHEN {chosen_sql('item_id', 'quantity', _D['negative_quantity'])} THEN -quantity ELSE quantity END AS quantity
    FROM items),
  demo_items AS (SELECT item_id, quantity, unit_price, (quantity * unit_price)::DECIMAL(18,2) AS line_amount,
    CASE WHEN {chosen_sql('item_id', 'orphan_line', _D['orphan_line'])} THEN -1 ELSE order_id END AS order_id FROM quantities),
  demo_target AS (SELECT * FROM demo_orders WHERE NOT {chosen_sql('order_id', 'gap', _D['missing_in_target'])}),
  caught AS (
    SELECT 'bad_currency' AS defect, order_id::VARCHAR AS row_key FROM demo_orders
      WHERE currency NOT IN ('USD', 'EUR', 'GBP', 'JPY') UNION ALL
    SELECT 'future_date', order_id::VARCHAR FROM demo_orders WHERE order_date > TIMESTAMP '{DEMO_AS_OF}' UNION ALL
    SELECT 'negative_quantity', item_id FROM demo_items WHERE quantity <= 0 UNION ALL
    SELECT 'orphan_line', item_id FROM demo_items i
      WHERE NOT EXISTS (SELECT 1 FROM demo_orders o WHERE o.order_id = i.order_id) UNION ALL
    SELECT 'wrong_total', order_id::VARCHAR FROM demo_orders JOIN
      (SELECT order_id, sum(line_amount) AS s FROM demo_items GROUP BY 1) USING (order_id)
      WHERE abs(total_amount - s) > 0.01 UNION ALL
    SELECT 'missing_in_target', order_id::VARCHAR FROM demo_orders
      WHERE order_id NOT IN (SELECT order_id FROM demo_target)),
  injected AS (
    SELECT 'bad_currency' AS defect, order_id::VARCHAR AS row_key FROM clean_orders
      WHERE {chosen_sql('order_id', 'currency', _D['bad_currency'])} UNION ALL
    SELECT 'future_date', order_id::VARCHAR FROM clean_orders
      WHERE {chosen_sql('order_id', 'future', _D['future_date'])} UNION ALL
    SELECT 'negative_quantity', item_id FROM items
      WHERE {chosen_sql('item_id', 'quantity', _D['negative_quantity'])} UNION ALL
    SELECT 'orphan_line', item_id FROM items WHERE {chosen_sql('item_id', 'orphan_line', _D['orphan_line'])} UNION ALL
    SELECT 'wrong_total', order_id::VARCHAR FROM clean_orders
      WHERE {chosen_sql('order_id', 'total', _D['wrong_total'])} UNION ALL
    SELECT 'missing_in_target', order_id::VARCHAR FROM clean_orders
      WHERE {chosen_sql('order_id', 'gap', _D['missing_in_target'])})"""


def demo_caught(load: Loader):
    tables = demo(load)
    parts = [
        rule_rows(tables, rule).select(F.lit(kind).alias("defect"), F.col(DEMO_KEYS[kind]).cast("string").alias("row_key"))
        for kind, rule in DEMO_RULES.items()
    ]
    missing = tables["orders"].join(tables["target"].select("order_id"), "order_id", "left_anti")
    parts.append(
        missing.select(F.lit("missing_in_target").alias("defect"), F.col("order_id").cast("string").alias("row_key"))
    )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def demo_injected(load: Loader):
    orders, items = demo_inputs(load)
    kinds = [
        (orders, "order_id", "bad_currency", "currency"),
        (orders, "order_id", "future_date", "future"),
        (items, "item_id", "negative_quantity", "quantity"),
        (items, "item_id", "orphan_line", "orphan_line"),
        (orders, "order_id", "wrong_total", "total"),
        (orders, "order_id", "missing_in_target", "gap"),
    ]
    result = None
    for df, key, kind, op in kinds:
        text = F.col(key).cast("string")
        part = df.where(chosen(text, op, _D[kind])).select(F.lit(kind).alias("defect"), text.alias("row_key"))
        result = part if result is None else result.unionByName(part)
    return result


@query("demo_defects", f"WITH {DEMO} SELECT defect, row_key FROM caught")
def demo_defects(load):
    return demo_caught(load)


@query(
    "defect_recall",
    f"""WITH {DEMO}, marks AS (SELECT defect, row_key, max(i) AS i, max(c) AS c FROM (
        SELECT defect, row_key, 1 AS i, 0 AS c FROM injected UNION ALL SELECT defect, row_key, 0, 1 FROM caught)
      GROUP BY 1, 2)
    SELECT defect, sum(i)::BIGINT AS injected, count(*) FILTER (WHERE i = 1 AND c = 1) AS caught,
      count(*) FILTER (WHERE i = 1 AND c = 0) AS missed, count(*) FILTER (WHERE i = 0 AND c = 1) AS unexpected,
      round(count(*) FILTER (WHERE i = 1 AND c = 1) * 100 / sum(i), 2) AS recall_pct FROM marks GROUP BY 1""",
)
def defect_recall(load):
    return defects.defect_recall(demo_injected(load), demo_caught(load))


# --- duplicates ------------------------------------------------------------------------------------
LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
LINE_SQL = LINE_COLUMNS.replace("l_linenumber", "l_linenumber::BIGINT AS l_linenumber")
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey,
  l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS nth FROM lineitem)"""


@query("dedup_keep_first", f"WITH {RANKED} SELECT {LINE_SQL} FROM ranked WHERE nth = 1")
def dedup_keep_first(load):
    kept = dedup.keep_first(load("lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return kept.select(*LINE_COLUMNS.split(", "))


@query("dedup_surplus", f"WITH {RANKED} SELECT {LINE_SQL} FROM ranked WHERE nth > 1")
def dedup_surplus(load):
    extra = dedup.surplus_rows(load("lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return extra.select(*LINE_COLUMNS.split(", "))


@query(
    "latest_per_key",
    f"""SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, {stamp_sql('ts')} AS ts, value
    FROM events ORDER BY user_id, event_type, events.ts DESC, event_id DESC""",
)
def latest_per_key(load):
    found = dedup.latest_per_key(load("events"), ["user_id", "event_type"], "ts", ["event_id"])
    return found.select("user_id", "event_type", "event_id", "ts", "value")


@query("distinct_domains", "SELECT DISTINCT lang, source FROM documents")
def distinct_domains(load):
    return load("documents").select("lang", "source").distinct()


# --- standardising -------------------------------------------------------------------------------------
def parsed_sql(value: str) -> str:
    formats = ", ".join(f"'{f}'" for f in ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%b-%Y", "%Y%m%d", "%d.%m.%Y"))
    return f"try_strptime(trim({value}), [{formats}])::DATE"


EMAIL_SQL = "nullif(regexp_replace(replace(lower(trim(email)), ',', '.'), '\\.{2,}', '.', 'g'), '')"
DIGITS_SQL = "regexp_replace(phone, '[^0-9]', '', 'g')"
PHONE_SQL = (
    f"CASE WHEN length({DIGITS_SQL}) = 10 OR (length({DIGITS_SQL}) = 11 AND {DIGITS_SQL} LIKE '1%') "
    f"THEN '+1' || right({DIGITS_SQL}, 10) END"
)


@query(
    "standardize_dates",
    f"""WITH {inputs.DIRTY_CUSTOMERS} SELECT customer_id, signup_date, {day_sql(parsed_sql('signup_date'))} AS parsed
    FROM dirty_customers""",
)
def standardize_dates(load):
    return inputs.dirty_customers(load).select(
        "customer_id", "signup_date", standardize.parse_date(F.col("signup_date")).alias("parsed")
    )


@query(
    "standardize_contacts",
    f"""WITH {inputs.DIRTY_CUSTOMERS} SELECT customer_id, {EMAIL_SQL} AS email, {PHONE_SQL} AS phone,
      trim(regexp_replace(segment, '\\s+', ' ', 'g')) AS segment FROM dirty_customers""",
)
def standardize_contacts(load):
    return inputs.dirty_customers(load).select(
        "customer_id",
        standardize.clean_email(F.col("email")).alias("email"),
        standardize.clean_phone(F.col("phone")).alias("phone"),
        standardize.squeeze_spaces(F.col("segment")).alias("segment"),
    )


# --- publishing -----------------------------------------------------------------------------------------
LOADED = "2002-01-01 00:00:00"
DIM = f"""{inputs.DIRTY_CUSTOMERS}, conformed AS (
  SELECT customer_id AS customer_bk, upper(name) AS name, trim(segment) AS segment, {EMAIL_SQL} AS email, {PHONE_SQL} AS phone,
    nullif(country, '') AS country, {parsed_sql('signup_date')} AS registration_date,
    row_number() OVER (PARTITION BY customer_id ORDER BY name, segment, email NULLS FIRST, phone NULLS FIRST, country,
      signup_date) AS nth FROM dirty_customers),
  dim AS (SELECT row_number() OVER (ORDER BY substr(md5(customer_bk), 1, 3), customer_bk) AS customer_sk,
    * EXCLUDE (nth) FROM conformed WHERE nth = 1 AND customer_bk IS NOT NULL AND registration_date IS NOT NULL
    AND coalesce(registration_date <= DATE '2025-12-31', true))"""


def conformed_customers(load: Loader):
    """One clean row per customer, ready for the dimension."""
    first = dedup.keep_first(inputs.dirty_customers(load), ["customer_id"], ["name"])
    rows = first.select(
        F.col("customer_id").alias("customer_bk"),
        F.upper("name").alias("name"),
        F.trim("segment").alias("segment"),
        standardize.clean_email(F.col("email")).alias("email"),
        standardize.clean_phone(F.col("phone")).alias("phone"),
        F.nullif("country", F.lit("")).alias("country"),
        standardize.parse_date(F.col("signup_date")).alias("registration_date"),
    )
    return publish.publishable(
        rows, required=["customer_bk", "registration_date"], constraints=["registration_date <= date'2025-12-31'"]
    )


def dimension(load: Loader):
    return publish.number_rows(conformed_customers(load), F.col("customer_bk"), "customer_sk")


@query("publish_dim", f"WITH {DIM} SELECT * REPLACE ({day_sql('registration_date')} AS registration_date) FROM dim")
def publish_dim(load):
    return dimension(load)


def versioned(load: Loader):
    """The dimension as first published, all versions open, written and read back as a load would find it."""
    dim = dimension(load).select(
        "customer_sk", "customer_bk", "name", "email", "country",
        F.lit(LOADED).cast("timestamp_ntz").alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )
    return writers.stored(dim, "dim_customer")


def incoming(dim: DataFrame):
    """A later snapshot: some customers gone, some with a new address, some unknown so far."""
    key = F.col("customer_bk")
    rows = dim.select("customer_bk", "name", "email", "country")
    kept = rows.where(~chosen(key, "left", 0.1)).withColumn(
        "email", F.when(chosen(key, "moved", 0.2), F.concat(F.lit("new."), "email")).otherwise(F.col("email"))
    )
    new = rows.where(chosen(key, "joined", 0.05)).withColumn("customer_bk", F.concat(F.lit("NEW"), key))
    return writers.stored(kept.unionByName(new), "incoming_customers")


SCD_AS_OF = "2003-01-01 00:00:00"
SCD = f"""{DIM}, incoming AS (
  SELECT customer_bk, name, CASE WHEN {chosen_sql('customer_bk', 'moved', 0.2)} THEN 'new.' || email ELSE email END AS email,
    country FROM dim WHERE NOT {chosen_sql('customer_bk', 'left', 0.1)} UNION ALL
  SELECT 'NEW' || customer_bk, name, email, country FROM dim WHERE {chosen_sql('customer_bk', 'joined', 0.05)}),
  compared AS (SELECT coalesce(d.customer_bk, i.customer_bk) AS customer_bk, d.customer_sk, d.name AS old_name,
    d.email AS old_email, d.country AS old_country, i.name, i.email, i.country,
    d.customer_bk IS NOT NULL AS known, i.customer_bk IS NOT NULL AND d.customer_bk IS NOT NULL AND
      (d.name IS DISTINCT FROM i.name OR d.email IS DISTINCT FROM i.email OR d.country IS DISTINCT FROM i.country) AS changed
    FROM dim d FULL JOIN incoming i ON d.customer_bk = i.customer_bk),
  versions AS (
    SELECT customer_sk, customer_bk, old_name AS name, old_email AS email, old_country AS country,
      '{LOADED}' AS effective_from, CASE WHEN changed THEN '{SCD_AS_OF}' END AS effective_to, NOT changed AS is_current
    FROM compared WHERE known UNION ALL
    SELECT (SELECT max(customer_sk) FROM dim) + row_number() OVER (ORDER BY substr(md5(customer_bk), 1, 3), customer_bk),
      customer_bk, name, email, country, '{SCD_AS_OF}', NULL, true FROM compared WHERE changed OR NOT known)"""


def merged_customers(load: Loader):
    dim = versioned(load)
    return publish.scd2_merge(
        dim, incoming(dim), key="customer_bk", surrogate="customer_sk",
        attributes=["name", "email", "country"], as_of=SCD_AS_OF,
    )


@query("scd2_merge", f"WITH {SCD} SELECT * FROM versions")
def scd2_merge(load):
    return merged_customers(load)


@query(
    "rule_history",
    f"""WITH {SCD} SELECT customer_bk, count(*) AS versions, count(*) FILTER (WHERE is_current) AS open_versions,
      max(effective_from) AS latest_from FROM versions GROUP BY customer_bk HAVING count(*) > 1""",
)
def rule_history(load):
    return (
        merged_customers(load).groupBy("customer_bk")
        .agg(
            F.count("*").alias("versions"),
            F.count_if("is_current").alias("open_versions"),
            F.max("effective_from").alias("latest_from"),
        )
        .where("versions > 1")
    )


FACT = f"""{DIM}, {inputs.DIRTY_SALES}, sales AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY order_date, customer_id NULLS FIRST, employee_id, amount NULLS FIRST) AS nth FROM dirty_sales) WHERE nth = 1),
  facts AS (SELECT s.*, d.customer_sk FROM sales s LEFT JOIN dim d ON d.customer_bk = s.customer_id)"""


def facts(load: Loader):
    sales = dedup.keep_first(inputs.dirty_sales(load), ["order_id"], ["order_date"])
    dim = versioned(load)
    return publish.publish_fact(
        sales, dim, dim_key="customer_bk", dim_surrogate="customer_sk", reference="customer_id"
    )


@query(
    "publish_fact",
    f"""WITH {FACT} SELECT order_id AS order_bk, customer_sk, {day_sql(parsed_sql('order_date'))} AS order_date,
      amount::DOUBLE AS revenue, 1::BIGINT AS load_execution_id FROM facts WHERE customer_sk IS NOT NULL AND amount > 0""",
)
def publish_fact(load):
    resolved, _ = facts(load)
    kept = publish.publishable(resolved, required=["order_id", "amount"], constraints=["amount > 0"])
    return kept.select(
        F.col("order_id").alias("order_bk"),
        "customer_sk",
        standardize.parse_date(F.col("order_date")).alias("order_date"),
        F.col("amount").alias("revenue"),
        F.lit(1).alias("load_execution_id"),
    )


@query(
    "publish_fact_rejects",
    f"WITH {FACT} SELECT order_id, customer_id, amount::DOUBLE AS amount FROM facts WHERE customer_sk IS NULL",
)
def publish_fact_rejects(load):
    return facts(load)[1].select("order_id", "customer_id", "amount")


@query(
    "insert_if_absent",
    f"""WITH {inputs.RECON} SELECT order_id, customer_id, total_amount::DOUBLE AS total_amount FROM source
    WHERE order_id NOT IN (SELECT order_id FROM target)""",
)
def insert_if_absent(load):
    missing = publish.insert_if_absent(inputs.recon_target(load), inputs.recon_source(load), ["order_id"])
    return missing.select("order_id", "customer_id", "total_amount")


MERGED = "order_id, customer_id, status, total_amount::DOUBLE AS total_amount"


@query(
    "catalog_upsert_ignore",
    f"""WITH {inputs.RECON} SELECT {MERGED} FROM source UNION ALL
    SELECT {MERGED} FROM target WHERE order_id NOT IN (SELECT order_id FROM source)""",
)
def catalog_upsert_ignore(load):
    merged = publish.merge_by_key(inputs.recon_source(load), inputs.recon_target(load), ["order_id"])
    return merged.select("order_id", "customer_id", "status", "total_amount")


UPSERTED = f"""WITH {inputs.RECON} SELECT coalesce(s.order_id, t.order_id) AS order_id,
      coalesce(s.customer_id, t.customer_id) AS customer_id,
      CASE WHEN t.order_id IS NOT NULL THEN t.status ELSE s.status END AS status,
      coalesce(t.total_amount, s.total_amount)::DOUBLE AS total_amount
    FROM source s FULL JOIN target t ON s.order_id = t.order_id"""


@query(
    "catalog_upsert_update",
    UPSERTED,
)
def catalog_upsert_update(load):
    merged = publish.merge_by_key(
        inputs.recon_source(load), inputs.recon_target(load), ["order_id"],
        on_conflict="update", columns=["status", "total_amount"],
    )
    return merged.select("order_id", "customer_id", "status", "total_amount")


# --- upserts that rewrite only what they touch ------------------------------------------------
@query("pruned_upsert", UPSERTED)
def pruned_upsert(load):
    """The same upsert on a table kept in parts, in two versions of which the second is written twice."""
    base, updates = inputs.recon_source(load), inputs.recon_target(load)
    store = KeyedStore(load.spark, new_path(load.spark, "keyed"), base.schema, ["order_id"], parts=16)
    store.create(base)
    for _ in range(2):
        store.upsert(updates, version=1, columns=["status", "total_amount"])
    return store.read().select("order_id", "customer_id", "status", "total_amount")


@query("pruned_scd2_merge", f"WITH {SCD} SELECT * FROM versions")
def pruned_scd2_merge(load):
    dim = versioned(load)
    store = KeyedStore(load.spark, new_path(load.spark, "keyed-dim"), dim.schema, ["customer_bk"], parts=16)
    store.create(dim)
    store.merge_versions(
        incoming(dim), version=1, surrogate="customer_sk", attributes=["name", "email", "country"], as_of=SCD_AS_OF
    )
    return store.read()
