"""Inputs derived from the given tables, once for Spark and once as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.hashing import chosen, draw
from tablewarden.operators import defects
from tablewarden.plans.registry import Loader, chosen_sql, draw_sql


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


# --- clean staging tables ------------------------------------------------------------
def staged_customers(load: Loader) -> DataFrame:
    key = F.col("c_custkey")
    nation = load("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return load("customer").join(nation, "c_nationkey").select(
        F.concat(F.lit("CUST"), key).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@acme.io")).alias("email"),
        F.concat(F.lit("+1-555-"), (key % 900 + 100), F.lit("-"), (key % 9000 + 1000)).alias("phone"),
        F.col("n_name").alias("country"),
        F.date_format(F.date_add(F.lit("2018-01-01").cast("date"), (key % 2900).cast("int")), "yyyy-MM-dd").alias(
            "signup_date"
        ),
    )


CLEAN_CUSTOMERS = """clean_customers AS (
  SELECT 'CUST' || c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment,
         lower(replace(c_name, '#', '.')) || '@acme.io' AS email,
         '+1-555-' || (c_custkey % 900 + 100) || '-' || (c_custkey % 9000 + 1000) AS phone,
         n_name AS country,
         strftime(DATE '2018-01-01' + (c_custkey % 2900)::INT, '%Y-%m-%d') AS signup_date
  FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


def staged_sales(load: Loader) -> DataFrame:
    return load("orders").select(
        F.concat(F.lit("ORD"), F.col("o_orderkey")).alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.concat(F.lit("CUST"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("EMP"), F.col("o_custkey") % 100).alias("employee_id"),
        money("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"),
    )


CLEAN_SALES = """clean_sales AS (
  SELECT 'ORD' || o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
         'CUST' || o_custkey AS customer_id, 'EMP' || (o_custkey % 100) AS employee_id,
         o_totalprice::DECIMAL(18,2) AS amount, 'USD' AS currency
  FROM orders)"""


def staged_employees(load: Loader) -> DataFrame:
    key = F.col("s_suppkey")
    return load("supplier").select(
        F.concat(F.lit("EMP"), key).alias("employee_id"),
        F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("@company.com")).alias("email"),
        F.date_format(F.date_add(F.lit("2010-01-01").cast("date"), (key * 53 % 5800).cast("int")), "yyyy-MM-dd").alias(
            "hire_date"
        ),
        (F.lit(40000) + F.round(F.abs("s_acctbal")).cast("bigint")).alias("salary"),
        F.when(key >= 10, F.concat(F.lit("EMP"), F.floor(key / 10))).alias("manager_id"),
    )


CLEAN_EMPLOYEES = """clean_employees AS (
  SELECT 'EMP' || s_suppkey AS employee_id, lower(replace(s_name, '#', '.')) || '@company.com' AS email,
         strftime(DATE '2010-01-01' + (s_suppkey * 53 % 5800)::INT, '%Y-%m-%d') AS hire_date,
         40000 + round(abs(s_acctbal))::BIGINT AS salary,
         CASE WHEN s_suppkey >= 10 THEN 'EMP' || (s_suppkey // 10) END AS manager_id
  FROM supplier)"""


# --- SQL of the defect transforms ------------------------------------------------------
def date_drift_sql(value: str, key: str, prob: float) -> str:
    day = f"try_strptime({value}, '%Y-%m-%d')"
    return f"""CASE WHEN {chosen_sql(key, 'date', prob)} AND {day} IS NOT NULL THEN
      CASE {draw_sql(key, 'date/mode')} % 5
        WHEN 0 THEN strftime({day}, '%d/%m/%Y') WHEN 1 THEN strftime({day}, '%m/%d/%Y')
        WHEN 2 THEN strftime({day}, '%d-%b-%Y') WHEN 3 THEN strftime({day}, '%Y%m%d')
        ELSE strftime({day}, '%d.%m.%Y') END
      ELSE {value} END"""


def email_defect_sql(value: str, key: str, prob: float) -> str:
    return f"""CASE WHEN {chosen_sql(key, 'email', prob)} AND {value} <> '' THEN
      CASE {draw_sql(key, 'email/mode')} % 5
        WHEN 0 THEN replace({value}, '@', '') WHEN 1 THEN regexp_replace({value}, '\\.', '..')
        WHEN 2 THEN '  ' || {value} || '  ' WHEN 3 THEN upper({value})
        ELSE regexp_replace({value}, '\\.', ',') END
      ELSE {value} END"""


def phone_defect_sql(value: str, key: str, prob: float) -> str:
    digits = f"regexp_replace({value}, '[^0-9]', '', 'g')"
    mode = f"{draw_sql(key, 'phone/mode')} % 4"
    return f"""CASE WHEN {chosen_sql(key, 'phone', prob)} AND {value} <> '' THEN
      CASE WHEN {mode} = 0 THEN {digits}
           WHEN {mode} = 1 THEN rtrim(regexp_replace({digits}, '([0-9]{{3}})', '\\1 ', 'g'))
           WHEN {mode} = 2 AND length({digits}) > 10 THEN right({digits}, 10)
           ELSE '(' || substr({digits}, 1, 3) || ') ' || substr({digits}, 4, 3) || '-' || substr({digits}, 7) END
      ELSE {value} END"""


def casing_sql(value: str, key: str, prob: float) -> str:
    title = (
        f"list_aggregate(list_transform(regexp_extract_all(lower({value}), '\\p{{L}}+|[^\\p{{L}}]+'), "
        "lambda run: upper(run[1]) || run[2:]), 'string_agg', '')"
    )
    return f"""CASE WHEN {chosen_sql(key, 'casing', prob)} AND {value} <> '' THEN
      CASE {draw_sql(key, 'casing/mode')} % 3 WHEN 0 THEN upper({value}) WHEN 1 THEN lower({value}) ELSE {title} END
      ELSE {value} END"""


def space_sql(value: str, key: str, prob: float) -> str:
    pad = f"repeat(' ', ({draw_sql(key, 'space/mode')} % 3 + 1)::INT)"
    return f"CASE WHEN {chosen_sql(key, 'space', prob)} AND {value} <> '' THEN {pad} || {value} || {pad} ELSE {value} END"


def numeric_sql(value: str, key: str, prob: float, op: str) -> str:
    return f"""CASE WHEN {chosen_sql(key, op, prob)} THEN
      CASE WHEN {draw_sql(key, op + '/coin')} < 2147483648 THEN -abs({value})
           ELSE {value} * CASE {draw_sql(key, op + '/mode')} % 3 WHEN 0 THEN 1000 WHEN 1 THEN 10000 ELSE 100000 END END
      ELSE {value} END"""


def orphan_sql(value: str, key: str, prob: float, op: str) -> str:
    letters = f"translate(substr(md5('42|{op}/letters|' || {key}), 1, 6), '0123456789abcdef', 'ABCDEFGHIJKLMNOP')"
    return f"CASE WHEN {chosen_sql(key, op, prob)} THEN 'ORPH-' || {letters} ELSE {value} END"


def duplicates_sql(source: str, key: str, prob: float) -> str:
    mark = draw_sql(key, "duplicate")
    smallest = f"(SELECT min({mark}) FROM {source})"
    return (
        f"SELECT * FROM {source} UNION ALL "
        f"SELECT * FROM {source} WHERE {mark} < {int(prob * 2**32)} OR {mark} = {smallest}"
    )


def null_sql(value: str, key: str, prob: float, op: str) -> str:
    return f"CASE WHEN NOT {chosen_sql(key, op, prob)} THEN {value} END"


_C = defects.RATES["customer"]
DIRTY_CUSTOMERS = f"""{CLEAN_CUSTOMERS}, nulled_customers AS (
  SELECT customer_id, name, segment, {null_sql('email', 'customer_id', _C['null_email'], 'null_email')} AS email,
         {null_sql('phone', 'customer_id', _C['null_phone'], 'null_phone')} AS phone, country, signup_date
  FROM clean_customers), marked_customers AS (
  SELECT customer_id, {casing_sql('name', 'customer_id', _C['casing'])} AS name,
         {space_sql('segment', 'customer_id', _C['whitespace'])} AS segment,
         {email_defect_sql('email', 'customer_id', _C['bad_email'])} AS email,
         {phone_defect_sql('phone', 'customer_id', _C['bad_phone'])} AS phone,
         CASE WHEN {chosen_sql('customer_id', 'country', _C['empty_country'])} THEN '' ELSE country END AS country,
         {date_drift_sql('signup_date', 'customer_id', _C['bad_date'])} AS signup_date
  FROM nulled_customers), dirty_customers AS (
  {duplicates_sql('marked_customers', 'customer_id', _C['duplicates'])})"""


def dirty_customers(load: Loader) -> DataFrame:
    return defects.corrupt_customers(staged_customers(load))


_E = defects.RATES["employee"]
DIRTY_EMPLOYEES = f"""{CLEAN_EMPLOYEES}, marked_employees AS (
  SELECT employee_id, {email_defect_sql('email', 'employee_id', _E['bad_email'])} AS email,
         {date_drift_sql('hire_date', 'employee_id', _E['bad_date'])} AS hire_date,
         {numeric_sql('salary', 'employee_id', _E['salary_range'], 'salary')} AS salary,
         {null_sql('manager_id', 'employee_id', _E['null_manager'], 'manager')} AS manager_id
  FROM clean_employees), dirty_employees AS (
  {duplicates_sql('marked_employees', 'employee_id', _E['duplicates'])})"""


def dirty_employees(load: Loader) -> DataFrame:
    return defects.corrupt_employees(staged_employees(load))


_S = defects.RATES["sales"]
DIRTY_SALES = f"""{CLEAN_SALES}, nulled_sales AS (
  SELECT order_id, order_date, {null_sql('customer_id', 'order_id', _S['null_customer'], 'null_customer')} AS customer_id,
         employee_id, {null_sql('amount', 'order_id', _S['null_amount'], 'null_amount')} AS amount, currency
  FROM clean_sales), marked_sales AS (
  SELECT order_id, {date_drift_sql('order_date', 'order_id', _S['bad_date'])} AS order_date,
         CASE WHEN customer_id IS NOT NULL
              THEN {orphan_sql('customer_id', 'order_id', _S['orphan_customer'], 'orphan_customer')} END AS customer_id,
         {orphan_sql('employee_id', 'order_id', _S['orphan_employee'], 'orphan_employee')} AS employee_id,
         {numeric_sql('amount', 'order_id', _S['amount_range'], 'amount')} AS amount, currency
  FROM nulled_sales), dirty_sales AS (
  {duplicates_sql('marked_sales', 'order_id', _S['duplicates'])})"""


def dirty_sales(load: Loader) -> DataFrame:
    return defects.corrupt_sales(staged_sales(load))


# --- a source and a target that differ ---------------------------------------------------
def recon_source(load: Loader) -> DataFrame:
    return load("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderdate").alias("loaded_at"),
    )


def recon_target(load: Loader) -> DataFrame:
    """The source with lost, altered and unknown rows, loaded some hours later."""
    key = F.col("order_id").cast("string")
    source = recon_source(load)
    altered = source.where(~chosen(key, "gap", 0.007)).withColumns(
        {
            "total_amount": F.when(chosen(key, "altered", 0.01), F.col("total_amount") + F.lit(1).cast("decimal(3,2)"))
            .otherwise(F.col("total_amount"))
            .cast("decimal(18,2)"),
            "status": F.when(chosen(key, "restated", 0.005), F.lit(None)).otherwise(F.col("status")),
            "loaded_at": F.col("loaded_at") + F.make_dt_interval(secs=draw(key, "delay") % 14400),
        }
    )
    unknown = source.where(chosen(key, "unknown", 0.003)).withColumn("order_id", -F.col("order_id") - 1)
    return altered.unionByName(unknown)


RECON = f"""source AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
         o_totalprice::DECIMAL(18,2) AS total_amount, o_orderdate AS order_date, o_orderdate AS loaded_at
  FROM orders), target AS (
  SELECT order_id, customer_id,
         CASE WHEN {chosen_sql('order_id', 'restated', 0.005)} THEN NULL ELSE status END AS status,
         (CASE WHEN {chosen_sql('order_id', 'altered', 0.01)} THEN total_amount + 1 ELSE total_amount END)::DECIMAL(18,2)
           AS total_amount,
         order_date, loaded_at + to_seconds({draw_sql('order_id', 'delay')} % 14400) AS loaded_at
  FROM source WHERE NOT {chosen_sql('order_id', 'gap', 0.007)}
  UNION ALL
  SELECT -order_id - 1, customer_id, status, total_amount, order_date, loaded_at
  FROM source WHERE {chosen_sql('order_id', 'unknown', 0.003)})"""
