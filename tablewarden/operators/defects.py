"""Defect injection as column transforms.

Every decision depends on (seed, operation, row key) only, so the result is the same on any
cluster and partitioning. ``key`` is the text that identifies the row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.hashing import chosen, draw, threshold
from tablewarden.functions.text import replace_first, title_case
from tablewarden.functions.timing import moment

SEED = 42

# --- fixed values: defect rates per table and kind -------------------------------
RATES = {
    "customer": {
        "null_email": 0.04, "null_phone": 0.06, "bad_email": 0.07, "bad_phone": 0.10, "bad_date": 0.12,
        "casing": 0.05, "whitespace": 0.04, "empty_country": 0.02, "duplicates": 0.02,
    },
    "employee": {
        "null_manager": 0.08, "bad_date": 0.10, "bad_email": 0.05, "salary_range": 0.02, "duplicates": 0.01,
    },
    "sales": {
        "null_customer": 0.03, "orphan_customer": 0.04, "orphan_employee": 0.03, "null_amount": 0.02,
        "amount_range": 0.03, "bad_date": 0.10, "duplicates": 0.015,
    },
    "demo": {
        "empty_email": 0.03, "bad_email": 0.02, "negative_quantity": 0.003, "wrong_total": 0.01,
        "orphan_line": 0.002, "future_date": 0.005, "bad_currency": 0.004, "missing_in_target": 0.007,
    },
}

# fixed values: drifted date formats and extreme factors
DRIFT_FORMATS = ["dd/MM/yyyy", "MM/dd/yyyy", "dd-MMM-yyyy", "yyyyMMdd", "dd.MM.yyyy"]
EXTREME_FACTORS = [1000, 10000, 100000]


def _mode(key: Column, op: str, modes: int, seed: int) -> Column:
    """Second, independent draw that picks one of several variants."""
    return F.pmod(draw(key, f"{op}/mode", seed), F.lit(modes))


def _nonempty(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def inject_null(value: Column, key: Column, *, prob: float, op: str = "null", seed: int = SEED) -> Column:
    return F.when(~chosen(key, op, prob, seed), value)


def inject_empty(value: Column, key: Column, *, prob: float, op: str = "empty", seed: int = SEED) -> Column:
    return F.when(chosen(key, op, prob, seed), F.lit("")).otherwise(value)


def inject_date_drift(value: Column, key: Column, *, prob: float, op: str = "date", seed: int = SEED) -> Column:
    """Rewrite an ISO date text in one of five other formats; other texts stay."""
    day = F.try_to_timestamp(value, F.lit("yyyy-MM-dd"))
    mode = _mode(key, op, len(DRIFT_FORMATS), seed)
    drifted = F.date_format(day, DRIFT_FORMATS[-1])
    for i, pattern in reversed(list(enumerate(DRIFT_FORMATS[:-1]))):
        drifted = F.when(mode == i, F.date_format(day, pattern)).otherwise(drifted)
    return F.when(chosen(key, op, prob, seed) & day.isNotNull(), drifted).otherwise(value)


def inject_email(value: Column, key: Column, *, prob: float, op: str = "email", seed: int = SEED) -> Column:
    """Lose the @, double the first dot, pad, upper-case, or turn the first dot into a comma."""
    mode = _mode(key, op, 5, seed)
    broken = (
        F.when(mode == 0, F.replace(value, F.lit("@"), F.lit("")))
        .when(mode == 1, replace_first(value, ".", ".."))
        .when(mode == 2, F.concat(F.lit("  "), value, F.lit("  ")))
        .when(mode == 3, F.upper(value))
        .otherwise(replace_first(value, ".", ","))
    )
    return F.when(chosen(key, op, prob, seed) & _nonempty(value), broken).otherwise(value)


def inject_phone(value: Column, key: Column, *, prob: float, op: str = "phone", seed: int = SEED) -> Column:
    """Digits only, groups of three, last ten digits, or (ddd) ddd-rest."""
    mode = _mode(key, op, 4, seed)
    digits = F.regexp_replace(value, "[^0-9]", "")
    rest = digits.substr(F.lit(7), F.greatest(F.length(digits), F.lit(1)))
    broken = (
        F.when(mode == 0, digits)
        .when(mode == 1, F.rtrim(F.regexp_replace(digits, "([0-9]{3})", "$1 ")))
        .when((mode == 2) & (F.length(digits) > 10), F.right(digits, F.lit(10)))
        .otherwise(
            F.concat(
                F.lit("("), F.substring(digits, 1, 3), F.lit(") "), F.substring(digits, 4, 3), F.lit("-"), rest
            )
        )
    )
    return F.when(chosen(key, op, prob, seed) & _nonempty(value), broken).otherwise(value)


def inject_casing(value: Column, key: Column, *, prob: float, op: str = "casing", seed: int = SEED) -> Column:
    mode = _mode(key, op, 3, seed)
    drifted = F.when(mode == 0, F.upper(value)).when(mode == 1, F.lower(value)).otherwise(title_case(value))
    return F.when(chosen(key, op, prob, seed) & _nonempty(value), drifted).otherwise(value)


def inject_whitespace(value: Column, key: Column, *, prob: float, op: str = "space", seed: int = SEED) -> Column:
    """One to three spaces on both sides."""
    pad = F.repeat(F.lit(" "), (_mode(key, op, 3, seed) + 1).cast("int"))
    return F.when(chosen(key, op, prob, seed) & _nonempty(value), F.concat(pad, value, pad)).otherwise(value)


def inject_numeric(
    value: Column,
    key: Column,
    *,
    prob: float,
    negative: bool = True,
    extreme: bool = True,
    op: str = "numeric",
    seed: int = SEED,
) -> Column:
    """Negate (half of the chosen rows) or blow the number up by a large factor."""
    factor = F.element_at(F.array(*[F.lit(f) for f in EXTREME_FACTORS]), (_mode(key, op, 3, seed) + 1).cast("int"))
    changed = value * factor if extreme else value
    if negative:
        coin = draw(key, f"{op}/coin", seed) < F.lit(threshold(0.5))
        changed = F.when(coin, -F.abs(value)).otherwise(changed)
    return F.when(chosen(key, op, prob, seed), changed).otherwise(value)


def inject_orphan(
    value: Column, key: Column, *, prob: float, pool: list | None = None, op: str = "orphan", seed: int = SEED
) -> Column:
    """Replace a reference by one of the pool or by ``ORPH-`` and six letters."""
    if pool:
        stray = F.element_at(F.array(*[F.lit(p) for p in pool]), (_mode(key, op, len(pool), seed) + 1).cast("int"))
    else:
        digest = F.md5(F.concat(F.lit(f"{seed}|{op}/letters|"), key.cast("string")))
        stray = F.concat(F.lit("ORPH-"), F.translate(F.substring(digest, 1, 6), "0123456789abcdef", "ABCDEFGHIJKLMNOP"))
    return F.when(chosen(key, op, prob, seed), stray).otherwise(value)


def inject_duplicates(
    df: DataFrame, key: Column, *, rate: float, op: str = "duplicate", seed: int = SEED
) -> DataFrame:
    """Append exact copies of the drawn rows; the smallest draw is always copied, so there is at least one."""
    if rate <= 0:
        return df
    smallest = df.agg(F.min(draw(key, op, seed))).scalar()
    drawn = draw(key, op, seed)
    copied = (drawn < F.lit(threshold(rate))) | (drawn == smallest)
    copies = F.when(copied, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


# --- table plans -------------------------------------------------------------------
def corrupt_customers(df: DataFrame, rates: Mapping[str, float] = RATES["customer"], seed: int = SEED) -> DataFrame:
    """Columns customer_id, name, segment, email, phone, country, signup_date (all text)."""
    key = F.col("customer_id")
    email = inject_null(F.col("email"), key, prob=rates["null_email"], op="null_email", seed=seed)
    phone = inject_null(F.col("phone"), key, prob=rates["null_phone"], op="null_phone", seed=seed)
    dirty = df.select(
        "customer_id",
        inject_casing(F.col("name"), key, prob=rates["casing"], seed=seed).alias("name"),
        inject_whitespace(F.col("segment"), key, prob=rates["whitespace"], seed=seed).alias("segment"),
        inject_email(email, key, prob=rates["bad_email"], seed=seed).alias("email"),
        inject_phone(phone, key, prob=rates["bad_phone"], seed=seed).alias("phone"),
        inject_empty(F.col("country"), key, prob=rates["empty_country"], op="country", seed=seed).alias("country"),
        inject_date_drift(F.col("signup_date"), key, prob=rates["bad_date"], seed=seed).alias("signup_date"),
    )
    return inject_duplicates(dirty, key, rate=rates["duplicates"], seed=seed)


def corrupt_employees(df: DataFrame, rates: Mapping[str, float] = RATES["employee"], seed: int = SEED) -> DataFrame:
    """Columns employee_id, email, hire_date, salary, manager_id."""
    key = F.col("employee_id")
    dirty = df.select(
        "employee_id",
        inject_email(F.col("email"), key, prob=rates["bad_email"], seed=seed).alias("email"),
        inject_date_drift(F.col("hire_date"), key, prob=rates["bad_date"], seed=seed).alias("hire_date"),
        inject_numeric(F.col("salary"), key, prob=rates["salary_range"], op="salary", seed=seed).alias("salary"),
        inject_null(F.col("manager_id"), key, prob=rates["null_manager"], op="manager", seed=seed).alias("manager_id"),
    )
    return inject_duplicates(dirty, key, rate=rates["duplicates"], seed=seed)


def corrupt_sales(df: DataFrame, rates: Mapping[str, float] = RATES["sales"], seed: int = SEED) -> DataFrame:
    """Columns order_id, order_date, customer_id, employee_id, amount, currency."""
    key = F.col("order_id")
    customer = inject_null(F.col("customer_id"), key, prob=rates["null_customer"], op="null_customer", seed=seed)
    stray = inject_orphan(customer, key, prob=rates["orphan_customer"], op="orphan_customer", seed=seed)
    amount = inject_null(F.col("amount"), key, prob=rates["null_amount"], op="null_amount", seed=seed)
    dirty = df.select(
        "order_id",
        inject_date_drift(F.col("order_date"), key, prob=rates["bad_date"], seed=seed).alias("order_date"),
        F.when(customer.isNotNull(), stray).alias("customer_id"),
        inject_orphan(
            F.col("employee_id"), key, prob=rates["orphan_employee"], op="orphan_employee", seed=seed
        ).alias("employee_id"),
        inject_numeric(amount, key, prob=rates["amount_range"], op="amount", seed=seed).alias("amount"),
        "currency",
    )
    return inject_duplicates(dirty, key, rate=rates["duplicates"], seed=seed)


def corrupt_demo(
    orders: DataFrame, items: DataFrame, *, as_of, rates: Mapping[str, float] = RATES["demo"], seed: int = SEED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source orders, source items and target orders of the demo, each with its known defects.

    orders: order_id, order_date, currency, total_amount;  items: item_id, order_id, quantity, unit_price.
    """
    okey, ikey = F.col("order_id").cast("string"), F.col("item_id").cast("string")
    late_days = F.pmod(draw(okey, "future/mode", seed), F.lit(56)) + 5
    late = moment(as_of) + F.make_dt_interval(days=late_days.cast("int"))
    inflation = F.lit(1.05) + F.pmod(draw(okey, "total/mode", seed), F.lit(16)) / 100
    dirty_orders = orders.select(
        "order_id",
        F.when(chosen(okey, "future", rates["future_date"], seed), late)
        .otherwise(F.col("order_date"))
        .alias("order_date"),
        F.when(chosen(okey, "currency", rates["bad_currency"], seed), F.lit("ZZZ"))
        .otherwise(F.col("currency"))
        .alias("currency"),
        F.when(
            chosen(okey, "total", rates["wrong_total"], seed),
            F.round(F.col("total_amount") * inflation.cast("decimal(5,2)"), 2),
        )
        .otherwise(F.col("total_amount"))
        .cast("decimal(18,2)")
        .alias("total_amount"),
    )
    quantity = F.when(
        chosen(ikey, "quantity", rates["negative_quantity"], seed), -F.col("quantity")
    ).otherwise(F.col("quantity"))
    dirty_items = items.select(
        "item_id",
        F.when(chosen(ikey, "orphan_line", rates["orphan_line"], seed), F.lit(-1).cast("bigint"))
        .otherwise(F.col("order_id"))
        .alias("order_id"),
        quantity.alias("quantity"),
        "unit_price",
        (quantity * F.col("unit_price")).cast("decimal(18,2)").alias("line_amount"),
    )
    target = dirty_orders.where(~chosen(okey, "gap", rates["missing_in_target"], seed))
    return dirty_orders, dirty_items, target


def defect_recall(injected: DataFrame, caught: DataFrame) -> DataFrame:
    """Injected, caught and missed rows per defect kind.

    Both inputs hold (defect, row_key); they are combined by one aggregate on that pair.
    """
    marks = injected.select("defect", "row_key", F.lit(1).alias("i"), F.lit(0).alias("c")).unionByName(
        caught.select("defect", "row_key", F.lit(0).alias("i"), F.lit(1).alias("c"))
    )
    per_key = marks.groupBy("defect", "row_key").agg(F.max("i").alias("i"), F.max("c").alias("c"))
    sums = per_key.groupBy("defect").agg(
        F.sum("i").cast("bigint").alias("injected"),
        F.count_if((F.col("i") == 1) & (F.col("c") == 1)).alias("caught"),
        F.count_if((F.col("i") == 1) & (F.col("c") == 0)).alias("missed"),
        F.count_if((F.col("i") == 0) & (F.col("c") == 1)).alias("unexpected"),
    )
    return sums.withColumn("recall_pct", F.round(F.col("caught") * 100 / F.nullif("injected", F.lit(0)), 2))
