"""Bindings for reconciliation: orders against a target copy with known differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import digest_tree, trends
from tablewarden.operators import reconcile as rc
from tablewarden.operators.reconcile import Check
from tablewarden.plans import inputs
from tablewarden.plans.registry import Loader, query
from tablewarden.session import new_path

RUN, AS_OF = "run-1", "2001-08-02 00:00:00"
COLUMNS = ["customer_id", "status", "total_amount", "order_date"]
ROW_TEXT_SQL = "concat_ws('|', " + ", ".join(
    f"coalesce(length({c}) || ':' || {c}, '-')"
    for c in ("customer_id::VARCHAR", "status", "total_amount::VARCHAR", "strftime(order_date, '%Y-%m-%d %H:%M:%S')")
) + ")"
FINGERPRINT_SQL = f"coalesce(sum(('0x' || substr(md5({ROW_TEXT_SQL}), 1, 16))::UBIGINT::HUGEINT), 0)"


def diff_pct_sql(s: str, t: str) -> str:
    return f"round(abs({t} - {s}) * 100 / CASE WHEN {s} = 0 THEN 1 ELSE abs({s}) END, 6)"


def status_sql(s: str, t: str, tol: str) -> str:
    base = f"CASE WHEN {s} = 0 THEN 1 ELSE abs({s}) END"
    return (
        f"CASE WHEN {s} IS NULL OR {t} IS NULL THEN 'ERROR' WHEN {s} = {t} THEN 'PASS' "
        f"WHEN abs({t} - {s}) * 100 <= {tol} * {base} THEN 'WARN' ELSE 'FAIL' END"
    )


# (job, source SQL, target SQL)
JOBS = [
    (Check(1, "orders_rowcount", "row_count", "source", "target",
           source_where="customer_id IS NOT NULL AND total_amount > 0", tolerance_pct=0.5),
     "SELECT count(*) FROM source WHERE customer_id IS NOT NULL AND total_amount > 0", "SELECT count(*) FROM target"),
    (Check(2, "orders_rowcount_open", "row_count", "source", "target", source_where="status = 'O'",
           target_where="status = 'O'", tolerance_pct=5),
     "SELECT count(*) FROM source WHERE status = 'O'", "SELECT count(*) FROM target WHERE status = 'O'"),
    (Check(3, "orders_amount_sum", "sum_check", "source", "target", measure="total_amount", tolerance_pct=0.01),
     "SELECT sum(total_amount) FROM source", "SELECT sum(total_amount) FROM target"),
    (Check(4, "orders_guarded_sum", "sum_check", "source", "target",
           measure="CASE WHEN cast(total_amount AS string) RLIKE r'^-?[0-9]+(\\.[0-9]+)?$' THEN total_amount END",
           source_where="order_id IS NOT NULL", tolerance_pct=1),
     "SELECT sum(total_amount) FROM source", "SELECT sum(total_amount) FROM target"),
    (Check(5, "orders_distinct_keys", "distinct_check", "source", "target", measure="order_id"),
     "SELECT count(DISTINCT order_id) FROM source", "SELECT count(DISTINCT order_id) FROM target"),
    (Check(6, "orders_distinct_customers", "distinct_check", "source", "target", measure="customer_id"),
     "SELECT count(DISTINCT customer_id) FROM source", "SELECT count(DISTINCT customer_id) FROM target"),
    (Check(7, "orders_null_status", "null_check", "source", "target", measure="status"),
     "SELECT count(*) - count(status) FROM source", "SELECT count(*) - count(status) FROM target"),
    (Check(8, "orders_orphan_keys", "orphan_check", "source", "target", measure="order_id",
           parent=("source", "order_id")),
     "SELECT 0", "SELECT count(*) FROM target t WHERE NOT EXISTS (FROM source s WHERE s.order_id = t.order_id)"),
    (Check(9, "orders_orphan_customers", "orphan_check", "source", "target", measure="customer_id",
           parent=("customer", "c_custkey")),
     "SELECT 0", "SELECT count(*) FROM target t WHERE NOT EXISTS (FROM customer c WHERE c_custkey = customer_id)"),
    (Check(10, "orders_fingerprint", "hash_check", "source", "target", measure=",".join(COLUMNS)),
     f"SELECT {FINGERPRINT_SQL} FROM source", f"SELECT {FINGERPRINT_SQL} FROM target"),
    (Check(12, "orders_fingerprint_open", "hash_check", "source", "source", measure=",".join(COLUMNS),
           source_where="status = 'O'", target_where="status = 'O' AND order_id > 0"),
     f"SELECT {FINGERPRINT_SQL} FROM source WHERE status = 'O'",
     f"SELECT {FINGERPRINT_SQL} FROM source WHERE status = 'O' AND order_id > 0"),
    (Check(11, "orders_inactive", "row_count", "source", "target", active=False), None, None),
]


def jobs_sql(kinds: list[str] | None = None) -> str:
    """CTE ``recon`` with one row per active job of the wanted types."""
    rows = " UNION ALL ".join(
        f"SELECT {c.job_id}::BIGINT AS job_id, '{c.job_name}' AS job_name, '{c.check_type}' AS check_type, "
        f"({s})::DECIMAL(38,6) AS s, ({t})::DECIMAL(38,6) AS t, {c.tolerance_pct}::DOUBLE AS tolerance_pct"
        for c, s, t in JOBS
        if c.active and (kinds is None or c.check_type in kinds)
    )
    return f"""{inputs.RECON}, exact AS ({rows}), pairs AS (
      SELECT * EXCLUDE (s, t), s::DOUBLE AS source_value, t::DOUBLE AS target_value, (t - s)::DOUBLE AS diff FROM exact),
    recon AS (SELECT *, {diff_pct_sql('source_value', 'target_value')} AS diff_pct,
        {status_sql('source_value', 'target_value', 'tolerance_pct')} AS status FROM pairs)"""


def pair(load: Loader) -> dict:
    return {
        "source": inputs.recon_source(load),
        "target": inputs.recon_target(load),
        "customer": load("customer"),
    }


def run_jobs(load: Loader, kinds: list[str] | None = None):
    checks = [c for c, _, _ in JOBS if kinds is None or c.check_type in kinds]
    return rc.reconcile(pair(load), checks, run_id=RUN, as_of=AS_OF).drop("run_id", "executed_at")


def register(name: str, kinds: list[str] | None):
    @query(name, f"WITH {jobs_sql(kinds)} SELECT * FROM recon")
    def run(load):
        return run_jobs(load, kinds)


register("recon_results", None)
register("recon_row_count", ["row_count"])
register("recon_sum", ["sum_check"])
register("recon_distinct", ["distinct_check"])
register("recon_null", ["null_check"])
register("recon_orphan", ["orphan_check"])
register("recon_hash_total", ["hash_check"])


@query(
    "recon_status",
    f"""WITH {inputs.RECON}, pairs AS (
      SELECT order_id, s.total_amount::DOUBLE AS source_value, t.total_amount::DOUBLE AS target_value,
        0.001::DOUBLE AS tolerance_pct FROM source s FULL JOIN target t USING (order_id))
    SELECT order_id, diff_pct, status FROM (SELECT *, {diff_pct_sql('source_value', 'target_value')} AS diff_pct,
      {status_sql('source_value', 'target_value', 'tolerance_pct')} AS status FROM pairs) WHERE status <> 'PASS'""",
)
def recon_status(load):
    tables = pair(load)
    both = tables["source"].select("order_id", F.col("total_amount").alias("source_value")).join(
        tables["target"].select("order_id", F.col("total_amount").alias("target_value")), "order_id", "full_outer"
    )
    compared = rc.compared(both.withColumn("tolerance_pct", F.lit(0.001).cast("decimal(7,4)")))
    return compared.where("status <> 'PASS'").select("order_id", "diff_pct", "status")


@query(
    "recon_semi_valid_rows",
    f"""WITH {inputs.DIRTY_SALES} SELECT count(*) AS valid_rows, sum(amount)::DOUBLE AS valid_amount FROM dirty_sales
    WHERE order_id IS NOT NULL AND customer_id IN (SELECT 'CUST' || c_custkey FROM customer)""",
)
def recon_semi_valid_rows(load):
    known = load("customer").select(F.concat(F.lit("CUST"), F.col("c_custkey")).alias("customer_id"))
    valid = inputs.dirty_sales(load).where("order_id IS NOT NULL").join(known, "customer_id", "left_semi")
    return valid.agg(F.count("*").alias("valid_rows"), F.sum("amount").alias("valid_amount"))


DIFF = f"""{inputs.RECON}, diff AS (
  SELECT coalesce(s.order_id, t.order_id) AS order_id,
    CASE WHEN t.order_id IS NULL THEN 'MISSING_IN_TARGET' WHEN s.order_id IS NULL THEN 'MISSING_IN_SOURCE'
         WHEN s.customer_id IS DISTINCT FROM t.customer_id OR s.status IS DISTINCT FROM t.status
           OR s.total_amount IS DISTINCT FROM t.total_amount OR s.order_date IS DISTINCT FROM t.order_date
         THEN 'CHANGED' ELSE 'MATCH' END AS state,
    CASE WHEN t.order_id IS NOT NULL AND s.order_id IS NOT NULL THEN concat_ws(',',
      CASE WHEN s.customer_id IS DISTINCT FROM t.customer_id THEN 'customer_id' END,
      CASE WHEN s.status IS DISTINCT FROM t.status THEN 'status' END,
      CASE WHEN s.total_amount IS DISTINCT FROM t.total_amount THEN 'total_amount' END,
      CASE WHEN s.order_date IS DISTINCT FROM t.order_date THEN 'order_date' END) END AS changed_columns
  FROM source s FULL JOIN target t ON s.order_id = t.order_id)"""


def keyed(load: Loader):
    tables = pair(load)
    return rc.keyed_diff(tables["source"], tables["target"], ["order_id"], COLUMNS)


@query(
    "recon_keyed_diff",
    f"WITH {DIFF} SELECT order_id, state AS status, changed_columns FROM diff WHERE state <> 'MATCH'",
)
def recon_keyed_diff(load):
    return keyed(load).where("status <> 'MATCH'").select("order_id", "status", "changed_columns")


@query(
    "recon_tree_diff",
    f"WITH {DIFF} SELECT order_id, state AS status, changed_columns FROM diff WHERE state <> 'MATCH'",
)
def recon_tree_diff(load):
    """The same rows from two stored trees; leaves with equal digests are not read."""
    tables = pair(load)

    def tree(side: str):
        return digest_tree.write_tree(tables[side], ["order_id"], COLUMNS, new_path(load.spark, f"tree-{side}"), depth=1)

    return digest_tree.tree_diff(load.spark, tree("source"), tree("target")).select("order_id", "status", "changed_columns")


@query("recon_diff_summary", f"WITH {DIFF} SELECT state AS status, count(*) AS key_count FROM diff GROUP BY state")
def recon_diff_summary(load):
    return rc.diff_summary(keyed(load))


@query(
    "recon_column_mismatch",
    f"WITH {DIFF} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS compared, "
        f"count(*) FILTER (WHERE list_contains(string_split(changed_columns, ','), '{c}')) AS mismatches "
        "FROM diff WHERE state IN ('MATCH', 'CHANGED')"
        for c in COLUMNS
    ),
)
def recon_column_mismatch(load):
    return rc.column_mismatches(keyed(load), COLUMNS)


@query(
    "recon_row_hash",
    f"""WITH {inputs.RECON}, s AS (SELECT order_id, md5({ROW_TEXT_SQL}) AS digest FROM source),
      t AS (SELECT order_id, md5({ROW_TEXT_SQL}) AS digest FROM target)
    SELECT count(*) FILTER (WHERE s.digest = t.digest) AS matched, count(*) FILTER (WHERE s.digest <> t.digest) AS mismatched,
      count(*) FILTER (WHERE t.order_id IS NULL) AS source_only, count(*) FILTER (WHERE s.order_id IS NULL) AS target_only
    FROM s FULL JOIN t ON s.order_id = t.order_id""",
)
def recon_row_hash(load):
    tables = pair(load)
    return rc.row_hash_check(tables["source"], tables["target"], ["order_id"], COLUMNS)


@query(
    "recon_pk",
    """SELECT count(*) AS row_count, count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_rows
    FROM lineitem""",
)
def recon_pk(load):
    return rc.key_check(load("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "recon_fk",
    f"""WITH {inputs.DIRTY_SALES} SELECT count(*) AS row_count, count(*) FILTER (WHERE customer_id IS NULL) AS null_references,
      count(*) FILTER (WHERE customer_id IS NOT NULL AND c_custkey IS NULL) AS orphans
    FROM dirty_sales LEFT JOIN customer ON customer_id = 'CUST' || c_custkey""",
)
def recon_fk(load):
    known = load("customer").select(F.concat(F.lit("CUST"), F.col("c_custkey")).alias("customer_id"))
    return rc.foreign_key_check(inputs.dirty_sales(load), "customer_id", known, "customer_id")


@query(
    "recon_latency",
    f"""WITH {inputs.RECON}, lag AS (SELECT epoch(t.loaded_at) - epoch(s.loaded_at) AS seconds
      FROM source s JOIN target t USING (order_id))
    SELECT round(quantile_cont(seconds, 0.5), 4) AS p50, round(quantile_cont(seconds, 0.95), 4) AS p95,
      round(quantile_cont(seconds, 0.99), 4) AS p99 FROM lag""",
)
def recon_latency(load):
    tables = pair(load)
    probs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = trends.latency(
        tables["source"], tables["target"], "order_id",
        source_stamp="loaded_at", target_stamp="loaded_at", probs=probs,
    )
    return found.select(*[F.round(p, 4).alias(p) for p in probs])
