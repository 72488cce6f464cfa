"""Bindings for files and SQL functions: what is written must read back the same."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewarden.functions import masking
from tablewarden.operators import reports
from tablewarden.plans import governing, inputs, quarantines, reporting
from tablewarden.plans.governing import email_sql, partial_sql
from tablewarden.plans.registry import QUERIES, day_sql, query, stamp_sql
from tablewarden.plans.rules import ALL_RESULTS, SHOWN, SHOWN_SQL, all_results
from tablewarden.session import new_path
from tablewarden.sources import readers, writers


@query(
    "load_csv",
    f"""WITH {inputs.DIRTY_SALES} SELECT order_id, nullif(customer_id, '') AS customer_id, employee_id,
      amount::DOUBLE AS amount, currency, NULL::VARCHAR AS bad_line FROM dirty_sales""",
)
def load_csv(load):
    path = new_path(load.spark, "sales-csv")
    columns = ["order_id", "customer_id", "employee_id", "amount", "currency"]
    inputs.dirty_sales(load).select(*columns).write.option("header", True).csv(path)
    loaded = readers.load_csv(
        load.spark, path, "order_id string, customer_id string, employee_id string, amount decimal(20,2), currency string"
    )
    return loaded.withColumnRenamed(readers.BAD_RECORD, "bad_line")


@query("evidence_append", f"{ALL_RESULTS} SELECT 'run-2' AS run_id, {SHOWN_SQL} FROM results")
def evidence_append(load):
    path = new_path(load.spark, "rule-results")
    results = writers.stored(all_results(load), "results")
    for run in ("run-1", "run-2", "run-2"):  # a repeated run replaces its own rows
        writers.write_evidence(results, path, run_date="2001-01-01", run_id=run)
    return load.spark.read.parquet(path).where("run_id = 'run-2'").select("run_id", *SHOWN)


@query(
    "export_scorecard",
    f"""WITH {reporting.DETAIL} SELECT {day_sql('run_date')} AS run_date, dimension, count(*) AS checks_total,
      count(*) FILTER (WHERE status = 'PASS') AS checks_pass FROM detail
    WHERE run_date >= DATE '2000-01-01' GROUP BY detail.run_date, dimension""",
)
def export_scorecard(load):
    runs, results = reporting.runs(load), reporting.results(load)
    found = reports.sorted_reports(
        {
            "dimension_trend": reports.dimension_trend(results, runs),
            "table_health": reports.table_health(results, as_of=reporting.AS_OF),
        }
    )
    folder = new_path(load.spark, "exports")
    paths = writers.export_reports(found, folder, stamp="20010801_063000", since="2000-01-01")
    back = load.spark.read.option("header", True).schema(
        "run_date date, dimension string, checks_total bigint, checks_pass bigint, pass_pct double"
    )
    return back.csv(paths[0]).drop("pass_pct")


SINCE = "1996-01-01 00:00:00"
SIX = {
    "executive_scorecard": reporting.executive_scorecard, "rule_results_detail": reporting.rule_results_detail,
    "dimension_trend": reporting.dimension_trend, "table_health": reporting.table_health,
    "quarantine_backlog": quarantines.quarantine_backlog, "active_alerts": reporting.active_alerts,
}
# what each report is sorted by, as values that ascend
ASCENDS = {
    "executive_scorecard": "named_struct('known', started_at IS NOT NULL, 'at', -unix_micros(CAST(started_at AS timestamp)))",
    "rule_results_detail": "named_struct('known', executed_at IS NOT NULL, 'at', -unix_micros(CAST(executed_at AS timestamp)))",
    "dimension_trend": "named_struct('known', run_date IS NOT NULL, 'day', -unix_date(run_date), 'dimension', dimension)",
    "table_health": "named_struct('missing', health_score_pct IS NULL, 'score', health_score_pct)",
    "quarantine_backlog": "named_struct('known', open_rows IS NOT NULL, 'rows', -open_rows)",
    "active_alerts": "named_struct('known', triggered_at IS NOT NULL, 'at', -unix_micros(CAST(triggered_at AS timestamp)))",
}
FILTERED = {"executive_scorecard": "started_at", "rule_results_detail": "run_date", "dimension_trend": "run_date"}


@query(
    "export_all_reports",
    " UNION ALL ".join(
        f"SELECT '{name}' AS report, count(*) AS row_count, 0::BIGINT AS out_of_order FROM ({QUERIES[name].sql})"
        + (f" WHERE {FILTERED[name]} >= '{SINCE[:10]}'" if name in FILTERED else "")
        for name in SIX
    ),
)
def export_all_reports(load):
    """All six exports, filtered by date where they have one, and whether every file is in its order."""
    found = reports.sorted_reports({name: report(load) for name, report in SIX.items()})
    paths = writers.export_reports(found, new_path(load.spark, "all-exports"), stamp="20010801_063000", fmt="parquet", since=SINCE)
    checked = None
    for name, path in zip(found, paths, strict=True):
        rows = load.spark.read.parquet(path).select("*", "_metadata.file_name", "_metadata.row_index")
        earlier = F.lag("_key").over(Window.partitionBy("file_name").orderBy("row_index"))
        rows = rows.withColumn("_key", F.expr(ASCENDS[name])).withColumn("_out", F.coalesce(earlier > F.col("_key"), F.lit(False)))
        one = rows.agg(F.count("*").alias("row_count"), F.count_if("_out").alias("out_of_order"))
        one = one.select(F.lit(name).alias("report"), "row_count", "out_of_order")
        checked = one if checked is None else checked.unionByName(one)
    return checked


@query(
    "audit_extract",
    QUERIES["audit_activity"].sql,
)
def audit_extract(load):
    """Who changed what in the last 90 days, as an access review reads it."""
    activity = governing.audit_activity(load)
    path = writers.export_reports({"audit_activity": activity}, new_path(load.spark, "audit"), stamp="20010803")[0]
    back = load.spark.read.option("header", True).schema(
        "db_user string, schema_name string, table_name string, action string, event_count bigint, "
        "first_event timestamp_ntz, last_event timestamp_ntz"
    )
    return back.csv(path)


@query(
    "steward_map_extract",
    f"""WITH {quarantines.STEWARDS}, granted AS (SELECT event_type AS data_domain, min(ts) AS granted_at FROM events GROUP BY 1)
    SELECT row_number() OVER (ORDER BY db_user, data_domain) - 1 AS place, db_user, data_domain,
      {stamp_sql('granted_at')} AS granted_at, 'platform' AS granted_by FROM stewards JOIN granted USING (data_domain)""",
)
def steward_map_extract(load):
    """Who looks after which domain since when, in the order of an access review."""
    granted = load("events").groupBy(F.col("event_type").alias("data_domain")).agg(F.min("ts").alias("granted_at"))
    mapping = quarantines.stewards(load).join(granted, "data_domain").withColumn("granted_by", F.lit("platform"))
    folder = new_path(load.spark, "access")
    path = writers.export_reports({"steward_domain_map": governing.gov.steward_map(mapping)}, folder, stamp="20010803")[0]
    back = load.spark.read.option("header", True).schema(
        "db_user string, data_domain string, granted_at timestamp_ntz, granted_by string"
    )
    rows = back.csv(path).select("*", "_metadata.file_name", F.monotonically_increasing_id().alias("line"))
    place = F.row_number().over(Window.orderBy("file_name", "line")) - 1  # one row per domain and steward
    return rows.select(place.alias("place"), "db_user", "data_domain", "granted_at", "granted_by")


@query(
    "sql_masking_functions",
    f"""WITH {inputs.DIRTY_CUSTOMERS} SELECT customer_id, {partial_sql('name')} AS name, {email_sql('email')} AS email,
      sha256(coalesce(phone, '')) AS phone FROM dirty_customers""",
)
def sql_masking_functions(load):
    masking.register(load.spark)
    return inputs.dirty_customers(load).select(
        "customer_id", F.expr("mask_partial(name)").alias("name"), F.expr("mask_email(email)").alias("email"),
        F.expr("hash_id(phone)").alias("phone"),
    )
