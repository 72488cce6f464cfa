"""Masking by policy, classification, row access and change audit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions import masking
from tablewarden.functions.timing import ago, moment

# fixed values: roles that see every domain, and the domain everyone sees
ALL_DOMAIN_ROLES = ["platform_admin", "dq_engineer"]
PUBLIC_DOMAIN = "GLOBAL"


def apply_policy(
    df: DataFrame, policy: Iterable[Mapping], *, salt: str = "", emails: Iterable[str] = ("email",)
) -> DataFrame:
    """Mask the columns a policy names; columns without a policy row stay as they are.

    policy rows have column_name and masking_strategy; rows for absent columns are ignored.
    PARTIAL on an e-mail column keeps the first letter and the domain.
    """
    strategy = {p["column_name"]: p["masking_strategy"] for p in policy}

    def masked(column: str) -> Column:
        value, how = F.col(column), strategy.get(column, "NONE")
        if how == "PARTIAL":
            return masking.mask_email(value) if column in emails else masking.mask_partial(value)
        if how == "HASH":
            return masking.hash_id(value)
        if how == "REDACT":
            return masking.redact(value)
        if how == "TOKENIZE":
            return masking.tokenize(value, salt)
        return value

    return df.select(*[masked(c).alias(c) for c in df.columns])


def classification_coverage(catalog: DataFrame, classification: DataFrame) -> DataFrame:
    """Every column with its classification, or UNCLASSIFIED."""
    known = classification.select(
        "schema_name", "table_name", "column_name", "sensitivity", "masking_strategy", F.lit(True).alias("_known")
    )
    return catalog.join(known, ["schema_name", "table_name", "column_name"], "left").withColumn(
        "coverage_status", F.when(F.col("_known"), "OK").otherwise("UNCLASSIFIED")
    ).drop("_known")


def rule_coverage(catalog: DataFrame, rules: DataFrame) -> DataFrame:
    """Every column with its number of active rules."""
    active = (
        rules.where("is_active")
        .groupBy("schema_name", "table_name", "column_name")
        .agg(F.count("*").alias("rule_count"))
    )
    joined = catalog.join(active, ["schema_name", "table_name", "column_name"], "left")
    count = F.coalesce("rule_count", F.lit(0))
    return joined.withColumn("rule_count", count).withColumn("covered", count > 0)


# fixed values: what a detected type suggests
SUGGESTED = {
    "email": ("PII", "PARTIAL"),
    "phone_e164": ("PII", "PARTIAL"),
    "phone_us": ("PII", "PARTIAL"),
    "uuid": ("INTERNAL", "HASH"),
}


def suggest_classification(profiles: DataFrame) -> DataFrame:
    """Sensitivity and masking suggested by the inferred type of each column."""
    sensitivity, strategy = F.lit("INTERNAL"), F.lit("NONE")
    for kind, (level, how) in SUGGESTED.items():
        sensitivity = F.when(F.col("inferred_type") == kind, level).otherwise(sensitivity)
        strategy = F.when(F.col("inferred_type") == kind, how).otherwise(strategy)
    return profiles.select(
        "table_name",
        "column_name",
        "inferred_type",
        sensitivity.alias("sensitivity"),
        strategy.alias("masking_strategy"),
    )


def filter_by_domain(
    df: DataFrame, *, user: str, roles: Iterable[str], mapping: DataFrame, column: str = "data_domain"
) -> DataFrame:
    """Rows a user may see: all for the privileged roles, else own domains and the public one."""
    if set(roles) & set(ALL_DOMAIN_ROLES):
        return df
    granted = (
        mapping.where(F.col("db_user") == user)
        .select(F.col("data_domain").alias("_domain"))
        .distinct()
    )
    own = df.where(F.col(column) != PUBLIC_DOMAIN).join(granted, F.col(column) == F.col("_domain"), "left_semi")
    return df.where(F.col(column) == PUBLIC_DOMAIN).unionByName(own)


def change_audit(
    before: DataFrame,
    after: DataFrame,
    key: str,
    *,
    table: str,
    schema: str = "main",
    user: str = "system",
    as_of,
    include_unchanged: bool = False,
) -> DataFrame:
    """INSERT, UPDATE and DELETE rows between two snapshots with old and new row as JSON.

    ``changed_cols`` is NULL when nothing changed. The snapshots are stacked and reduced by key; a key that is NULL or
    twice in a snapshot ends the job with a message.
    """
    columns = before.columns
    stacked = before.withColumn("_old", F.lit(True)).unionByName(after.withColumn("_old", F.lit(False)))
    whole = F.struct(*columns)
    pair = stacked.groupBy(key).agg(
        F.max(F.when(F.col("_old"), whole)).alias("o"), F.max(F.when(~F.col("_old"), whole)).alias("n"),
        F.greatest(F.count_if("_old"), F.count_if(~F.col("_old"))).alias("copies"),
    )
    unfit = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{table}: {key} is NULL"))).when(
        F.col("copies") > 1, F.raise_error(F.lit(f"{table}: a value of {key} is there twice"))
    )
    pair = pair.withColumn("_unfit", unfit.cast("string")).where("_unfit IS NULL")
    return audit_rows(
        pair, columns, key, table=table, schema=schema, event_time=moment(as_of), user=F.lit(user), include_unchanged=include_unchanged
    )


def audit_rows(
    pair: DataFrame, columns: list[str], key: str, *, table: str, schema: str, event_time: Column, user: Column, include_unchanged: bool
) -> DataFrame:
    """Audit rows of pairs of a row before (struct ``o``) and after (struct ``n``); a missing side is NULL."""
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"o.`{c}`").eqNullSafe(F.col(f"n.`{c}`")), F.lit(c)) for c in columns])
    )
    both = F.col("o").isNotNull() & F.col("n").isNotNull()
    audited = pair.withColumn("changed_cols", F.when(both & (F.size(differing) > 0), differing))
    if not include_unchanged:
        audited = audited.where(~both | F.col("changed_cols").isNotNull())
    keep_nulls = {"ignoreNullFields": "false"}
    return audited.select(
        event_time.alias("event_time"),
        user.alias("db_user"),
        F.when(F.col("o").isNull(), "INSERT").when(F.col("n").isNull(), "DELETE").otherwise("UPDATE").alias("action"),
        F.lit(schema).alias("schema_name"),
        F.lit(table).alias("table_name"),
        F.col(f"`{key}`").cast("string").alias("row_pk"),
        F.when(F.col("o").isNotNull(), F.to_json("o", keep_nulls)).alias("old_row"),
        F.when(F.col("n").isNotNull(), F.to_json("n", keep_nulls)).alias("new_row"),
        "changed_cols",
    )


def audit_activity(audit: DataFrame, *, as_of, window: str = "90 days") -> DataFrame:
    """Audit events per user, object and action in a trailing window."""
    recent = audit.where((F.col("event_time") >= ago(as_of, window)) & (F.col("event_time") <= moment(as_of)))
    return recent.groupBy("db_user", "schema_name", "table_name", "action").agg(
        F.count("*").alias("event_count"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def steward_map(mapping: DataFrame) -> DataFrame:
    """Users and the domains they look after, by user and domain, with when and by whom that was granted."""
    return mapping.select("db_user", "data_domain", "granted_at", "granted_by").orderBy(
        "db_user", "data_domain", "granted_at", "granted_by"
    )
