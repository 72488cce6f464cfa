"""Bad rows: capture, split, stewardship and backlog reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.hashing import row_text
from tablewarden.functions.timing import ago, moment, seconds_between
from tablewarden.operators import allowed
from tablewarden.operators.attach import FEW, unused
from tablewarden.operators.dedup import CHUNK, surplus_rows
from tablewarden.operators.evaluate import any_violation
from tablewarden.operators.rules import Rule, Tables
from tablewarden.schemas import OPEN_STATUSES, RESOLVED_STATUSES, SEVERITIES, SLA_CLOCKS
from tablewarden.sources.writers import stored

CROWD = 10_000  # rows of one key that one task ranks
SLOTS = 1 << 18  # hashes of keys by which rows are counted first
# types whose values are equal exactly when their texts are
PLAIN_KINDS = ("tinyint", "smallint", "int", "bigint", "string", "boolean", "date", "timestamp_ntz")

# fixed values: steward action -> new status
ACTIONS = {
    "assign": "IN_REVIEW",
    "fix": "FIXED",
    "reprocess": "REPROCESSED",
    "ignore": "IGNORED",
    "reject": "REJECTED",
}


# --- capture ---------------------------------------------------------------------
def _record(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.name).alias("rule_name"),
        F.lit(rule.dimension).alias("dimension"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.schema).alias("schema_name"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.domain).alias("data_domain"),
    )


def _shaped(df: DataFrame, bad: str, key: list[str], payload: list[str], run_id: str, at: Column, *more: Column) -> DataFrame:
    """Quarantine records of rows that carry the broken rule as a struct, with ``more`` columns."""
    row_key = F.col(key[0]).cast("string") if len(key) == 1 else row_text([F.col(k) for k in key])
    return df.select(
        F.concat_ws("|", F.lit(run_id), F.col(f"{bad}.rule_id"), row_key).alias("quarantine_id"),
        F.lit(run_id).alias("run_id"),
        f"{bad}.rule_id",
        f"{bad}.schema_name",
        f"{bad}.table_name",
        row_key.alias("business_key"),
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("payload"),
        F.concat(f"{bad}.rule_id", F.lit(" — "), f"{bad}.rule_name").alias("failure_reason"),
        f"{bad}.severity",
        F.lit("OPEN").alias("status"),
        F.lit(None).cast("string").alias("assigned_to"),
        at.alias("quarantined_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolution_note"),
        f"{bad}.data_domain",
        *more,
    )


def _named(records: DataFrame) -> DataFrame:
    """The ids of records: the first of its rule and key has a plain one."""
    nth = F.when(F.col("_nth") > 1, F.concat(F.lit("row|"), F.col("_nth")))
    records = records.withColumn("quarantine_id", F.concat_ws("|", "quarantine_id", nth)).drop("_nth")
    return records.withColumn("quarantine_id", F.md5("quarantine_id"))


def _told_apart(df: DataFrame, key: list[str]) -> list[str] | None:
    """The key columns, if their values are equal exactly when their texts are; rows can then be dealt by the columns."""
    kinds = [df.schema[k].dataType.simpleString() for k in key]
    return list(key) if all(k in PLAIN_KINDS or k.startswith("decimal") for k in kinds) else None


def crowded_keys(df: DataFrame, key: list[str]) -> DataFrame | None:
    """Texts of the keys with more than CROWD rows, as ``_key``, or None.

    Rows are counted by a hash of their key first, which shuffles SLOTS rows a task at most, and by the key itself only
    where a hash has that many.
    """
    keys = df.select(row_text([F.col(k) for k in key]).alias("_key"))
    keys = keys.withColumn("_slot", F.pmod(F.xxhash64("_key"), F.lit(SLOTS)).cast("int"))
    slots = keys.groupBy("_slot").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("_slot")
    n_slots = slots.limit(FEW + 1).count()
    if not n_slots:
        return None
    if n_slots <= FEW:
        keys = keys.join(F.broadcast(slots), "_slot", "left_semi")
    crowded = keys.groupBy("_key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("_key")
    n_crowded = crowded.limit(FEW + 1).count()
    if not n_crowded:
        return None
    return F.broadcast(crowded) if n_crowded <= FEW else crowded


def _filed(
    df: DataFrame, rules: list[Rule], key: list[str], payload: list[str], run_id: str, at: Column,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Records of the rows of ``df`` under each rule they break, with an id of its own for each.

    A rule that is no row predicate is broken by all rows, or, if the columns it wants unique are the key, by all rows of
    a key but the first. Rows are dealt once by their key as they are, and become records where they arrive. Those of
    ``crowded`` keys are ranked apart.
    """
    (text,) = unused(df.columns, "_key")
    texted = df.withColumn(text, row_text([F.col(k) for k in key]))
    hot = None
    if crowded is not None:
        crowded = crowded.withColumnRenamed("_key", text)
        hot = texted.join(crowded, text, "left_semi").drop(text)
        texted = texted.join(crowded, text, "left_anti")
    by = _told_apart(df, key)
    rows = (texted.drop(text) if by else texted).repartition(*(by or [text]))
    by = by or [text]
    number, digest, nth, bad, copy = unused(rows.columns, "_rule", "_digest", "_nth", "_bad", "_copy")
    unique = [r for r in rules if r.key and set(r.key) == set(key)]
    if unique:
        rest = [F.col(f"`{c}`") for c in df.columns if c not in key]
        rows = rows.withColumn(copy, F.row_number().over(Window.partitionBy(*by).orderBy(*(rest or [F.lit(0)]))))
    broken = []
    for i, rule in enumerate(rules):
        hit = F.lit(True) if rule.violation is None else rule.bad
        if rule in unique:
            hit = F.col(copy) > 1
            for k in key:
                hit = hit & F.col(k).isNotNull()
        broken.append(F.when(hit, F.lit(i)))
    rows = rows.withColumn(digest, _digest(payload))
    records = rows.select("*", F.explode(F.array_compact(F.array(*broken))).alias(number))
    ids = F.get(F.array(*[F.lit(r.rule_id) for r in rules]), F.col(number))
    order = F.row_number().over(Window.partitionBy(*by, ids).orderBy(digest))
    records = records.withColumn(nth, order.cast("bigint"))
    records = records.withColumn(bad, F.get(F.array(*[_record(r) for r in rules]), F.col(number)))
    found = _shaped(records, bad, key, payload, run_id, at, F.col(nth).alias("_nth"))
    if hot is not None:
        for part in _broken_rows(hot, rules, unique, bad):
            more = [row_text([F.col(k) for k in key]).alias("_key"), _digest(payload).alias("_digest")]
            found = found.unionByName(_ranked(_shaped(part, bad, key, payload, run_id, at, *more)).drop("_key", "_digest"))
    return _named(found)


def _digest(payload: list[str]) -> Column:
    """What rows under one key are told apart by."""
    return F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256)


def _broken_rows(df: DataFrame, rules: list[Rule], unique: list[Rule], bad: str) -> list[DataFrame]:
    """The rows with a struct for each rule they break; surplus rows of a key are found apart."""
    plain = [r for r in rules if r not in unique]
    parts = []
    if plain:
        hits = [_record(r) if r.violation is None else F.when(r.bad, _record(r)) for r in plain]
        parts.append(df.select("*", F.explode(F.array_compact(F.array(*hits))).alias(bad)))
    for rule in unique:
        parts.append(rule_rows({rule.table: df}, rule).withColumn(bad, _record(rule)))
    return parts


def _ranked(records: DataFrame) -> DataFrame:
    """Records of crowded keys with their rank by digest among those of their rule and key.

    They are ranked by ranges of their digests, and equal records travel as one with a count, so that neither a hot key
    nor many copies of one row are a single task's work.
    """
    group = ["rule_id", "_key"]
    columns = records.columns
    copies = records.groupBy(*columns).agg(F.count("*").alias("_copies"))
    copies = copies.withColumn("_range", F.substring("_digest", 1, 3))  # 4,096 ranges
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = copies.groupBy(*group, "_range").agg(F.sum("_copies").alias("_size"))
    starts = sizes.select(*group, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*group, "_range").orderBy("_digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.join(starts, [*group, "_range"]).withColumn(
        "_start", F.col("_start") + F.coalesce(F.sum("_copies").over(within), F.lit(0))
    )
    # copies are written out in chunks, dealt anew because one record may have very many
    chunks = placed.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / CHUNK))))
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(tasks, "_digest", "_chunk")
    first = F.col("_chunk") * CHUNK + 1
    last = F.least(F.col("_copies"), first + CHUNK - 1)
    written = dealt.withColumn("_copy", F.explode(F.sequence(first, last)))
    return written.withColumn("_nth", F.col("_start") + F.col("_copy")).select(*columns, "_nth")


def quarantine(
    df: DataFrame,
    rules: Iterable[Rule],
    *,
    key: list[str],
    run_id: str,
    as_of,
    payload: list[str] | None = None,
    unique_key: bool = False,
) -> DataFrame:
    """One record per row and broken row rule, from one scan.

    The id depends on run, rule, key and, for rows that share a key, the rank by content within it, so every record has
    an id of its own and running again writes the same ones; the bad rows are shuffled for that. Callers that know that
    no two rows share a key say so by ``unique_key=True``, and nothing is shuffled.
    """
    rules, payload = list(rules), payload or df.columns
    if unique_key:
        found = F.array_compact(F.array(*[F.when(rule.bad, _record(rule)) for rule in rules]))
        records = _shaped(df.select("*", F.explode(found).alias("bad")), "bad", key, payload, run_id, moment(as_of))
        return records.withColumn("quarantine_id", F.md5("quarantine_id"))
    rows = df.where(any_violation(rules))
    return _filed(rows, rules, key, payload, run_id, moment(as_of), crowded_keys(rows, key))


def quarantine_table(
    df: DataFrame, rules: Iterable[Rule], *, key: list[str], run_id: str, as_of, payload: list[str] | None = None
) -> DataFrame:
    """Like ``quarantine``, for row rules and rules that want the key unique: rows are dealt by the key once for both."""
    rules = list(rules)
    rows = df if any(r.key for r in rules) else df.where(any_violation(rules))
    return _filed(rows, rules, key, payload or df.columns, run_id, moment(as_of), crowded_keys(rows, key))


def shares_key(df: DataFrame, rule: Rule, key: list[str]) -> bool:
    """Whether the bad rows of a rule are found where rows are dealt by ``key``: a row rule, or one that wants it unique."""
    return rule.violation is not None or bool(rule.key and set(rule.key) == set(key) and _told_apart(df, key))


def rule_rows(tables: Tables, rule: Rule) -> DataFrame:
    """The bad rows of any kind of rule."""
    df = tables[rule.table]
    if rule.violation is not None:
        return df.where(rule.bad)
    if rule.key:
        order = [c for c in df.columns if c not in rule.key]
        return surplus_rows(df, list(rule.key), order)
    if rule.parent:
        # missing references are found among the distinct ones; usually few, so Spark broadcasts them
        table, column = rule.parent
        known = tables[table].select(F.col(column).alias("_reference")).distinct()
        used = df.select(F.col(rule.column).alias("_reference")).distinct()
        missing = used.join(known, "_reference", "left_anti")
        return df.join(missing, F.col(rule.column).eqNullSafe(F.col("_reference")), "left_semi")
    if rule.allowed:
        table, column = rule.allowed
        return allowed.stray_rows(df, rule.column, allowed.allowed_values(tables[table], column))
    return rule.selector(tables)


def quarantine_selected(
    tables: Tables, rule: Rule, *, key: list[str], run_id: str, as_of, payload: list[str] | None = None
) -> DataFrame:
    """Records of one rule that is not a row predicate (unique key, parent reference, allowed values, selector)."""
    rows = rule_rows(tables, rule)
    payload = payload or tables[rule.table].columns
    if rule.selector:  # may return a row more often than the table has it, and is run once; other rules take rows of the table
        rows = stored(rows, "selected")
    crowded = crowded_keys(rows if rule.selector else tables[rule.table], key)
    # the rows are the bad ones already, whatever their rule
    return _filed(rows, [replace(rule, key=(), selector=rule_rows, parent=None, allowed=None, violation=None)],
                  key, payload, run_id, moment(as_of), crowded)


def split(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean, bad); every row is in exactly one of them."""
    bad = any_violation(list(rules))
    return df.where(~bad), df.where(bad)


# --- stewardship --------------------------------------------------------------------
def apply_actions(bad: DataFrame, actions: DataFrame, *, user: str = "system") -> tuple[DataFrame, DataFrame]:
    """Apply a batch of steward actions; returns the new rows and the log of real status changes.

    actions: quarantine_id, action, assignee, note, acted_at. The latest action decides status and
    note; the assignee is the last one named; a row is resolved when its last closing action was.
    """
    new_status = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])[F.col("action")]
    named = actions.withColumn("new_status", new_status).where(F.col("new_status").isNotNull())
    closing = F.col("new_status").isin(RESOLVED_STATUSES)
    order = F.struct("acted_at", "action", "note", "assignee")
    last = named.groupBy("quarantine_id").agg(
        F.max_by(F.struct("new_status", "note", "acted_at"), order).alias("last"),
        F.max_by("assignee", F.when(F.col("assignee").isNotNull(), order)).alias("assignee"),
        F.max(F.when(closing, F.col("acted_at"))).alias("closed_at"),
    )
    joined = bad.join(last, "quarantine_id", "left")
    acted = F.col("last").isNotNull()
    after = {
        "status": F.coalesce("last.new_status", "status"),
        "assigned_to": F.coalesce("assignee", "assigned_to"),
        "resolution_note": F.when(acted, F.col("last.note")).otherwise(F.col("resolution_note")),
        "resolved_at": F.coalesce("closed_at", "resolved_at"),
    }
    updated = joined.select(*[after[c].alias(c) if c in after else F.col(c) for c in bad.columns])
    log = joined.where(acted & (F.col("last.new_status") != F.col("status"))).select(
        "quarantine_id",
        F.lit("STATUS_CHANGE").alias("action"),
        F.coalesce("assignee", "assigned_to", F.lit(user)).alias("actor"),
        F.col("last.note").alias("note"),
        F.col("status").alias("old_status"),
        F.col("last.new_status").alias("new_status"),
        F.col("last.acted_at").alias("acted_at"),
    )
    return updated, log


def bulk_resolve(
    bad: DataFrame, *, rule_id: str, as_of, older_than: str = "7 days", status: str = "IGNORED", note: str = ""
) -> DataFrame:
    """Close old open rows of one rule with one note."""
    hit = (
        (F.col("rule_id") == rule_id)
        & (F.col("status") == "OPEN")
        & (F.col("quarantined_at") < ago(as_of, older_than))
    )
    return bad.withColumns(
        {
            "status": F.when(hit, F.lit(status)).otherwise(F.col("status")),
            "resolution_note": F.when(hit, F.lit(f"BULK: {note}")).otherwise(F.col("resolution_note")),
            "resolved_at": F.when(hit, moment(as_of)).otherwise(F.col("resolved_at")),
        }
    )


def assign_stewards(bad: DataFrame, stewards: DataFrame) -> DataFrame:
    """Name the steward of the row's domain where nobody is assigned; the first by name if several."""
    by_domain = stewards.groupBy("data_domain").agg(F.min("db_user").alias("steward"))
    joined = bad.join(by_domain, "data_domain", "left")
    return joined.withColumn("assigned_to", F.coalesce("assigned_to", "steward")).select(*bad.columns)


# --- backlog ------------------------------------------------------------------------
def open_rows(bad: DataFrame) -> DataFrame:
    return bad.where(F.col("status").isin(OPEN_STATUSES))


def open_by_table(bad: DataFrame) -> DataFrame:
    return open_rows(bad).groupBy("schema_name", "table_name", "severity").agg(
        F.count("*").alias("open_count"),
        F.min("quarantined_at").alias("oldest_open"),
        F.max("quarantined_at").alias("newest_open"),
    )


def sla_breaches(bad: DataFrame, *, as_of, clocks: Mapping[str, str] = SLA_CLOCKS) -> DataFrame:
    """Open rows older than the clock of their severity (exactly as old is no breach)."""
    late = F.lit(False)
    for severity, clock in clocks.items():
        late = late | ((F.col("severity") == severity) & (F.col("quarantined_at") < ago(as_of, clock)))
    return (
        open_rows(bad)
        .where(late)
        .withColumn("open_seconds", seconds_between(F.col("quarantined_at"), moment(as_of)))
    )


def backlog(bad: DataFrame, *, as_of) -> DataFrame:
    """Open rows by age: under a day, one to seven days with both ends, over seven days."""
    since = F.col("quarantined_at")
    day, week = ago(as_of, "1 day"), ago(as_of, "7 days")
    return open_rows(bad).groupBy(F.col("table_name").alias("source_table"), "severity", "status").agg(
        F.count("*").alias("open_rows"),
        F.count_if(since > day).alias("lt_1d"),
        F.count_if((since <= day) & (since >= week)).alias("d1_7"),
        F.count_if(since < week).alias("gt_7d"),
    )


def listing(
    bad: DataFrame, *, status: str | None = None, severity: str | None = None, limit: int = 50
) -> DataFrame:
    """Newest rows first; the reason is cut to 60 characters."""
    if status is not None:
        bad = bad.where(F.col("status") == status)
    if severity is not None:
        bad = bad.where(F.col("severity") == severity)
    return (
        bad.orderBy(F.desc("quarantined_at"), F.asc("quarantine_id"))
        .limit(limit)
        .select(
            "quarantine_id", "schema_name", "table_name", "rule_id", "severity", "status", "business_key",
            F.left("failure_reason", F.lit(60)).alias("reason"), "quarantined_at",
        )
    )


def severity_rank(severity: Column) -> Column:
    rank = F.lit(len(SEVERITIES))
    for i, name in enumerate(reversed(SEVERITIES), start=1):
        rank = F.when(severity == name, F.lit(i)).otherwise(rank)
    return rank


def triage(bad: DataFrame) -> DataFrame:
    """Open rows, most severe first, newest first within a severity."""
    rank = severity_rank(F.col("severity"))
    return (
        bad.where(F.col("status") == "OPEN")
        .withColumn("severity_rank", rank)
        .orderBy("severity_rank", F.desc("quarantined_at"), "quarantine_id")
    )


def backlog_age(bad: DataFrame, *, as_of) -> DataFrame:
    """Mean age of open rows in hours per domain and severity."""
    age = seconds_between(F.col("quarantined_at"), moment(as_of)) / 3600
    return (
        bad.where(F.col("status") == "OPEN")
        .groupBy("data_domain", "severity")
        .agg(F.count("*").alias("row_count"), F.avg(age).alias("avg_age_hours"))
    )


def failing_rules_since(bad: DataFrame, *, as_of, window: str = "7 days") -> DataFrame:
    return (
        bad.where(F.col("quarantined_at") > ago(as_of, window))
        .groupBy("rule_id", "table_name")
        .agg(F.count("*").alias("bad_rows"))
    )


def status_counts(bad: DataFrame) -> DataFrame:
    return bad.groupBy("status").agg(F.count("*").alias("row_count"))


def search_payload(bad: DataFrame, field: str, value: str) -> DataFrame:
    """Rows whose JSON payload has the value in the field."""
    return bad.where(F.get_json_object("payload", f"$.{field}") == value)
