"""Rules over growing tables: a new load is read once, what is known of earlier loads is kept.

Kept are counts per load for row rules, each key with the load that brought it first for unique keys and for parents,
and the references that are still missing. Results of all loads together are those of a full evaluation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.hashing import LONG_TEXT, row_text
from tablewarden.operators.evaluate import _described, _rows, _union, graded, row_rule_counts
from tablewarden.operators.rules import Rule
from tablewarden.sources.writers import _escaped

KEYS = "slot string, key string, load_id string"
MISSING = "rule_id string, reference string, copies bigint, load_id string"
TOTALS = "rule_id string, total_rows bigint, violation_count bigint, load_id string"


class Loads:
    """The kept state of one set of tables in a folder, a partition per load."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def write(self, df: DataFrame, part: str, load_id: str) -> None:
        df.drop("load_id").write.mode("overwrite").parquet(f"{self.folder}/{part}/load_id={_escaped(load_id)}")

    def read(self, part: str, schema: str) -> DataFrame:
        """Rows of all loads; none before the first load."""
        self.spark.createDataFrame([], schema).drop("load_id").write.mode("ignore").parquet(f"{self.folder}/{part}/load_id=_none")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}")


def _named(columns: Iterable[str]):
    """A key as one text; a long one as its start and digest."""
    text = row_text([F.col(f"`{c}`") for c in columns])
    digest = F.concat(F.substring(text, 1, LONG_TEXT), F.lit(" sha256:"), F.sha2(text, 256))
    return F.when(F.length(text) > LONG_TEXT, digest).otherwise(text)


def _known(columns: Iterable[str]):
    found = F.lit(True)
    for column in columns:
        found = found & F.col(f"`{column}`").isNotNull()
    return found


def _keys_of(rule: Rule) -> tuple[str, str, tuple[str, ...]]:
    """(slot, table, columns) of the keys a rule needs: its own, or those of its parent."""
    table, columns = (rule.table, rule.key) if rule.key else (rule.parent[0], (rule.parent[1],))
    return f"{table}({','.join(columns)})", table, tuple(columns)


def add_load(spark: SparkSession, folder: str, load: Mapping[str, DataFrame], rules: Iterable[Rule], load_id: str) -> None:
    """Read the rows of one load and keep what later results need.

    ``load`` has the new rows of each table, any of them may be missing. A load that is added again with the same rows
    replaces itself. A parent's rows only grow: a reference counts as missing until some load brings its key. Selector
    rules look at whole tables and cannot be kept. The keys of a load are joined with the kept keys, not with rows.
    """
    state, rules = Loads(spark, folder), [r for r in rules if r.active]
    for rule in rules:
        if rule.selector is not None or rule.allowed is not None:
            raise ValueError(f"{rule.rule_id}: a selector or a table of allowed values is evaluated over whole tables")
    counts = [row_rule_counts(load[t], own) for t, own in _by_table(rules, load)]
    slots = {_keys_of(r)[0]: _keys_of(r)[1:] for r in rules if r.key or r.parent}
    kept = state.read("keys", KEYS).where(F.col("load_id") != load_id)
    per_slot, fresh = {}, []
    for slot, (table, columns) in slots.items():
        if table in load:
            held = load[table].where(_known(columns)).groupBy(_named(columns).alias("key")).agg(F.count("*").alias("copies"))
            earlier = kept.where(F.col("slot") == slot).select("key")
            per_slot[slot] = held, earlier
            fresh.append(held.join(earlier, "key", "left_anti").select(F.lit(slot).alias("slot"), "key"))
    if fresh:
        state.write(_union(fresh), "keys", load_id)
    added = state.read("keys", KEYS)
    for rule in rules:
        if rule.key and rule.table in load:
            slot = _keys_of(rule)[0]
            held, _ = per_slot[slot]
            first = added.where((F.col("slot") == slot) & (F.col("load_id") == load_id)).agg(F.count("*").alias("first"))
            rows = load[rule.table].agg(F.count("*").alias("total"))
            keyed = held.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("keyed"))  # all but one copy of each first key are bad
            counted = rows.join(F.broadcast(keyed)).join(F.broadcast(first)).withColumn("bad", F.col("keyed") - F.col("first"))
            counts.append(counted.select(_rows([_described(rule, "total", "bad")])))
    referring = [r for r in rules if r.parent and r.table in load]
    missing = []
    for rule in referring:
        own = load[rule.table]
        counts.append(own.agg(F.count("*").alias("total")).select(_rows([_described(rule, "total", "0")])))
        named = F.when(_known([rule.column]), _named([rule.column]))
        references = own.groupBy(named.alias("reference")).agg(F.count("*").alias("copies"))
        known = added.where(F.col("slot") == _keys_of(rule)[0]).select(F.col("key").alias("reference"))
        missing.append(references.join(known, "reference", "left_anti").select(F.lit(rule.rule_id).alias("rule_id"), "reference", "copies"))
    if missing:
        state.write(_union(missing), "missing", load_id)
    if counts:
        state.write(_union(counts).select("rule_id", "total_rows", "violation_count"), "totals", load_id)


def _by_table(rules: list[Rule], load: Mapping[str, DataFrame]):
    for table in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == table and r.violation is not None]
        if own and table in load:
            yield table, own


def results(spark: SparkSession, folder: str, rules: Iterable[Rule], *, run_id: str, as_of) -> DataFrame:
    """Results of all active rules over all loads, from the kept state alone.

    A rule whose table has had no rows yet has a total of 0.
    """
    state, rules = Loads(spark, folder), [r for r in rules if r.active]
    totals = state.read("totals", TOTALS).select("rule_id", "total_rows", "violation_count")
    missing, keys = state.read("missing", MISSING), state.read("keys", KEYS)
    slot = F.lit(None).cast("string")
    for rule in rules:
        if rule.parent:
            slot = F.when(F.col("rule_id") == rule.rule_id, _keys_of(rule)[0]).otherwise(slot)
    open_references = missing.groupBy("rule_id", "reference").agg(F.sum("copies").alias("copies")).withColumn("slot", slot)
    known = keys.select("slot", F.col("key").alias("reference"))
    still = open_references.join(known, ["slot", "reference"], "left_anti").groupBy("rule_id").agg(F.sum("copies").alias("violation_count"))
    found = totals.unionByName(still.select("rule_id", F.lit(0).cast("bigint").alias("total_rows"), "violation_count"))
    summed = found.groupBy(F.col("rule_id").alias("id")).agg(F.sum("total_rows").alias("total"), F.sum("violation_count").alias("bad"))
    described = spark.range(1).select(_rows([_described(r, "0", "0") for r in rules]))
    joined = described.drop("total_rows", "violation_count").join(summed, F.col("rule_id") == F.col("id"), "left")
    summed_as = {"total_rows": "total", "violation_count": "bad"}
    zero = F.lit(0).cast("bigint")
    counted = joined.select(*[F.coalesce(summed_as[c], zero).alias(c) if c in summed_as else F.col(c) for c in described.columns])
    return graded(counted, run_id=run_id, as_of=as_of)


def loads(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and violations of each rule per load; references are judged over all loads and have none here."""
    return Loads(spark, folder).read("totals", TOTALS).where(F.col("load_id") != "_none")
