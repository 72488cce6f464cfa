"""An inverted index over JSON payloads: (field, hashed value) to quarantine ids, in buckets that are folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators.quarantine import search_payload
from tablewarden.sources.writers import _escaped

BUCKETS = 64
SCHEMA = "field string, hashed bigint, quarantine_id string, batch string, bucket int"


def _hashed(field: Column, value: Column) -> Column:
    return F.xxhash64(field, value)


def _plain(field: str) -> bool:
    """Fields that a path names as they stand; others are searched without the index."""
    return field.replace("_", "").isalnum() and field.isascii()


def postings(bad: DataFrame, *, buckets: int = BUCKETS) -> DataFrame:
    """(field, hashed, quarantine_id, bucket): one row per row and top-level field of its payload that has a value.

    Values are read as ``search_payload`` reads them. A payload that is NULL, empty or no JSON object has no postings.
    """
    fields = bad.select("quarantine_id", "payload", F.explode(F.array_distinct(F.json_object_keys("payload"))).alias("field"))
    value = F.expr("get_json_object(payload, concat('$.', field))")
    hashed = fields.where("field RLIKE '^[A-Za-z0-9_]+$'").withColumn("value", value).where("value IS NOT NULL")
    hashed = hashed.select("field", _hashed(F.col("field"), F.col("value")).alias("hashed"), "quarantine_id")
    return hashed.withColumn("bucket", F.pmod(F.col("hashed"), F.lit(buckets)).cast("int"))


def add_batch(bad: DataFrame, folder: str, batch: str, *, buckets: int = BUCKETS) -> None:
    """Index the rows of one batch; the batch added again replaces itself, also by no rows.

    Rows are sorted by hash inside a bucket, so that a search skips row groups. A value that very many rows share fills its
    bucket; it is dealt over the tasks by id, a file each.
    """
    found = postings(bad, buckets=buckets)
    dealt = F.pmod(F.xxhash64("quarantine_id"), F.lit(8))
    rows = found.withColumn("_part", dealt).repartition("bucket", "_part").drop("_part").sortWithinPartitions("bucket", "hashed")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/batch={_escaped(batch)}")


def lookup(spark: SparkSession, folder: str, field: str, value: str, *, buckets: int = BUCKETS) -> DataFrame:
    """Ids of rows that may have the value in the field; reads the folders of one bucket only."""
    wanted = spark.range(1).select(_hashed(F.lit(field), F.lit(value)).alias("h")).first()["h"]
    index = spark.read.schema(SCHEMA).parquet(folder)
    hit = (F.col("bucket") == wanted % buckets) & (F.col("hashed") == wanted) & (F.col("field") == field)
    return index.where(hit).select("quarantine_id").distinct()


def search(bad: DataFrame, folder: str, field: str, value: str, *, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``search_payload``: the index names the ids, the payload itself decides.

    All batches of ``bad`` have to be indexed. A field that is no plain name (a path, a name with signs) is searched in the
    payloads directly, as is NULL, which nothing equals.
    """
    if value is None or not _plain(field):
        return search_payload(bad, field, value)
    ids = lookup(bad.sparkSession, folder, field, value, buckets=buckets)
    return search_payload(bad.join(ids, "quarantine_id", "left_semi"), field, value)
