"""Sources and sinks. Every write names its batch, so a repeated batch replaces itself."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewarden.operators.dedup import top_per_key
from tablewarden.operators.quarantine import quarantine, split
from tablewarden.operators.rules import Rule
from tablewarden.session import new_path


def read_stream(spark: SparkSession, folder: str, name: str, *, stamp: str | None = None) -> DataFrame:
    """A Parquet table of the folder as a stream, whether it is one file or a folder of files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # a pattern, since the file source takes folders and patterns but no single file
    stream = spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")
    return stream.withColumn(stamp, F.col(stamp).cast("timestamp")) if stamp else stream


def _replace_batch(df: DataFrame, path: str, batch: int) -> None:
    (
        df.withColumn("batch_id", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def run_available(stream: DataFrame, path: str, *, mode: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop. Append batches add up; a complete batch replaces the table.

    An update batch adds the rows that it changed as versions named by the batch; ``current`` reads the newest of each.
    Windows that are still open are in the table with what has come so far, so nothing is left to flush at the end.
    """

    def write(df: DataFrame, batch: int) -> None:
        if mode == "complete":
            df.write.mode("overwrite").parquet(path)
        else:
            _replace_batch(df, path, batch)

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return query


def current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The rows of a table of versions: of each key the one of the last batch that changed it."""
    return top_per_key(spark.read.parquet(path), keys, [F.desc("batch_id")]).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: list[str], target: str) -> None:
    """Write the current rows of a table of versions as its first version elsewhere, for streams that run for long."""
    _replace_batch(current(spark, path, keys), target, 0)


def table_of(stream: DataFrame, label: str, *, mode: str = "complete", keys: list[str] | None = None) -> DataFrame:
    """Run a stream over the data at hand and return the table it wrote to the shared folder.

    With ``keys``, the stream runs in update mode: only changed rows are written, and the watermark drops closed windows
    from the state.
    """
    spark = stream.sparkSession
    if keys:
        path = new_path(spark, label)
        _empty_table(spark, stream.schema, path)
        run_available(stream, path, mode="update", checkpoint=new_path(spark, f"{label}-checkpoint"))
        return current(spark, path, keys)
    path = new_path(spark, label)
    _empty_table(spark, stream.schema, path, mode)
    run_available(stream, path, mode=mode, checkpoint=new_path(spark, f"{label}-checkpoint"))
    written = spark.read.parquet(path)
    return written.drop("batch_id") if mode != "complete" else written


def _empty_table(spark: SparkSession, schema, path: str, mode: str = "append") -> None:
    """A table without rows, so that it can be read also when no batch writes to it."""
    folder = path if mode == "complete" else f"{path}/batch_id=-1"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)


def quarantine_stream(
    stream: DataFrame, rules: Iterable[Rule], *, key: list[str], run_id: str, as_of, clean_path: str,
    bad_path: str, checkpoint: str, payload: list[str] | None = None, unique_key: bool = False,
) -> StreamingQuery:
    """Good rows to one table, records of bad rows to another; both are written per batch.

    Rows of several batches can share a key, so their ids also depend on the batch, unless the caller knows that keys are
    unique (``unique_key``).
    """
    rules, spark = list(rules), stream.sparkSession
    none = spark.createDataFrame([], stream.schema)
    _empty_table(spark, stream.schema, clean_path)
    bad_schema = quarantine(none, rules, key=key, run_id=run_id, as_of=as_of, payload=payload).schema
    _empty_table(spark, bad_schema, bad_path)

    def write(df: DataFrame, batch: int) -> None:
        good, _ = split(df, rules)
        _replace_batch(good, clean_path, batch)
        part = run_id if unique_key else f"{run_id}|batch {batch}"
        bad = quarantine(df, rules, key=key, run_id=part, as_of=as_of, payload=payload, unique_key=unique_key)
        _replace_batch(bad.withColumn("run_id", F.lit(run_id)), bad_path, batch)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return query


def run_until_silent(stream: DataFrame, path: str, *, checkpoint: str, seconds: float, every: str = "1 second") -> StreamingQuery:
    """Write the alerts of a heartbeat stream batch by batch until no key is watched any more, or the time is over."""
    _empty_table(stream.sparkSession, stream.schema, path)
    query = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .foreachBatch(lambda df, batch: _replace_batch(df, path, batch))
        .start()
    )
    try:
        end = time.monotonic() + seconds
        while time.monotonic() < end and query.isActive:
            states = [s["numRowsTotal"] for p in query.recentProgress[-1:] for s in p["stateOperators"]]
            started = any(p["numInputRows"] for p in query.recentProgress)
            if started and states and not sum(states):
                break
            time.sleep(0.5)
    finally:
        query.stop()
    return query


def run_split_late(
    stream: DataFrame, path: str, *, stamp: str, late: str, checkpoint: str, window: str | None = None
) -> StreamingQuery:
    """All rows to one table, those behind the watermark under ``late=true``: nothing is dropped without a trace.

    The watermark of a batch is the newest moment of the batches before, less ``late``. With ``window``, a row is late
    when its tumbling window has ended at the watermark, as in a windowed aggregate; else when its own moment lies behind
    it. Rows without a moment are late. A batch is read once: its newest moment is observed while it is written.
    """
    spark, marks = stream.sparkSession, f"{path}-marks"
    _empty_table(spark, T.StructType([T.StructField("newest", T.TimestampType())]), marks)
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/batch_id=-1/late=false")
    moment = F.col(stamp).cast("timestamp")
    ends = F.window(moment, window)["end"] if window else moment + F.expr("INTERVAL 1 MICROSECOND")

    def write(df: DataFrame, batch: int) -> None:
        before = spark.read.parquet(marks).where(F.col("batch_id") < batch).agg((F.max("newest") - F.expr(f"INTERVAL {late}")).alias("mark"))
        mark = before.select(F.date_format("mark", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]  # one moment
        seen = Observation()
        behind = ends <= F.lit(mark).cast("timestamp") if mark is not None else F.lit(False)
        marked = df.withColumn("late", F.coalesce(behind, F.lit(True)) | moment.isNull()).withColumn("batch_id", F.lit(batch))
        observed = marked.observe(seen, F.max(F.unix_micros(moment)).alias("newest"))
        writer = observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id", "late").parquet(path)
        newest = spark.range(1).select(F.timestamp_micros(F.lit(seen.get["newest"]).cast("bigint")).alias("newest"))
        _replace_batch(newest, marks, batch)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows the query dropped behind its watermark."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
