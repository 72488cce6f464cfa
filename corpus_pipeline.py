"""The training-data pipeline: rules, line dedup, near-duplicate documents, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm.common import read, settled
from tablewarden.llm.decontaminate import contamination
from tablewarden.llm.lines import dedup_lines
from tablewarden.llm.packing import pack, vocabulary
from tablewarden.llm.quality import judge
from tablewarden.llm.simhash import near_duplicates

ORACLE_SQL = None  # token ids and fingerprints are beyond SQL; tests compare with a brute-force version


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return judge(docs).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier; documents that lose every line with a word go."""
    found = dedup_lines(docs)
    found = found.where((F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    changed = F.col("n_removed") > 0
    row = F.col("row").withField("text", F.when(changed, F.col("text")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(changed, size).otherwise(F.col("row.n_chars")))
    return found.select(row.alias("row")).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, by content among equal ids.

    Documents with a NULL id come last, and of equal rows one stays.
    """
    own = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.monotonically_increasing_id().alias("copy"))
    own = settled(own, "near-duplicate-input")
    found = near_duplicates(own.withColumn("hash", F.xxhash64("text")), carry=["hash", "copy"])
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row.hash"), F.col("row.copy").alias("copy"))
    first = found.groupBy("root").agg(F.min(order).alias("first")).select("first.copy")
    return own.join(first, "copy", "left_semi").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return contamination(docs, read(spark, sf_dir, "benchmark")).where("NOT contaminated").select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    # the heap of the stages before stays beside the workers, so they get half of the usual memory
    found = pack(docs, vocabulary(), carry=["doc_id"], cache=32 << 20, slice_bytes=1 << 20)
    return found.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
