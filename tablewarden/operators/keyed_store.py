"""A table kept in parts by the hash of its key: an upsert reads and rewrites only the parts that incoming keys fall in.

A rewritten part is a new folder; a version's list of folders is written last. Readers see the version before or the
version after, and a job that died leaves folders that no list names. Untouched parts keep their files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators.attach import unused
from tablewarden.operators.publish import merge_by_key, scd2_merge
from tablewarden.sources.writers import stored

PARTS = 256
LIST = "part int, written bigint, version bigint"


class KeyedStore:
    """A table in a folder. ``key``, ``schema`` and ``parts`` stay the same for its lifetime; so does the listing per part.

    The driver sees one row per part (part, version that wrote it), never rows of the table.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: Sequence[str], *, parts: int = PARTS):
        self.spark, self.folder, self.schema, self.key, self.parts = spark, folder.rstrip("/"), schema, list(key), parts
        self.part, self.written = unused(schema.names, "_part", "_written")

    def _part_of(self) -> Column:
        key = [F.col(f"`{c}`").cast(self.schema[c].dataType) for c in self.key]  # a number of another width hashes differently
        return F.pmod(F.xxhash64(*key), F.lit(self.parts)).cast("int")

    def _lists(self) -> DataFrame:
        """All lists; a first one without parts makes the folder readable."""
        self.spark.createDataFrame([], "part int, written bigint").write.mode("ignore").parquet(f"{self.folder}/lists/version=-1")
        return self.spark.read.schema(LIST).parquet(f"{self.folder}/lists")

    def listed(self, before: int | None = None) -> dict[int, int]:
        """Which version wrote each part, as of the newest version (or the newest one before another)."""
        lists = self._lists()
        if before is not None:
            lists = lists.where(F.col("version") < before)
        newest = lists.agg(F.max("version")).first()[0]
        return {r.part: r.written for r in lists.where(F.col("version") == newest).collect()} if newest is not None else {}

    def _read(self, listed: dict[int, int]) -> DataFrame:
        if not listed:
            return self.spark.createDataFrame([], self.schema)
        kept = T.StructType([*self.schema.fields, T.StructField(self.written, T.LongType()), T.StructField(self.part, T.IntegerType())])
        by_version: dict[int, list[int]] = {}
        for part, version in listed.items():
            by_version.setdefault(version, []).append(part)
        wanted = F.lit(False)
        for version, own in by_version.items():
            wanted = wanted | ((F.col(self.written) == version) & F.col(self.part).isin(own))
        rows = self.spark.read.schema(kept).parquet(f"{self.folder}/rows")
        return rows.where(wanted).select(*[f"`{c}`" for c in self.schema.names])

    def read(self, *, before: int | None = None) -> DataFrame:
        """The table, or as it was before a version; folders that no list names are not read."""
        return self._read(self.listed(before))

    def rewrite(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], *, version: int) -> list[int]:
        """Replace the parts that keys of ``incoming`` fall in by ``merge(rows of these parts, incoming)``; the parts.

        ``merge`` must not move a row to another key. Versions are whole numbers from 0 that go up; one that is written
        again starts from the version before it and replaces itself, as long as no later one is there.
        """
        later = self._lists().agg(F.max("version")).first()[0]
        if version < 0 or (later is not None and later > version):
            raise ValueError(f"version {version} must not be before 0 or before the newest, {later}")
        before = self.listed(version)
        incoming = stored(incoming, "incoming")
        touched = sorted(r[0] for r in incoming.select(self._part_of().alias("p")).distinct().collect())  # one per part at most
        if touched:
            base = self._read({p: before[p] for p in touched if p in before})
            rows = merge(base, incoming).select(*[F.col(f"`{c}`").cast(self.schema[c].dataType).alias(c) for c in self.schema.names])
            dealt = rows.withColumn(self.part, self._part_of()).repartition(self.part)
            dealt.write.mode("overwrite").partitionBy(self.part).parquet(f"{self.folder}/rows/{self.written}={version}")
        now = {**before, **dict.fromkeys(touched, version)}
        listed = self.spark.createDataFrame(sorted(now.items()), "part int, written bigint").coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.folder}/lists/version={version}")
        return touched

    def create(self, rows: DataFrame, *, version: int = 0) -> None:
        """The first version."""
        self.rewrite(rows, lambda base, new: new, version=version)

    def upsert(self, updates: DataFrame, *, version: int, on_conflict: str = "update", columns: list[str] | None = None) -> list[int]:
        """``merge_by_key`` on the parts that the updates' keys fall in."""
        return self.rewrite(
            updates, lambda base, new: merge_by_key(base, new, self.key, on_conflict=on_conflict, columns=columns), version=version
        )

    def merge_versions(self, incoming: DataFrame, *, version: int, surrogate: str, attributes: list[str], as_of) -> list[int]:
        """``scd2_merge`` on the parts that incoming keys fall in; of the rest only the surrogate column is read."""
        if len(self.key) != 1:
            raise ValueError("a type-2 merge has one business key")
        last = self.read(before=version).agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
        return self.rewrite(
            incoming,
            lambda base, new: scd2_merge(base, new, key=self.key[0], surrogate=surrogate, attributes=attributes, as_of=as_of, last=last),
            version=version,
        )
