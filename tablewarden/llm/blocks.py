"""Documents in blocks of ascending ids, and questions that blocks ask about each other's hashes.

A block sends the hashes of its text to buckets by value, each bucket answers every block with one bit a hash. So hashes
travel once, as packed arrays, and a text that a third of all documents share is one hash in each block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import U64, mixed, settled

LEAST_BYTES = 4 << 20  # text of a block when there is little of it; more blocks than MANY make larger ones
MANY = 512

PACKED = "block int, bucket int, packed binary"
FIELDS = ["block", "bucket", "packed"]


def range_of(bounds: np.ndarray):
    """The range of each id among ascending bounds; a bound belongs to the range below. NULL ids are the last range."""

    @F.pandas_udf("int")
    def of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        at = np.searchsorted(bounds, ids.astype("Int64").fillna(0).to_numpy().astype(np.int64), "left")
        return pd.Series(np.where(known, at, len(bounds) + 1).astype(np.int32))

    return of


def id_ranges(sizes: DataFrame, limit: int, fine: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of ranges of ids that have at most ``limit`` bytes or one id, and the bytes of each, the last of NULL ids.

    Ranges start as percentiles of the rows; those with too many bytes are cut again, also on both sides of each cut,
    so that an id with many rows comes to stand alone.
    """
    shares = [i / fine for i in range(1, fine)]
    found = sizes.agg(F.percentile_approx("id", shares, max(10_000, 10 * fine))).first()[0] if shares else []
    bounds = np.array(sorted(set(found or [])), np.int64)
    while True:
        ranged = sizes.withColumn("range", range_of(bounds)("id"))
        stats = ranged.groupBy("range").agg(F.sum("size").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).collect()
        heavy = [r.range for r in stats if r.n > limit and r.low is not None and r.low < r.high]
        if not heavy:
            held = np.zeros(len(bounds) + 2, np.int64)
            for r in stats:
                held[r.range] = r.n
            return bounds, held
        cuts = ranged.where(F.col("range").isin(heavy)).groupBy("range")
        cuts = cuts.agg(F.percentile_approx("id", [i / 32 for i in range(1, 32)], 1000).alias("at")).collect()
        more = {x for r in cuts for x in r["at"]}
        bounds = np.array(sorted({*bounds.tolist(), *more, *(x - 1 for x in more if x > -(2**63))}), np.int64)


def in_blocks(
    docs: DataFrame, id_col: str, text_col: str, carry: list[str] | None, most_bytes: int
) -> tuple[DataFrame, np.ndarray]:
    """(block, id, text, row) and the rank of each block. Blocks hold ascending ranges of ids, NULL ids are the last ones.

    A block has about ``most_bytes`` of text at most, or one longer text; a task holds one block. Rows of one id, or of none, that have
    more are dealt to several blocks of one rank, which hold nothing else: ids compare as the ranks of their blocks.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct("*")
    own = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text"), carried.alias("row"),
    )
    sizes = settled(own.select("id", F.octet_length("text").cast("bigint").alias("size")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    limit = min(most_bytes, max(LEAST_BYTES, total // MANY))
    cuts, held = id_ranges(sizes, limit, 8 * max(1, -(-total // limit)))
    bounds, parts, filled = [], [], 0  # neighbouring ranges together, as far as the limit goes
    for k, n in enumerate(held[:-1].tolist()):
        if k and filled + n > limit:
            bounds.append(int(cuts[k - 1]))
            parts.append(max(1, -(-filled // limit)))
            filled = 0
        filled += n
    parts += [max(1, -(-filled // limit)), max(1, -(-int(held[-1]) // limit))]
    bounds, parts = np.array(bounds, np.int64), np.array(parts)
    first = np.cumsum(parts) - parts
    own = own.withColumn("rank", range_of(bounds)("id"))
    count, start = (F.array(*[F.lit(int(x)) for x in v]) for v in (parts, first))
    alone = [int(x) for x in np.flatnonzero(parts > 1)]
    if not alone:
        own = own.withColumn("block", F.get(start, F.col("rank")))
    else:  # which of its blocks a row goes to is written down, so that every pass sees the same
        many = own.where(F.col("rank").isin(alone)).withColumn("copy", F.monotonically_increasing_id())
        dealt = F.get(start, F.col("rank")) + F.pmod(F.xxhash64("copy"), F.get(count, F.col("rank"))).cast("int")
        many = settled(many.withColumn("block", dealt).drop("copy"), "many-rows-of-an-id")
        own = own.where(~F.col("rank").isin(alone)).withColumn("block", F.get(start, F.col("rank"))).unionByName(many)
    return own.select("block", "id", "text", "row"), np.repeat(np.arange(len(parts)), parts)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of about equal shares of all hashes."""
    return ((mixed(hashes) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def packed_rows(block: int, buckets: np.ndarray, values: np.ndarray) -> pa.Table:
    """One row per bucket with its values, which are sorted by bucket."""
    own, starts, counts = np.unique(buckets, return_index=True, return_counts=True)
    stops = starts + counts
    parts = [values[a:b].tobytes() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
    return pa.Table.from_arrays(
        [pa.array(np.full(len(own), block, np.int32)), pa.array(own.astype(np.int32)), pa.array(parts, pa.binary())], FIELDS
    )


def met(other: bool, ranks: np.ndarray, kind=U64):
    """Answers of a bucket: for each hash a block sent, whether a block of a smaller rank (or any other) has it too.

    Hashes are numbers of ``kind``; of parts of hashes, an answer may be yes for unlike ones."""

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [np.frombuffer(x, kind) for x in table.column("packed").to_pylist()]
        sizes = np.array([len(x) for x in parts])
        values = np.concatenate(parts)
        rank = np.repeat(ranks[table.column("block").to_numpy()], sizes)
        order = np.argsort(values, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = values[order[1:]] != values[order[:-1]]
        starts, group = np.flatnonzero(new), np.cumsum(new) - 1
        own = rank[order]  # ascending among equal hashes
        if other:
            own = own[np.append(starts[1:], len(order)) - 1][group]
        hit = np.zeros(len(values), bool)
        hit[order] = rank[order[starts]][group] < own
        bits = [np.packbits(x).tobytes() for x in np.split(hit, np.cumsum(sizes)[:-1])]
        return pa.Table.from_arrays([table.column("block"), table.column("bucket"), pa.array(bits, pa.binary())], FIELDS)

    return answer


def answered(answers: pa.Table, buckets: np.ndarray) -> np.ndarray:
    """The bits a block got back, in the order of what it sent (sorted by bucket)."""
    sent, counts = np.unique(buckets, return_counts=True)
    got = dict(zip(answers.column("bucket").to_pylist(), answers.column("packed").to_pylist(), strict=True))
    bits = [np.unpackbits(np.frombuffer(got[b], np.uint8), count=n) for b, n in zip(sent.tolist(), counts.tolist(), strict=True)]
    return np.concatenate([*bits, np.empty(0, np.uint8)]).astype(bool)


def block_texts(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, list[bytes]]:
    """A block's rows by ascending id, with ids (0 in the block of NULLs), the rank of each row's id, and the texts."""
    table = table.sort_by("id")
    ids = table.column("id").to_pandas().fillna(0).to_numpy().astype(np.int64)
    return table, ids, np.unique(ids, return_inverse=True)[1], table.column("text").to_pylist()
