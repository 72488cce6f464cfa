"""SimHash near-duplicates through an inverted index of fingerprint bytes."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import query, read, settled
from tablewarden.llm.components import components

BYTES = 8  # positional bytes of a fingerprint
CROWD = 4096  # a longer posting list is linked through the fingerprints around its members instead
CHUNK = 1 << 16  # hashes whose bits are spread out at once


def simhash(text: bytes | None, width: int) -> int:
    """Signed 64-bit SimHash of the ``width``-word shingles of ASCII-lowered text; zero without a word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(width, len(words))
    hashed = xxhash.xxh64_intdigest
    ranges = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    values = np.fromiter((hashed(joined[i:j], 42) for i, j in ranges), np.uint64, len(words) - width + 1)
    set_bits = np.zeros(64, np.int64)
    for low in range(0, len(values), CHUNK):
        part = values[low : low + CHUNK].astype("<u8").view(np.uint8).reshape(-1, BYTES)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_bits > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, shingle) for x in texts], dtype="int64")

    return of(text.cast("binary"))


def forest(prints: np.ndarray, distance: int, shared: int) -> list[tuple[int, int]]:
    """Links that connect what lies within the distance in one posting list, fewer than it has members.

    The positional bytes that a pair shares are tallied; pairs with too few are left out, the rest are verified.
    """
    found, left = [], prints
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            apart = (left ^ one).view(np.uint64)
            tally = (apart.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
            near = (tally >= shared) & (np.bitwise_count(apart) <= distance)
            reached = left[near]
            found += [(int(one), int(x)) for x in reached]
            front += list(reached)
            left = left[~near]
    return found


def linker(distance: int, shared: int, crowd: int):
    """Turn sorted postings (entry, bytes, print) into links; members of crowded lists come as (print, NULL)."""

    def rows(pairs):
        a = pa.array([x for x, _ in pairs], pa.int64())
        return pa.RecordBatch.from_arrays([a, pa.array([y for _, y in pairs], pa.int64())], ["a", "b"])

    def link(batches):
        held, held_key, crowded = np.empty(0, np.int64), None, False
        for batch in batches:
            out, runs = [], []
            entry, keys, prints = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(keys):
                continue
            starts = np.flatnonzero(np.r_[True, (entry[1:] != entry[:-1]) | (keys[1:] != keys[:-1])])
            stops = np.r_[starts[1:], len(keys)]
            last = len(starts) - 1
            for k in sorted({0, last, *np.flatnonzero(stops - starts > 1).tolist()}):
                key, own = (int(entry[starts[k]]), int(keys[starts[k]])), prints[starts[k] : stops[k]]
                if key == held_key:
                    own = np.concatenate([held, own])
                else:
                    runs.append(held)
                    crowded = False
                held, held_key = own, key
                if crowded or len(held) > crowd:  # passed on at once, so that memory stays bounded
                    out += [(int(x), None) for x in held]
                    held, crowded = held[:0], True
            for own in runs:
                out += forest(np.ascontiguousarray(own), distance, shared)
            if out:
                yield rows(out)
        if len(held) > 1:
            yield rows(forest(np.ascontiguousarray(held), distance, shared))

    return link


def links(prints: DataFrame, distance: int, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column print) that connect all within ``distance`` bits.

    A difference of d bits leaves at least ``8 - d`` of the 8 positional bytes equal. A list of one byte would hold
    a 256th of all fingerprints, so the index has a list for every choice of that many positions and their bytes:
    any pair with the guaranteed number of matches meets in one. A list longer than ``crowd`` is not compared
    pairwise: its members are joined through every value within half the distance of them, rounded up for the one and
    down for the other, which two fingerprints share exactly if they are within the distance; that stays linear in the list.
    """
    if not 0 <= distance < BYTES:
        raise ValueError("the distance must leave at least one byte equal")
    shared = BYTES - distance
    masks = [sum(0xFF << (8 * p) for p in places) for places in combinations(range(BYTES), shared)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    entries = F.array(*[
        F.struct(F.lit(i).cast("int").alias("entry"), F.col("print").bitwiseAND(F.lit(m)).alias("bytes"))
        for i, m in enumerate(signed)
    ])
    postings = prints.select(F.explode(entries).alias("e"), "print").select("e.entry", "e.bytes", "print")
    postings = postings.repartition("entry", "bytes").sortWithinPartitions("entry", "bytes")
    found = postings.mapInArrow(linker(distance, shared, crowd), "a bigint, b bigint")
    found = settled(found, "simhash-links")
    plain = found.where("b IS NOT NULL")
    around = found.where("b IS NULL").select(F.col("a").alias("print")).distinct()
    if around.isEmpty():
        return plain
    flips, inner = [0], 1
    for k in range(1, (distance + 1) // 2 + 1):
        flips += [sum(1 << b for b in bits) for bits in combinations(range(64), k)]
        inner = len(flips) if k <= distance // 2 else inner
    flips = F.posexplode(F.lit([x - (1 << 64) if x >> 63 else x for x in flips])).alias("at", "flip")
    ball = around.select("print", flips)
    ball = ball.select("print", (F.col("at") < inner).alias("inner"), F.col("print").bitwiseXOR(F.col("flip")).alias("near"))
    centre = ball.where("inner").groupBy("near").agg(F.min("print").alias("low"))
    joined = ball.join(centre, "near").where("low != print").select(F.col("print").alias("a"), F.col("low").alias("b"))
    return plain.union(joined)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 4,
    distance: int = 4,
    carry: list[str] | None = None,
) -> DataFrame:
    """(row, doc_id, print, root, component_id) for each row of ``docs``; row has the columns in ``carry``.

    Rows with fingerprints at most ``distance`` bits apart are linked; component_id is the smallest id that can be
    reached, root the smallest fingerprint. Rows without a word, and NULL texts, have fingerprint zero and are linked like any other. Rows with a
    NULL id take part; a component of such rows alone has a NULL component_id. Repeated rows stay. Equal fingerprints
    are one node, so copies never meet in pairs.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.col(f"`{id_col}`"))
    text = F.col(f"`{text_col}`")
    marked = docs.select(carried.alias("row"), F.col(f"`{id_col}`").alias("doc_id"), fingerprint(text, shingle).alias("print"))
    marked = settled(marked, "simhash-prints")
    prints = settled(marked.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found = components(links(prints.select("print"), distance))
    classes = prints.join(found, prints["print"] == found["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(smallest, "root").select("print", "root", "component_id")
    return marked.join(classes, "print").select("row", "doc_id", "print", "root", "component_id")


def hexadecimal(print_col: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_col), 16, "0"))


@query("op4_simhash_near_dedup")
def op4(spark, folder):
    found = near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", hexadecimal(F.col("print")).alias("fingerprint"), "component_id")
