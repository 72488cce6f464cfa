"""Benchmark decontamination by a prefix-filtered join of word shingles."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Rolling, char_class, flat, query, read, settled, slices, word_hashes, word_spans

LETTERS = char_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
OUTSIDE = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # what lies between words
BLOCK_CHARS = 4 << 20  # benchmark text that a task holds at once; a larger benchmark takes several passes


@dataclass
class Block:
    """The windows of one part of the benchmark, each named by an item, and their shingles."""

    items: np.ndarray  # item of each window, as a position in ids
    ids: list[str]
    sizes: np.ndarray  # words of each window
    whole: np.ndarray  # hash of all words of a window
    texts: list[bytes]  # the words, joined by spaces
    shingles: list[np.ndarray]  # hashes of the shingles of each window


def windows_of(rows: list[tuple[str, bytes]], width: int, shingle: int) -> Block:
    """Distinct (item, window) pairs; an item with fewer words than ``width`` is one window."""
    items, ids, sizes, whole, texts, shingles = [], [], [], [], [], []
    for item, text in rows:
        data, offsets = flat([text.lower()])
        starts, ends, _ = word_spans(data, offsets, LETTERS)
        if not len(starts):
            continue
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        hashes = Rolling(word_hashes(data, starts, ends))
        size = min(width, len(words))
        part = min(shingle, size)
        ids.append(item)
        seen = set()
        for i in range(len(words) - size + 1):
            text = b" ".join(words[i : i + size])
            if text in seen:
                continue
            seen.add(text)
            at = np.arange(i, i + size - part + 1)
            items.append(len(ids) - 1)
            sizes.append(size)
            whole.append(hashes.ranges(np.array([i]), np.array([i + size]))[0])
            texts.append(text)
            shingles.append(hashes.ranges(at, at + part))
    return Block(np.array(items, np.int64), ids, np.array(sizes, np.int64), np.array(whole, np.uint64), texts, shingles)


def words_of(texts: list[bytes | None]):
    data, offsets = flat([x and x.lower() for x in texts])
    starts, ends, before = word_spans(data, offsets, LETTERS)
    return data, starts, ends, before, Rolling(word_hashes(data, starts, ends))


def shingle_sizes(block: Block, shingle: int) -> list[int]:
    return sorted({min(shingle, int(n)) for n in np.unique(block.sizes)})


def rarity(docs: DataFrame, tokens, shingle_widths: list[int]) -> dict[int, int]:
    """How often each shingle of the block starts in the documents; as many rows as the block has shingles."""

    def count(batches):
        known = tokens.value
        for batch in batches:
            column, total = batch.column(0), np.zeros(len(known), np.int64)
            for low, high in slices(column):
                _, starts, _, _, rolling = words_of(column.slice(low, high - low).to_pylist())
                for width in shingle_widths:
                    hashes = rolling.windows(width)
                    at = np.searchsorted(known, hashes)
                    at[at == len(known)] = 0
                    total += np.bincount(at[known[at] == hashes], minlength=len(known))
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["token", "n"])

    counted = docs.select("text").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token: r.n for r in counted.collect()}


def prefixes(block: Block, known: np.ndarray, counts: dict[int, int]) -> dict[str, np.ndarray]:
    """The necessary prefix token of each window, its rarest shingle, and where in the window it stands.

    A window counts only if all its shingles are there in order, so a prefix of one shingle is enough. Windows whose
    rarest shingle occurs in no document are left out.
    """
    frequency = np.zeros(len(known), np.int64)
    for token, n in counts.items():
        frequency[token] = n
    tokens, places, windows = [], [], []
    for w, hashes in enumerate(block.shingles):
        at = np.searchsorted(known, hashes)
        place = int(np.argmin(frequency[at]))
        if frequency[at[place]]:
            tokens.append(hashes[place])
            places.append(place)
            windows.append(w)
    order = np.argsort(np.array(tokens, np.uint64), kind="stable")
    return {
        "token": np.array(tokens, np.uint64)[order],
        "place": np.array(places, np.int64)[order],
        "window": np.array(windows, np.int64)[order],
    }


def occurrences(texts: list[bytes | None], block: Block, prefix: dict[str, np.ndarray], widths: list[int]):
    """Verified windows in some documents: (starts in words, window numbers), and the documents' word counts."""
    data, starts, ends, before, rolling = words_of(texts)
    raw = data.tobytes()
    found_at, found_window = [], []
    for width in widths:
        hashes = rolling.windows(width)
        low = np.searchsorted(prefix["token"], hashes, "left")
        many = np.searchsorted(prefix["token"], hashes, "right") - low
        at = np.flatnonzero(many)
        many, low = many[at], low[at]
        entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = np.repeat(at, many) - prefix["place"][entry]
        window = prefix["window"][entry]
        size = block.sizes[window]
        stop = start + size
        doc = np.searchsorted(before, np.repeat(at, many), "right") - 1
        fits = (np.minimum(widths[-1], size) == width) & (start >= before[doc]) & (stop <= before[doc + 1])
        start, stop, window = start[fits], stop[fits], window[fits]
        same = rolling.ranges(start, stop) == block.whole[window]
        found_at.append(start[same])
        found_window.append(window[same])
    at, window = np.concatenate(found_at), np.concatenate(found_window)
    exact = np.ones(len(at), bool)
    for k, (i, w) in enumerate(zip(at.tolist(), window.tolist(), strict=True)):
        own = b" ".join([raw[a:b] for a, b in zip(starts[i : i + block.sizes[w]].tolist(), ends[i : i + block.sizes[w]].tolist(), strict=True)])
        exact[k] = own == block.texts[w]
    return at[exact], window[exact], before


def matcher(shared, widths: list[int]):
    def match(batches):
        block, prefix = shared.value
        for batch in batches:
            key, column = batch.column(0), batch.column(1)
            for low, high in slices(column):
                at, window, before = occurrences(column.slice(low, high - low).to_pylist(), block, prefix, widths)
                order = np.argsort(at, kind="stable")
                at, window = at[order], window[order]
                edges = np.searchsorted(at, before)
                hits, items = [], []
                for d in range(high - low):
                    own = slice(edges[d], edges[d + 1])
                    runs, end = [], -1
                    for a, b in zip((at[own] - before[d]).tolist(), (at[own] + block.sizes[window[own]] - before[d]).tolist(), strict=True):
                        if a > end:
                            runs.append([a, b])
                        end = max(end, b)
                        runs[-1][1] = end
                    hits.append([x for run in runs for x in run])
                    items.append([block.ids[i] for i in np.unique(block.items[window[own]]).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [key.slice(low, high - low), pa.array(np.diff(before)), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                    ["row", "n_words", "hits", "items"],
                )

    return match


def digest(parts: list[tuple[list[int], list[str]]]) -> tuple[int, int, str]:
    """Words hit, items, and the digest of the items of one document, from its parts of the benchmark."""
    runs = sorted((h[i], h[i + 1]) for h, _ in parts for i in range(0, len(h), 2))
    n_hit = end = 0
    for a, b in runs:
        n_hit += max(0, b - max(a, end))
        end = max(end, b)
    items = sorted({x for _, found in parts for x in found})
    return n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest()


def pieces(items: DataFrame, width: int, size: int) -> DataFrame:
    """Items (item, text) of which those of more than ``size`` bytes come in pieces of about a quarter of that.

    A piece has at least ``width`` words and shares all but one of them with the next, so every window is in one piece.
    """
    words = F.filter(F.split(F.col("text").cast("string"), OUTSIDE), lambda w: w != "")
    long = items.where(F.octet_length("text") > size).select("item", F.octet_length("text").alias("bytes"), words.alias("words"))
    step = F.greatest(F.lit(1), F.floor(F.size("words") * (size / 4) / F.col("bytes"))).cast("int")
    last = F.greatest(F.lit(0), F.size("words") - width)
    starts = long.select("item", "words", step.alias("step"), F.explode(F.sequence(F.lit(0), last, step)).alias("start"))
    cut = F.array_join(F.slice("words", F.col("start") + 1, F.col("step") + (width - 1)), " ").cast("binary")
    return items.where(F.octet_length("text") <= size).unionByName(starts.select("item", cut.alias("text")).distinct())


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    *,
    width: int = 13,
    shingle: int = 3,
    percent: int = 5,
    block_chars: int = BLOCK_CHARS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, row, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, lower-cased where ASCII. A window
    is ``width`` consecutive words of an item, or all words of a shorter one. Words inside an occurrence of a window
    are hit; a document is contaminated if at least ``percent`` of 100 words are. NULL texts have no words and are
    clean; an item without words, or with a NULL id, is left out; repeated rows and items with equal windows are
    judged alike; an empty benchmark or no documents give clean or no rows. ``row`` holds the whole row, or the columns in ``carry``.

    Every window is found by its rarest shingle, counted over all documents; occurrences must lie inside one document
    and are compared word by word. The benchmark is read in blocks of about ``block_chars`` characters, so what a task
    holds of it is bounded; each block is one more pass over the documents. Equal items are read once, and an item longer
    than a block is cut into pieces that overlap, which have the same windows.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").cast("binary").alias("text")
    ).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    items = settled(pieces(items, width, block_chars), "benchmark-items")
    chars = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-chars // block_chars))
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct("*")
    text = F.col(f"`{text_col}`").cast("binary")
    if n_blocks > 1:  # the parts of one row meet by its columns and its text
        carried = F.struct(carried.alias("row"), F.sha2(F.coalesce(text, F.lit(b"")), 256).alias("digest"))
    own = docs.select(carried.alias("row"), text.alias("text"))
    kinds = own.schema["row"].dataType.simpleString()
    parts = []
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k).collect()
        block = windows_of([(r.item, bytes(r.text)) for r in sorted(rows)], width, shingle)
        known = np.unique(np.concatenate([*block.shingles, np.empty(0, np.uint64)]))
        widths = shingle_sizes(block, shingle) or [shingle]
        counts = rarity(own, spark.sparkContext.broadcast(known), widths) if len(known) else {}
        shared = spark.sparkContext.broadcast((block, prefixes(block, known, counts)))
        schema = f"row {kinds}, n_words bigint, hits array<bigint>, items array<string>"
        parts.append(own.mapInArrow(matcher(shared, widths), schema))

    @F.pandas_udf("n_hit bigint, n_items bigint, items_sha256 string")
    def summary(found):
        import pandas as pd

        return pd.DataFrame([digest([(p["hits"], p["items"]) for p in x]) for x in found], columns=["n_hit", "n_items", "items_sha256"])

    if n_blocks == 1:
        gathered = parts[0].withColumn("found", F.array(F.struct("hits", "items")))
    else:
        gathered = parts[0]
        for other in parts[1:]:
            gathered = gathered.union(other)
        gathered = merged(gathered, n_blocks)
    done = gathered.select("row", "n_words", summary("found").alias("s")).select("row", "n_words", "s.*")
    hit = (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)
    return done.select(F.col(f"row.`{id_col}`").alias("doc_id"), "*").withColumn("contaminated", hit)


def merged(parts: DataFrame, n_blocks: int) -> DataFrame:
    """The blocks' findings for each row together; a row that is there n times comes n times."""
    key = F.sha2(F.to_json(F.struct("row"), {"ignoreNullFields": "false"}), 256)
    grouped = parts.groupBy(key.alias("key")).agg(
        F.any_value("row.row").alias("row"), F.max("n_words").alias("n_words"), F.count("*").alias("n"),
        F.collect_set(F.when(F.size("hits") > 0, F.struct("hits", "items"))).alias("found"),
    )
    copies = F.explode(F.sequence(F.lit(1), (F.col("n") / n_blocks).cast("int")))
    return grouped.select("row", "n_words", "found", copies.alias("copy")).drop("copy")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_sql(text: str) -> str:
    split = f"string_split_regex(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"list_filter({split}, lambda x: x <> '')"


SQL = f"""
WITH b AS (SELECT item_id::VARCHAR AS item, {words_sql("text")} AS w FROM benchmark),
s AS (SELECT item, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0 AND item IS NOT NULL),
q AS (SELECT DISTINCT item, size, array_to_string(w[i + 1 : i + size], ' ') AS t FROM (SELECT *, unnest(range(len(w) - size + 1)) AS i FROM s)),
d AS (SELECT row_number() OVER () AS r, doc_id, {words_sql("text")} AS w FROM documents),
p AS (SELECT r, i, size, array_to_string(w[i + 1 : i + size], ' ') AS t
    FROM (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS i FROM d, (SELECT DISTINCT size FROM q) WHERE len(w) >= size)),
m AS (SELECT r, i, size, item FROM p JOIN q USING (size, t)),
h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS k FROM m) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""


@query("op5_benchmark_decontamination", SQL)
def op5(spark, folder):
    found = contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"), carry=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
