"""Substring dedup by Rabin-Karp hashes of fixed-length word windows."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.blocks import PACKED, answered, block_texts, bucket_of, in_blocks, met, packed_rows
from tablewarden.llm.common import MIX_1, U64, Rolling, flat, mixed, query, read, word_hashes, word_spans

BLOCK_BYTES = 32 << 20


def window_hashes(texts: list[bytes], width: int):
    """The word count before each text, the starts of all windows that lie in one text, and two hashes of each."""
    data, offsets = flat(texts)
    starts, ends, before = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(before))
    at = np.arange(max(0, len(words) - width + 1))
    at = at[doc[at] == doc[at + width - 1]]
    one = mixed(Rolling(words).windows(width)[at])
    two = Rolling(mixed(words ^ U64(MIX_1))).windows(width)[at]
    return before, doc, at, one, two


def distinct_windows(one: np.ndarray, two: np.ndarray, buckets: int):
    """Distinct windows sorted by bucket: their bucket and hash, and for every window which of them it is.

    The second hash chooses the bucket, so windows that meet agree in both, up to the number of buckets.
    """
    bucket = bucket_of(two, buckets)
    order = np.lexsort((one, bucket))
    new = np.ones(len(order), bool)
    new[1:] = (one[order[1:]] != one[order[:-1]]) | (bucket[order[1:]] != bucket[order[:-1]])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]  # lexsort is stable, so this is the first window in the block
    return bucket[first], one[first], which, first


def sender(width: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        table, _, _, texts = block_texts(table)
        *_, one, two = window_hashes(texts, width)
        bucket, keys, _, _ = distinct_windows(one, two, buckets)
        return packed_rows(block, bucket, keys)

    return send


def finisher(width: int, buckets: int):
    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, _, rank, texts = block_texts(table)
        before, doc, at, one, two = window_hashes(texts, width)
        bucket, _, which, first = distinct_windows(one, two, buckets)
        earlier = answered(answers, bucket)
        owner = rank[doc[at[first]]]
        gone = at[earlier[which] | (owner[which] < rank[doc[at]])]
        cover = np.zeros(before[-1] + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + width, -1)
        covered = np.cumsum(cover[:-1]) > 0
        kept, spans = [], []
        for d, text in enumerate(texts):
            own = covered[before[d] : before[d + 1]]
            spans.append(np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))))
            kept.append(b" ".join(compress(text.split(), (~own).tolist())))
        return pa.Table.from_arrays(
            [table.column("row"), pa.array(np.diff(before)), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
            ["row", "n_words", "spans", "text"],
        )

    return finish


def remove_repeated_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    width: int = 13,
    carry: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(row, n_words, spans, text) of each document: the maximal removal intervals, as word positions start, stop,
    start, stop and so on, and the words that stay, joined by one blank.

    Words are parted by ASCII white space. A word goes if a window of ``width`` words over it also starts in a document
    with a smaller id; windows are judged on the input. Rows with a NULL id come after all others and don't count as
    smaller than each other, nor do rows with one id; NULL and short texts lose nothing; no documents give no rows.

    Every window's Rabin-Karp hash is counted in the bucket of its value: 64 bits and the choice among the buckets, by an
    independent hash, decide, so unlike windows meet once in about 2**64 pairs of one bucket.
    """
    own, ranks = in_blocks(docs, id_col, text_col, carry, block_bytes)
    blocks = len(ranks)
    kind = own.schema["row"].dataType.simpleString()
    answers = (
        own.groupBy("block").applyInArrow(sender(width, blocks), PACKED)
        .groupBy("bucket").applyInArrow(met(False, ranks), PACKED)
    )
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        finisher(width, blocks), f"row {kind}, n_words bigint, spans array<bigint>, text binary"
    )


def span_words(spans):
    """The number of words inside intervals."""
    pairs = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda a, x: a + x)


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
p AS (SELECT r, doc_id, i, array_to_string(w[i + 1 : i + 13], ' ') AS t FROM (SELECT *, unnest(range(len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
o AS (SELECT t, min(doc_id) AS first FROM p GROUP BY t HAVING count(*) > 1),
g AS (SELECT DISTINCT r, i + k AS i FROM p JOIN o USING (t), range(13) x(k) WHERE p.doc_id > o.first),
x AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
k AS (SELECT r, count(g.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE g.i IS NULL), '') AS kept
    FROM x LEFT JOIN g USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@query("op9_substring_dedup", SQL)
def op9(spark, folder):
    found = remove_repeated_windows(read(spark, folder, "documents"), carry=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", span_words(F.col("spans")).alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")
    )
