"""Near-duplicate lines by a deletion-neighbourhood join; the earliest line stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.common import query, read, settled
from tablewarden.llm.quality import let

EDITS = 1  # the edit bound: one character inserted, deleted or replaced
MIN_CHARS = 20  # shorter lines (closings, list marks) go for an equal line only, not for one that differs by an edit
SEGMENT = 24  # characters of a line whose deletions are emitted together


def part(text: Column, start: Column, length: Column) -> Column:
    """Characters from a 0-based start."""
    return F.substring(text, start + 1, length)


def halves(line: Column, size: Column) -> list[Column]:
    """Keys of which two lines within one edit share one.

    Seen from the shorter line's length (the base), one edit leaves the first or the last half equal. A line can be
    the shorter one or one character longer, so it has a key for each half and either base.
    """
    keys = []
    for longer in (0, 1):
        base = size - longer
        half = F.floor(base / 2).cast("int")
        keys.append(F.xxhash64(base, F.lit(0), part(line, F.lit(0), half)))
        keys.append(F.xxhash64(base, F.lit(1), F.right(line, base - half)))
    return keys


def shared(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of which another line has the same key; counted by smallest and largest line, whatever a key's size."""
    groups = rows.groupBy(*by).agg(F.min("line_key").alias("low"), F.max("line_key").alias("high"))
    return rows.join(groups.where("low < high").select(*by), by, "left_semi")


def segments(line: Column, size: Column, base: Column, side: Column) -> Column:
    """For each segment of the half that may differ, a key of all that is outside of it, and what is inside.

    Within one edit, all of two lines agrees but for one segment, up to the shift by one of what follows it.
    """
    half = F.floor(base / 2).cast("int")
    low, high = F.when(side == 0, half).otherwise(0), F.when(side == 0, base).otherwise(half)
    count = F.greatest(F.lit(1), F.ceil((high - low) / F.lit(SEGMENT)).cast("int"))

    def one(i: Column) -> Column:
        start = low + i * SEGMENT
        after = base - F.when(i == count - 1, high).otherwise(start + SEGMENT)
        key = F.xxhash64(base, start, part(line, F.lit(0), start), F.right(line, after))
        return F.struct(key.alias("key"), part(line, start, size - after - start).alias("middle"))

    return F.transform(F.sequence(F.lit(0), count - 1), one)


def variants(middle: Column, key: Column, longer: Column) -> Column:
    """Hashed deletion variants as (variant, role).

    Lines of one length are within one edit exactly if they agree without the character at one place: role 0, all members
    of a group alike. A line and one that is longer by one agree as the whole (role 1) and without one character (role 2).
    """
    places = F.sequence(F.lit(1), F.length(middle))

    def without(i: Column) -> Column:
        return F.concat(F.substring(middle, F.lit(1), i - 1), F.substring(middle, i + 1, F.length(middle)))

    def row(hashed: Column, role: int) -> Column:
        return F.struct(hashed.alias("variant"), F.lit(role).alias("role"))

    replaced = F.transform(places, lambda i: row(F.xxhash64(key, F.lit(0), i, without(i)), 0))
    whole = F.array(row(F.xxhash64(key, F.lit(1), middle), 1))
    deleted = F.array_distinct(F.transform(places, lambda i: row(F.xxhash64(key, F.lit(1), without(i)), 2)))
    none = F.filter(whole, lambda x: F.lit(False))
    some = F.length(middle) > 0
    return F.when(longer, F.when(some, deleted).otherwise(none)).otherwise(
        F.concat(whole, F.when(some, replaced).otherwise(none))
    )


def places(id_type: T.DataType) -> Column:
    """The order of lines: by document, NULL ids last, then by line number, then by the text's hash.

    With whole numbers as ids it is one number, so that minima are hash aggregates: the id, 31 bits of line number and
    31 bits of hash, or beyond all ids the line number and 64 bits of hash. Other ids are compared as a struct.
    """
    if not isinstance(id_type, T.IntegralType):
        return F.struct(F.col("doc.id").isNull().alias("late"), "doc.id", "at", "doc.hash")

    def number(x: Column) -> Column:
        return x.cast("decimal(38,0)")

    def power(bits: int) -> Column:
        return number(F.lit(str(1 << bits)))

    low = F.col("at").cast("bigint") * (1 << 31) + F.col("doc.hash").bitwiseAND((1 << 31) - 1)
    known = number(number(F.col("doc.id")) * power(62) + number(low))
    late = number(power(125) + number(F.col("at")) * power(64) + number(F.col("doc.hash")) + power(63))
    return F.coalesce(known, late)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, at, line, digest, place) for every line that is not blank; docs has doc (a struct) and text."""
    rows = docs.select("doc", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(" \t\x0b\x0c\r"))).where("line != ''")
    place = places(docs.schema["doc"].dataType["id"].dataType)
    return rows.select("doc", "at", "line", F.unhex(F.sha2("line", 256)).alias("digest"), place.alias("place"))


def distinct_lines(lines: DataFrame, min_chars: int) -> DataFrame:
    """(digest, place, n, line_key, size, keys of the halves) of each distinct line; place is the earliest.

    Lines of fewer than ``min_chars`` characters have no keys, so nothing but an equal line meets them.
    """
    size = F.length("line")
    keys = [F.first(F.when(size >= min_chars, k)).alias(f"half_{i}") for i, k in enumerate(halves(F.col("line"), size))]
    found = lines.groupBy("digest").agg(F.min("place").alias("place"), F.count("*").alias("n"), F.first(size).alias("size"), *keys)
    return settled(found.withColumn("line_key", F.xxhash64("digest")), "lines")


def near_lines(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(digest) of distinct lines that have an earlier line within one edit.

    Every line would emit as many variants as it has characters, so two lossless sieves go first: a key for each half
    (one of them is equal in such a pair), then a key for all but one segment. What still has a partner emits the
    deletion variants of that segment. Equal variants meet in counts and minima only, never in pairs: each line
    is verified against the earliest one it shares a variant with.
    """
    four = F.array(*[
        F.struct(F.lit(i // 2).alias("longer"), F.lit(i % 2).alias("side"), F.col(f"half_{i}").alias("key")) for i in range(4)
    ])
    keyed = distinct.where("half_0 IS NOT NULL").select("line_key", F.explode(four).alias("k")).select("line_key", "k.*")
    halved = settled(shared(keyed, ["key"]).select("line_key", "longer", "side"), "halves")
    wanted = distinct.join(halved.select("line_key").distinct(), "line_key", "left_semi")
    wanted = settled(wanted.select("digest", "line_key", "place", "size"), "wanted-lines")
    texts = lines.select("digest", "place", "line").join(wanted.select("digest", "place"), ["digest", "place"], "left_semi")
    texts = settled(texts.groupBy("digest").agg(F.first("line").alias("line")).join(wanted, "digest"), "half-lines")
    longer = F.col("longer") == 1
    parts = segments(F.col("line"), F.col("size"), F.col("size") - F.col("longer"), F.col("side"))
    rows = texts.join(halved, "line_key").select("line_key", "place", longer.alias("is_longer"), F.explode(parts).alias("s"))
    rows = settled(shared(rows.select("line_key", "place", "is_longer", "s.*"), ["key"]), "segments")
    found = F.explode(variants(F.col("middle"), F.col("key"), F.col("is_longer"))).alias("v")
    rows = rows.select("line_key", "place", found).select("line_key", "place", "v.*")
    first = {r: F.min(F.when(F.col("role") == r, F.struct("place", "line_key"))).alias(f"first_{r}") for r in (0, 1, 2)}
    groups = rows.groupBy("variant").agg(*first.values(), F.min("line_key").alias("low"), F.max("line_key").alias("high"))
    met = rows.join(groups.where("low < high"), "variant")
    partner = F.when(F.col("role") == 0, F.col("first_0")).when(F.col("role") == 1, F.col("first_2")).otherwise(F.col("first_1"))
    met = met.withColumn("partner", partner).where(F.col("partner.place") < F.col("place"))
    pairs = met.select("line_key", F.col("partner.line_key").alias("early")).distinct()
    early = texts.select(F.col("line_key").alias("early"), F.col("line").alias("early_line"))
    checked = pairs.join(texts.select("line_key", "line", "digest"), "line_key").join(early, "early")
    return settled(checked.where(F.levenshtein("line", "early_line", EDITS) >= 0).select("digest").distinct(), "near-lines")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, carry: list[str] | None = None,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """One row per document: row (columns in ``carry``, or all), n_lines, n_removed, text (what is left).

    Lines are parted by line feeds and compared without white space at their ends; blank lines stay. A line of any
    length goes if an equal line stands earlier: in a document with a smaller id or further up in the same one. A line of
    ``min_chars`` characters or more also goes if another one of that length within EDITS edits (characters) stands earlier.
    Lines are judged on the input, not on what is left. Rows with a NULL id come after all others; rows with one id are
    judged by line number and content, so that repeated rows keep the same lines (rows of one whole-number id that
    agree in 31 bits of their texts' hashes count as repeated); a NULL text has no lines and stays NULL.
    """
    if min_chars < 1:
        raise ValueError("min_chars must be at least 1")
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct("*")
    text = F.col(f"`{text_col}`").cast("string")
    own = docs.select(
        carried.alias("row"), F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("hash")).alias("doc"), text.alias("text")
    )
    lines = lines_of(own.select("doc", "text"))
    distinct = distinct_lines(lines, min_chars)
    near = near_lines(lines, distinct).withColumn("near", F.lit(True))
    verdict = distinct.select("digest", "n", F.col("place").alias("first")).join(near, "digest", "left")
    verdict = verdict.where("n > 1 OR near").select("digest", "first", "near")
    gone = lines.select("doc", "at", "digest", "place").join(verdict, "digest")
    gone = gone.where(F.col("near") | (F.col("place") != F.col("first"))).groupBy("doc").agg(F.collect_set("at").alias("gone"))
    gone = settled(gone.select(F.col("doc.id").alias("gone_id"), F.col("doc.hash").alias("gone_hash"), "gone"), "gone-lines")
    match = F.col("doc.id").eqNullSafe(F.col("gone_id")) & (F.col("doc.hash") == F.col("gone_hash"))
    split = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    left = let(split, lambda x: F.array_join(F.transform(kept, lambda i: F.get(x, i)), "\n"))
    return own.join(gone, match, "left").select(
        "row",
        F.coalesce(F.size(split), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
    )


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS ln FROM d),
e AS (SELECT *, trim(raw, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM l),
f AS (SELECT line, min(doc_id * 1000000 + ln) AS earliest, length(line) AS size FROM e WHERE line <> '' GROUP BY line),
w AS (SELECT * FROM f WHERE size >= {MIN_CHARS}),
n AS (SELECT DISTINCT a.line FROM w a JOIN w b ON b.size = a.size AND b.earliest < a.earliest AND levenshtein(a.line, b.line) <= {EDITS}
    UNION SELECT DISTINCT a.line FROM w a JOIN w b ON b.size = a.size + 1 AND b.earliest < a.earliest AND levenshtein(a.line, b.line) <= {EDITS}
    UNION SELECT DISTINCT a.line FROM w a JOIN w b ON b.size = a.size - 1 AND b.earliest < a.earliest AND levenshtein(a.line, b.line) <= {EDITS}),
g AS (SELECT r, ln, raw, (f.line IS NOT NULL AND (f.earliest < doc_id * 1000000 + ln OR n.line IS NOT NULL)) AS gone
    FROM e LEFT JOIN f USING (line) LEFT JOIN n USING (line))
SELECT doc_id, n_lines, n_removed, left_text AS text FROM d JOIN (SELECT r, count(*) AS n_lines,
    count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(raw, chr(10) ORDER BY ln) FILTER (WHERE NOT gone), '') AS left_text
    FROM g GROUP BY r) USING (r)
"""


@query("op6_line_dedup", SQL)
def op6(spark, folder):
    found = dedup_lines(read(spark, folder, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", "n_lines", "n_removed", "text")
