"""Licence scans: TF-IDF cosine of headers and licence files to templates, and inheritance along the directories."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import query, read, settled
from tablewarden.llm.quality import let

# Statements of licences as they stand in headers, and the first words of their texts.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004"],
    "bsd-3-clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "cc-by-4.0": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3", "GNU GENERAL PUBLIC LICENSE Version 3"],
    "mit": ["Released under the MIT License", "The MIT License", "Permission is hereby granted, free of charge, to any person"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
# A line with one of these words belongs to a file's header, wherever it stands.
CUE = r"(?i)(\blicen[cs]ed?\b|\bspdx\b|\bcopyright\b|\bcc by\b|\bpermission is hereby\b|\bredistribution and use\b)"
# Every match of the pattern has one of these; looking for them is much cheaper.
CUE_PARTS = ("licen", "spdx", "copyright", "cc by", "permission is hereby", "redistribution and use")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)(\.[a-z]+)?$"
TERM = "[a-z0-9]+(?:[.][0-9]+)*"
THRESHOLD = 0.6
BROADCAST_TERMS = 100_000
GAP = 12  # lines without a cue word inside one header block
EDGE = 3  # lines next to a block that belong to it, up to an empty one
SPDX = r"(?i)SPDX-License-Identifier:[ \t(]*([a-z0-9][a-z0-9.+-]*)"


def speaks(text: Column) -> Column:
    """Whether a text has a line that speaks of a licence."""
    lower, some = F.lower(text), F.lit(False)
    for part in CUE_PARTS:
        some = some | lower.contains(part)
    return F.coalesce(some & text.rlike(CUE), F.lit(False))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def weights(texts: DataFrame, key: list[str], idf: DataFrame) -> DataFrame:
    """(key, term, weight, norm) of texts with terms (an array): counts by document rarity, sparse."""
    counted = texts.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf"))
    weighted = counted.join(idf, "term").withColumn("weight", (1 + F.log(F.col("tf"))) * F.col("idf"))
    norms = weighted.groupBy(*key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighted.select(*key, "term", "weight"), norms


def header_of(text: Column, cue: str = CUE) -> Column:
    """Lines of a text, anywhere in it, that speak of a licence."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(cue))


def matches(texts: DataFrame, templates: Mapping[str, list[str]], threshold: float) -> DataFrame:
    """(key, licence, similarity) for the templates that a text (key, whole, part) of a key reaches the threshold with.

    The rarity of a term is counted over the templates and all texts that are scanned; similarities count to six decimals.
    """
    spark = texts.sparkSession
    rows = [(name, i, part) for name, parts in sorted(templates.items()) for i, part in enumerate(parts)]
    known = spark.createDataFrame(rows, "licence string, variant int, part string")
    known = known.select("licence", "variant", terms(F.col("part")).alias("terms"))
    own = settled(texts.select("key", "whole", terms(F.col("part")).alias("terms")), "licence-headers")
    every = own.select("terms").unionAll(known.select("terms"))
    total = every.agg(F.count("*").alias("total"))
    seen = every.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = seen.join(F.broadcast(total)).select("term", (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1).alias("idf"))
    idf = settled(idf, "licence-terms")
    text_weights, text_norms = weights(own, ["key", "whole"], idf)
    known_weights, known_norms = weights(known, ["licence", "variant"], idf)
    known_weights = known_weights.withColumnRenamed("weight", "known_weight").withColumnRenamed("term", "known_term")
    if sum(len(part.split()) for _, _, part in rows) <= BROADCAST_TERMS:
        known_weights, known_norms = F.broadcast(known_weights), F.broadcast(known_norms)
    dots = text_weights.join(known_weights, F.col("term") == F.col("known_term")).groupBy("key", "whole", "licence", "variant")
    dots = dots.agg(F.sum(F.col("weight") * F.col("known_weight")).alias("dot"))
    known_norms = known_norms.withColumnRenamed("norm", "known_norm")
    cosine = dots.join(text_norms, ["key", "whole"]).join(known_norms, ["licence", "variant"])
    similarity = F.round(F.col("dot") / (F.col("norm") * F.col("known_norm")), 6)
    return cosine.select("key", "licence", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def nearest(cosine: DataFrame) -> DataFrame:
    """The licence of each key with the largest similarity, the first by name of equal ones."""
    best = F.min(F.struct((-F.col("similarity")).alias("rank"), F.col("licence"))).alias("best")
    return cosine.groupBy("key").agg(best).select("key", "best.licence", (-F.col("best.rank")).alias("similarity"))


@lru_cache(maxsize=1)
def standards() -> dict[str, list[str]]:
    """Whole licence texts and standard headers, by licence; from the files LICENCE.txt and LICENCE.header.txt."""
    found: dict[str, list[str]] = {}
    for file in sorted(Path(__file__).with_name("texts").glob("*.txt")):
        found.setdefault(file.name.removesuffix(".txt").removesuffix(".header"), []).append(file.read_text())
    return found


def blocks_of(text: Column) -> Column:
    """Contiguous header blocks of a text: lines from cue to cue with at most GAP lines between them, and the same with
    up to EDGE lines on either side that no empty line parts from it."""
    lines = F.split(text, "\n")

    def blocks(lines: Column) -> Column:
        at = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(CUE), i)), lambda i: i.isNotNull())
        empty = F.filter(F.transform(lines, lambda x, i: F.when(~x.rlike("\\S"), i)), lambda i: i.isNotNull())
        return let(F.struct(at.alias("at"), empty.alias("empty")), lambda s: cut(lines, s["at"], s["empty"]))

    def cut(lines: Column, at: Column, empty: Column) -> Column:
        first = F.filter(at, lambda x, i: (i == 0) | (x - F.get(at, i - 1) > GAP))
        last = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) - x > GAP))

        def wide(b: Column) -> Column:
            low, high = b["low"], b["high"]
            before = F.array_max(F.filter(empty, lambda x: (x < low) & (x >= low - EDGE)))
            after = F.array_min(F.filter(empty, lambda x: (x > high) & (x <= high + EDGE)))
            start = F.coalesce(before + 1, F.greatest(low - EDGE, F.lit(0)))
            stop = F.coalesce(after - 1, F.least(high + EDGE, F.size(lines) - 1))
            return F.struct(start.alias("low"), stop.alias("high"))

        spans = F.zip_with(first, last, lambda a, b: F.struct(a.alias("low"), b.alias("high")))
        spans = F.array_distinct(F.concat(spans, F.transform(spans, wide)))
        return F.transform(spans, lambda b: F.array_join(F.slice(lines, b["low"] + 1, b["high"] - b["low"] + 1), "\n"))

    return let(lines, blocks)


def standard_matches(texts: DataFrame, known: Mapping[str, list[str]], threshold: float) -> DataFrame:
    """(key, licence, similarity) of the texts (key, part) with the whole texts and headers in ``known``, and of SPDX identifiers.

    The rarity of a term is fixed by ``known``, so that what else is scanned changes nothing. An identifier of a known
    licence counts as equal to it.
    """
    spark = texts.sparkSession
    counts = [(name, i, Counter(re.findall(TERM, part.lower()))) for name, parts in sorted(known.items()) for i, part in enumerate(parts)]
    seen = Counter(term for _, _, c in counts for term in c)
    rare = math.log(1 + len(counts)) + 1  # of a term that no known text has
    idf = {term: math.log((1 + len(counts)) / (1 + n)) + 1 for term, n in seen.items()}
    rows = []
    for name, i, c in counts:
        weight = {term: (1 + math.log(n)) * idf[term] for term, n in c.items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        rows += [(term, idf[term], name, i, w / norm) for term, w in weight.items()]
    table = F.broadcast(spark.createDataFrame(rows, "known_term string, idf double, licence string, variant int, share double"))
    rarity = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    own = texts.select("key", F.xxhash64("part").alias("hash"), F.explode(terms(F.col("part"))).alias("term"))
    own = own.groupBy("key", "hash", "term").agg(F.count("*").alias("tf")).join(rarity, "term", "left")
    own = own.select("key", "hash", "term", ((1 + F.log("tf")) * F.coalesce("idf", F.lit(rare))).alias("weight"))
    own = settled(own, "standard-terms")
    norms = own.groupBy("key", "hash").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = own.join(table, F.col("term") == F.col("known_term")).groupBy("key", "hash", "licence", "variant")
    dots = dots.agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    cosine = dots.join(norms, ["key", "hash"])
    cosine = cosine.select("key", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("similarity"))
    said = texts.select("key", F.explode(F.regexp_extract_all("part", F.lit(SPDX), F.lit(1))).alias("said"))
    said = said.select("key", F.regexp_replace(F.lower("said"), "(-only|-or-later|[+])$", "").alias("licence"), F.lit(1.0).alias("similarity"))
    names = sorted({*known, *TEMPLATES})
    return cosine.where(F.col("similarity") >= threshold).unionAll(said.where(F.col("licence").isin(names)))


def directory(path: Column) -> Column:
    """The directory of a path, empty at the root."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    *,
    templates: Mapping[str, list[str]] = TEMPLATES,
    known: Mapping[str, list[str]] | None = None,
    threshold: float = THRESHOLD,
    carry: list[str] | None = None,
) -> DataFrame:
    """(row, path, licence, origin, licence_path, similarity) of every file; row has the columns in ``carry``, or all.

    A file is compared by all lines that speak of a licence with statements (``templates``), and by each header block with
    whole texts and standard headers (``known``) and SPDX identifiers; a licence file (LICENSE, COPYING, with any ending) also
    as a whole. The best one counts. What reaches the threshold of cosine is the file's own licence (origin ``file`` or ``header``).
    Any other file takes the licence of the nearest directory above it that has a licence file (``inherited``), else none.
    Of several licence files in one directory the first by path counts. Rows of one path are scanned together as
    one file, rows without a path by their header alone. A NULL path has no directory and a NULL text no header; empty
    tables give no rows.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct("*")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    path = F.col(f"`{path_col}`").cast("string")
    own = files.select(carried.alias("row"), path.alias("path"), text.alias("text"))
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    marked = own.select(
        "row", "path", named.alias("is_file"),
        F.when(speaks(F.col("text")), header_of(F.col("text"))).alias("header"),
        F.when(speaks(F.col("text")), blocks_of(F.col("text"))).alias("blocks"), F.when(named, F.col("text")).alias("whole"),
    )
    key = F.struct(F.col("path"), F.when(F.col("path").isNull(), F.xxhash64("header")).otherwise(F.lit(0)).alias("hash"))
    marked = settled(marked.withColumn("key", key), "licence-scan")
    header = F.array_join(F.array_sort(F.flatten(F.collect_set("header"))), "\n").alias("part")
    texts = marked.where("size(header) > 0").groupBy("key", F.lit(False).alias("whole")).agg(header)
    whole = F.array_join(F.array_sort(F.collect_set("whole")), "\n").alias("part")
    texts = texts.union(marked.where("is_file").groupBy("key", F.lit(True).alias("whole")).agg(whole))
    parts = F.concat(F.coalesce("blocks", F.array()), F.when(F.col("is_file"), F.array("whole")).otherwise(F.array()))
    parts = marked.select("key", F.explode(parts).alias("part")).distinct()
    similar = matches(texts, templates, threshold).unionAll(standard_matches(parts, standards() if known is None else known, threshold))
    found = settled(nearest(similar), "licences")
    found = found.select(
        F.col("key.path").alias("known_path"), F.col("key.hash").alias("known_hash"), "licence", "similarity",
        F.coalesce(F.col("key.path").rlike(LICENCE_FILE), F.lit(False)).alias("known_file"),
    )
    holders = found.where("known_file").groupBy(directory(F.col("known_path")).alias("above")).agg(
        F.min(F.struct("known_path", "licence", "similarity")).alias("holder")
    )
    marked = marked.withColumn("folder", F.when(F.col("path").isNotNull(), directory(F.col("path"))))
    folders = marked.where("folder IS NOT NULL").select("folder").distinct()
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    chains = folders.select("folder", F.explode(F.array_distinct(above)).alias("above"))
    closest = F.max(F.struct(F.length("above").alias("depth"), F.col("holder"))).alias("nearest")
    inherited = chains.join(holders, "above").groupBy("folder").agg(closest).select(
        F.col("folder").alias("heir"), F.col("nearest.holder").alias("holder")
    )
    joined = marked.join(found, (F.col("key.hash") == F.col("known_hash")) & F.col("path").eqNullSafe(F.col("known_path")), "left")
    joined = joined.join(inherited, F.col("folder") == F.col("heir"), "left")
    has = F.col("licence").isNotNull()
    origin = F.when(has, F.when(F.col("is_file"), "file").otherwise("header")).when(F.col("holder").isNotNull(), "inherited")
    return joined.select(
        "row", "path", F.coalesce("licence", "holder.licence").alias("licence"), origin.alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("holder.known_path")).alias("licence_path"),
        F.coalesce("similarity", "holder.similarity").alias("similarity"),
    )


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source/lang/id. They have no names, so the first document that speaks of a licence, of
    those of a source and language, is the LICENSE of that folder, and the first of a source the LICENSE of the source."""
    names = [F.coalesce(F.col(c), F.lit("none")) for c in ("source", "lang")]
    own = docs.select("doc_id", "text", names[0].alias("source"), names[1].alias("lang"))
    speak = settled(own.where(speaks(F.col("text"))).select("doc_id", "source", "lang"), "licence-speakers")
    # Ids may repeat in other sources and languages: a file is told by all three.
    place = F.struct("doc_id", "lang")
    root = speak.where("doc_id IS NOT NULL").groupBy("source").agg(F.min(place).alias("first"))
    # The source's own file leaves its folder to the next document there.
    rest = speak.join(root.withColumnRenamed("source", "s"), (F.col("source") == F.col("s")) & (place > F.col("first")))
    folder = rest.groupBy("source", "lang").agg(F.min("doc_id").alias("first")).select(
        "source", "lang", "first", F.concat_ws("/", "source", "lang", F.lit("LICENSE")).alias("name")
    )
    top = root.select("source", "first.lang", F.col("first.doc_id").alias("first"), F.concat_ws("/", "source", F.lit("LICENSE")).alias("name"))
    named = top.union(folder).select(F.col("source").alias("own_source"), F.col("lang").alias("own_lang"), "first", "name")
    plain = F.concat_ws("/", "source", "lang", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    same = (F.col("doc_id") == F.col("first")) & (F.col("source") == F.col("own_source")) & (F.col("lang") == F.col("own_lang"))
    joined = own.join(named, same, "left")
    return joined.select("doc_id", F.coalesce("name", plain).alias("path"), "text")


VALUES_SQL = ", ".join(
    f"('{name}', {i}, '{part}')" for name, parts in sorted(TEMPLATES.items()) for i, part in enumerate(parts)
)
SQL = f"""
WITH d AS (SELECT doc_id, text, coalesce(source, 'none') AS source, coalesce(lang, 'none') AS lang FROM documents),
s AS (SELECT * FROM d WHERE regexp_matches(text, '{CUE}')),
root AS (SELECT source, min(doc_id) AS first FROM s GROUP BY source),
folder AS (SELECT s.source, s.lang, min(s.doc_id) AS first FROM s JOIN root USING (source) WHERE s.doc_id > root.first GROUP BY ALL),
n AS (SELECT first, source || '/LICENSE' AS name FROM root UNION ALL SELECT first, source || '/' || lang || '/LICENSE' FROM folder),
f AS (SELECT doc_id, text, coalesce(name, source || '/' || lang || '/' || doc_id) AS path FROM d LEFT JOIN n ON doc_id = first),
h AS (SELECT path, 'header' AS kind, array_to_string(list_sort(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{CUE}'))), chr(10)) AS part
    FROM f WHERE regexp_matches(text, '{CUE}') UNION ALL SELECT path, 'whole', text FROM f WHERE path LIKE '%/LICENSE'),
k AS (SELECT * FROM (VALUES {VALUES_SQL}) v(licence, variant, part)),
t AS (SELECT path, kind AS key, NULL AS licence, regexp_extract_all(lower(part), '{TERM}') AS terms FROM h
    UNION ALL SELECT '', variant::VARCHAR, licence, regexp_extract_all(lower(part), '{TERM}') FROM k),
i AS (SELECT term, ln((1 + (SELECT count(*) FROM t)) / (1 + count(*))) + 1 AS idf
    FROM (SELECT DISTINCT path, key, licence, unnest(terms) AS term FROM t) GROUP BY term),
c AS (SELECT path, key, licence, term, (1 + ln(count(*))) * any_value(idf) AS weight FROM (SELECT path, key, licence, unnest(terms) AS term FROM t)
    JOIN i USING (term) GROUP BY path, key, licence, term),
z AS (SELECT path, key, licence, sqrt(sum(weight * weight)) AS norm FROM c GROUP BY path, key, licence),
x AS (SELECT a.path, a.key AS kind, b.licence, b.key AS variant, sum(a.weight * b.weight) AS dot FROM c a JOIN c b USING (term)
    WHERE a.licence IS NULL AND b.licence IS NOT NULL GROUP BY ALL),
y AS (SELECT x.path, x.licence, round(dot / (za.norm * zb.norm), 6) AS similarity FROM x
    JOIN z za ON za.path = x.path AND za.key = x.kind AND za.licence IS NULL JOIN z zb ON zb.key = x.variant AND zb.licence = x.licence),
m AS (SELECT path, licence, similarity FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY similarity DESC, licence) AS r
    FROM y WHERE similarity >= {THRESHOLD}) WHERE r = 1),
g AS (SELECT f.doc_id, f.path, m.licence, m.similarity, a.path AS p1, a.licence AS l1, a.similarity AS s1, b.path AS p2, b.licence AS l2, b.similarity AS s2
    FROM f LEFT JOIN m USING (path)
    LEFT JOIN m a ON a.path = regexp_extract(f.path, '^(.*)/[^/]*$', 1) || '/LICENSE'
    LEFT JOIN m b ON b.path = regexp_extract(f.path, '^([^/]*)/', 1) || '/LICENSE')
SELECT doc_id, path, coalesce(licence, l1, l2) AS licence, CASE WHEN licence IS NOT NULL THEN CASE WHEN path LIKE '%/LICENSE' THEN 'file' ELSE 'header' END
    WHEN coalesce(l1, l2) IS NOT NULL THEN 'inherited' END AS origin,
    CASE WHEN licence IS NOT NULL THEN path WHEN l1 IS NOT NULL THEN p1 ELSE p2 END AS licence_path,
    CASE WHEN licence IS NOT NULL THEN similarity WHEN l1 IS NOT NULL THEN s1 ELSE s2 END AS similarity FROM g
"""


@query("op10_licence_scans", SQL)
def op10(spark, folder):
    found = scan(document_files(read(spark, folder, "documents")), carry=["doc_id"])
    return found.select("row.doc_id", "path", "licence", "origin", "licence_path", "similarity")
