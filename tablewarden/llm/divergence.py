"""Divergence of sources: term counts as hash-consed segment trees, priced by walking two trees at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import char_class, flat, query, read, settled, slices, word_spans
from tablewarden.operators.attach import attach

SCALE, PSEUDO = 1_000_000_000, 5  # fixed values: unit of a share, and what is added to every count
SLICE = 8 << 20  # text that a task counts at once
LEAVES = 2048  # terms of a tree, at most in the mean
GROUPS = 32  # groups of a tile
WALK = 1 << 21  # leaves of the walks of one step

LETTERS = char_class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
ABSENT = -1  # count of a leaf without a term


# --- counting ------------------------------------------------------------------------
def term_counts(batches):
    """(lang, source, term, n, docs) of slices of texts."""
    for batch in batches:
        lang, source, column = batch.column(0), batch.column(1), batch.column(2)
        for low, high in slices(column, SLICE):
            data, offsets = flat(column.slice(low, high - low).to_pylist())
            if not len(data):
                continue
            starts, ends, before = word_spans(data, offsets, LETTERS)
            edges = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
            letters = LOWER[data[LETTERS[data]]]
            terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(letters)])
            terms = terms.dictionary_encode()
            many = max(1, len(terms.dictionary))
            of = np.repeat(np.arange(high - low), np.diff(before))
            pairs = [lang.slice(low, high - low).to_pandas(), source.slice(low, high - low).to_pandas()]
            group = pd.MultiIndex.from_arrays(pairs).factorize()[0]
            single, n = np.unique(of * many + terms.indices.to_numpy(), return_counts=True)
            text, term = np.divmod(single, many)
            found, at = np.unique(group[text] * many + term, return_inverse=True)
            docs = np.bincount(at, minlength=len(found))
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, at, n)
            first = np.full(int(group.max()) + 1, -1)
            first[group[::-1]] = np.arange(high - 1, low - 1, -1)
            row = pa.array(first[found // many])
            yield pa.RecordBatch.from_arrays(
                [lang.take(row), source.take(row), terms.dictionary.take(pa.array(found % many)).cast(pa.string()),
                 pa.array(sums), pa.array(docs.astype(np.int64))],
                ["lang", "source", "term", "n", "docs"],
            )


# --- trees ---------------------------------------------------------------------------
class Forest:
    """Segment trees over the same terms, one per row of counts. Equal subtrees of one height are one node.

    Level 0 holds the distinct counts; a node of a higher level is the pair of its halves.
    """

    def __init__(self, counts: np.ndarray):
        height = max(0, int(counts.shape[1] - 1).bit_length())
        wide = np.full((len(counts), 1 << height), ABSENT, np.int64)
        wide[:, : counts.shape[1]] = counts
        self.counts, nodes = np.unique(wide, return_inverse=True)
        nodes = nodes.reshape(wide.shape)
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        below = len(self.counts)
        for _ in range(height):
            halves = nodes[:, ::2] * below + nodes[:, 1::2]
            which, distinct = pd.factorize(halves.ravel())
            self.left.append(distinct // below)
            self.right.append(distinct % below)
            nodes, below = which.reshape(halves.shape), len(distinct)
        self.roots = nodes[:, 0]

    def level(self, k: int) -> int:
        return len(self.left[k - 1]) if k else len(self.counts)

    def prices(self, shares: np.ndarray, kinds: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Sum of the absolute differences of shares between the trees ``one`` and ``other``, walked in step.

        ``shares`` has the share of each distinct count for each kind of group, ``kinds`` the kind of each tree. Two
        nodes that meet again under the same kinds have their price already: every level keeps distinct pairs only.
        """
        many = len(shares)
        met = kinds[one] * many + kinds[other]
        meetings, at = [], []
        x, y = self.roots[one], self.roots[other]
        for k in range(len(self.left), -1, -1):
            size = self.level(k)
            codes, inverse = np.unique((met * size + x) * size + y, return_inverse=True)
            at.append(inverse)
            y, rest = codes % size, codes // size
            x, met = rest % size, rest // size
            if k:
                meetings.append(len(codes))
                met = np.concatenate([met, met])
                x, y = (np.concatenate([self.left[k - 1][v], self.right[k - 1][v]]) for v in (x, y))
        price = np.abs(shares[met // many, x] - shares[met % many, y])
        while meetings:
            below = price[at.pop()]
            half = meetings.pop()
            price = below[:half] + below[half:]
        return price[at.pop()]

    def positions(self, tree: int) -> np.ndarray:
        """Terms a tree counts, found without entering subtrees of zeros."""
        empty = [np.flatnonzero(self.counts <= 0)]
        for left, right in zip(self.left, self.right, strict=True):
            empty.append(np.flatnonzero(np.isin(left, empty[-1]) & np.isin(right, empty[-1])))
        node, place = self.roots[[tree]], np.zeros(1, np.int64)
        for k in range(len(self.left), 0, -1):
            node, place = (v[~np.isin(node, empty[k])] for v in (node, place))
            node, place = np.concatenate([self.left[k - 1][node], self.right[k - 1][node]]), np.concatenate([2 * place, 2 * place + 1])
        return np.sort(place[~np.isin(node, empty[0])])


def share(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PSEUDO) / (total + PSEUDO * terms)), in whole numbers of any size; 0 where no term is."""
    under = total + PSEUDO * terms
    known = counts >= 0
    found = np.zeros(len(counts), np.int64)
    if under:
        found[known] = (SCALE * (counts[known].astype(object) + PSEUDO) // under + 1).astype(np.int64)
    return found


def audit(top: int):
    """Prices of the pairs of groups of two tiles over the terms of a bucket, and candidates for the leading terms."""

    def run(table: pa.Table) -> pa.Table:
        lang, first, second = (table.column(c)[0].as_py() for c in ("lang", "low", "high"))
        rows = table.select(["source", "tile", "term", "n", "total", "terms"]).to_pandas()
        heads = rows[rows.term.isna()].sort_values("source", kind="stable")  # each group once
        if not len(heads):
            return result([])
        whole = rows[rows.source.isna() & rows.term.notna()]
        terms = np.sort(np.array([t.encode() for t in whole.term], object))
        at = {t: k for k, t in enumerate(terms)}
        names, tiles = heads.source.tolist(), heads.tile.to_numpy()
        row = {s: k for k, s in enumerate(names)}
        counts = np.zeros((len(names) + 1, max(1, len(terms))), np.int64)
        if not len(terms):
            counts[:] = ABSENT
        own = rows[rows.source.notna() & rows.term.notna()]
        counts[[row[s] for s in own.source], [at[t.encode()] for t in own.term]] = own.n
        counts[-1, [at[t.encode()] for t in whole.term]] = whole.n
        forest = Forest(counts)
        totals = [*heads.total.astype(int), int(whole.total.iloc[0]) if len(whole) else 0]
        vocabulary = int(heads.terms.iloc[0])
        distinct, kinds = np.unique(np.array(totals, object), return_inverse=True)
        shares = np.stack([share(forest.counts, int(t), vocabulary) for t in distinct])
        out = []
        here, there = np.flatnonzero(tiles == first), np.flatnonzero(tiles == second)
        one, other = (v.ravel() for v in np.meshgrid(here, there, indexing="ij"))
        if first == second:
            one, other = one[one < other], other[one < other]
        step = max(1, WALK // counts.shape[1])
        for k in range(0, len(one), step):
            a, b = one[k : k + step], other[k : k + step]
            price = forest.prices(shares, kinds, a, b)
            out += [(lang, names[i], "pair", names[j], int(v)) for i, j, v in zip(a.tolist(), b.tolist(), price.tolist(), strict=True)]
        if first == second and len(terms):
            q = shares[kinds[-1], np.searchsorted(forest.counts, counts[-1])]
            for g in range(len(names)):
                place = forest.positions(g)
                value = shares[kinds[g], np.searchsorted(forest.counts, counts[g, place])] - q[place]
                place, value = place[value > 0], value[value > 0]
                lead = np.lexsort((place, -value))[:top]
                out += [(lang, names[g], "term", terms[p].decode(), int(v)) for p, v in zip(place[lead].tolist(), value[lead].tolist(), strict=True)]
        return result(out)

    return run


def result(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "part", "item", "value"])


def _spread(key: list, parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def divergence(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30,
    top: int = 50, leaves: int = LEAVES, tile: int = GROUPS,
) -> DataFrame:
    """(lang, source, part, item, value): how far the term shares of each source are from those of others in its language.

    NULL texts, languages and sources count as ''. Terms are runs of ASCII letters and characters beyond ASCII, A-Z in
    lower case; a language keeps those in ``least_docs`` of its documents. Part ``pair`` has a row for each other source
    of the language (0 where no term is kept), part ``term`` the ``top`` terms that a source has more of than the
    language, at equal values the smaller in UTF-8. Repeated rows are documents of their own; no documents give no rows.

    Terms are dealt to buckets by hash and groups to tiles, so a task holds the trees of two tiles over one bucket,
    however many terms, documents or groups there are; the prices of buckets are summed. A tile travels once to each
    other tile of its language. Counts are summed per task before they are shuffled.
    """

    def text(column: str) -> Column:
        return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))

    own = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))
    schema = "lang string, source string, term string, n bigint, docs bigint"
    counts = own.mapInArrow(term_counts, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = settled(counts, "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = settled(kept.select("lang", "term", "n"), "kept-terms")
    counts = settled(counts.select("lang", "source", "term", "n").join(kept.select("lang", "term"), ["lang", "term"], "left_semi"), "kept-counts")

    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = settled(groups.fillna(0, ["total", "terms", "lang_total"]), "groups")
    largest = groups.groupBy("lang").agg(F.count("*").alias("groups"), F.max("terms").alias("terms"))
    largest = largest.agg(F.max("groups").alias("groups"), F.max("terms").alias("terms")).first()  # two numbers
    if largest.groups is None:
        return docs.sparkSession.createDataFrame([], "lang string, source string, part string, item string, value bigint")
    buckets, tiles = max(1, -(-largest.terms // leaves)), max(1, -(-largest.groups // tile))

    groups = groups.withColumn("tile", _spread(["lang", "source"], tiles))
    shape = ["lang", "bucket", "low", "high", "source", "tile", "term", "n", "total", "terms"]
    partner = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("partner")
    to = [F.least("tile", "partner").alias("low"), F.greatest("tile", "partner").alias("high")]
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    heads = groups.select("*", every).select("*", partner).select("*", *to).withColumn("term", F.lit(None).cast("string")).withColumn("n", F.lit(None).cast("bigint"))
    held = attach(counts, groups.select("lang", "source", "tile", "total", "terms"), ["lang", "source"])
    held = held.withColumn("bucket", _spread(["lang", "term"], buckets)).select("*", partner).select("*", *to)
    whole = attach(kept, groups.select("lang", "lang_total", "terms").distinct(), ["lang"]).withColumnRenamed("lang_total", "total")
    whole = whole.withColumn("bucket", _spread(["lang", "term"], buckets)).select("*", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("low"))
    whole = whole.select("*", F.explode(F.sequence(F.col("low"), F.lit(tiles - 1))).alias("high"))
    whole = whole.withColumn("source", F.lit(None).cast("string")).withColumn("tile", F.lit(None).cast("int"))
    rows = heads.select(shape).unionByName(held.select(shape)).unionByName(whole.select(shape))
    found = rows.groupBy("lang", "bucket", "low", "high").applyInArrow(audit(top), "lang string, source string, part string, item string, value bigint")
    found = settled(found, "prices")
    summed = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    mirrored = summed.select("lang", "value", F.inline(both)).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    lead = found.where("part = 'term'").withColumn("at", place()).where(F.col("at") <= top).drop("at")
    return mirrored.unionByName(lead)


def place() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


UPPER = "".join(map(chr, range(0x41, 0x5B)))

SQL = f"""WITH d AS (SELECT row_number() OVER () AS id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS text,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
  w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
  k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 30),
  v AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM k GROUP BY lang),
  g AS (SELECT DISTINCT lang, source FROM d),
  c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
  t AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
  p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n,
      1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (t.total + 5 * terms) AS p,
      1 + 1000000000::HUGEINT * (k.n + 5) // (v.total + 5 * terms) AS q
    FROM t JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
  s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  f AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
      LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
    UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
  r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM f)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50"""


@query("op11_source_divergence", SQL)
def op11(spark, folder):
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    found = divergence(read(spark, folder, "documents")).withColumn("rank", F.row_number().over(order))
    return found.select("lang", "source", "part", "item", "value", "rank")
