"""Host-level quality rules: failure rates per host, shrunk by an empirical beta prior, decide on documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import query, read, settled

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BLANK = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
BROADCAST_HOSTS = 50_000  # verdicts of more hosts are joined by a shuffle

# Each rule names documents that fail it, from the counts of `measures`. The first two are the base rules.
RULES = {
    "few_words": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "copied_lines": "10 * n_dup_lines > 3 * n_lines",
    "long_words": "word_chars > 20 * n_words",
}
BASE = ("few_words", "repeats")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, also where lambda functions read it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more. Distinct hashes prove that no window does; else the
    sorted windows show the repeated ones, and each covers up to three words not covered by the next."""

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)

        def exact() -> Column:
            pairs = F.sort_array(
                F.transform(starts, lambda i: F.struct(
                    F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i")
                ))
            )

            def places(s: Column) -> Column:
                def repeated(k: Column) -> Column:
                    own = F.get(s, k)["t"]
                    same = F.coalesce(own == F.get(s, k - 1)["t"], F.lit(False)) | F.coalesce(
                        own == F.get(s, k + 1)["t"], F.lit(False)
                    )
                    return F.when(same, F.get(s, k)["i"])

                return F.sort_array(F.array_compact(F.transform(F.sequence(F.lit(0), F.size(s) - 1), repeated)))

            def covered(p: Column) -> Column:
                steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
                return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

            return let(let(pairs, places), covered)

        hashes = F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        unique = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
        return F.when(F.size(w) < 4, 0).otherwise(F.when(unique, 0).otherwise(exact()))

    return let(words, windows)


def measures(text: Column) -> dict[str, Column]:
    """The counts the rules are made of, for a column without NULLs."""
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, SPACES, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_lines": F.size(lines),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_words(words),
    }
    return {name: c.cast("bigint") for name, c in counts.items()}


def shrunk_rates(hosts: DataFrame) -> DataFrame:
    """Hosts (host, n, failed) with ``rate``: the mean of a beta posterior whose prior fits all hosts.

    The prior has the pooled rate as its mean and, by moments weighted with the documents, the spread between hosts
    beyond sampling noise; without such a spread every host gets the pooled rate.
    """
    spread = F.sum(F.col("failed") * F.col("failed") / F.col("n"))
    pooled = hosts.agg(
        F.sum("n").alias("docs"), F.sum("failed").alias("bad"), F.count("*").alias("hosts"), spread.alias("squares")
    )
    pooled = pooled.select("docs", "hosts", (F.col("bad") / F.col("docs")).alias("mean"), "squares")
    noise = F.col("mean") * (1 - F.col("mean"))
    between = F.col("squares") / F.col("docs") - F.col("mean") * F.col("mean") - noise * F.col("hosts") / F.col("docs")
    pooled = pooled.select("mean", noise.alias("noise"), F.greatest(between, F.lit(0.0)).alias("between"))
    strength = F.greatest(F.col("noise") / F.col("between") - 1, F.lit(0.0))
    rate = F.when(F.col("between") * 1e9 <= F.col("noise"), F.col("mean")).otherwise(
        (F.col("failed") + F.col("mean") * strength) / (F.col("n") + strength)
    )
    return hosts.join(F.broadcast(pooled)).select("host", "n", "failed", rate.alias("rate"))  # pooled is one row


def judge(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    *,
    carry: list[str] | None = None,
    trusted: float = 0.02,
    rejected: float = 0.6,
) -> DataFrame:
    """One row per document: row (columns in ``carry``, or all), the counts, base_failed, host_verdict, kept.

    A host is a value of ``host_col``; NULL is a host of its own. Its share of documents that fail any of RULES,
    shrunk towards all hosts, makes it ``trusted`` (at most that share), ``rejected`` (more than that share) or ``mixed``.
    A document that fails a base rule goes. Of the others a trusted host keeps all, a rejected one none, a mixed
    one those that fail no rule. NULL texts have no words and fail; repeated rows are judged each; no rows give none.
    Carried columns and counts are stored between the hosts' and the documents' verdicts, so every text is counted once.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct("*")
    own = docs.select(
        carried.alias("row"), F.col(f"`{host_col}`").cast("string").alias("host"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    marks = own.select("row", "host", *[c.alias(name) for name, c in measures(F.col("text")).items()])
    marks = marks.withColumn("base_failed", F.expr(" OR ".join(f"({RULES[r]})" for r in BASE)))
    marks = marks.withColumn("failed", F.expr(" OR ".join(f"({r})" for r in RULES.values())))
    marks = settled(marks, "quality")
    hosts = marks.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("bigint")).alias("failed"))
    hosts = shrunk_rates(settled(hosts, "hosts"))
    verdict = F.when(F.col("rate") <= trusted, "trusted").when(F.col("rate") > rejected, "rejected").otherwise("mixed")
    verdicts = settled(hosts.select("host", verdict.alias("host_verdict")), "host-verdicts")
    if verdicts.count() <= BROADCAST_HOSTS:
        verdicts = F.broadcast(verdicts)
    verdicts = verdicts.withColumnRenamed("host", "judged_host")
    found = marks.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host")))
    kept = ~F.col("base_failed") & (
        (F.col("host_verdict") == "trusted") | ((F.col("host_verdict") == "mixed") & ~F.col("failed"))
    )
    return found.select("row", *measures(F.lit("")), "base_failed", "host_verdict", kept.alias("kept"))


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_verdict", "kept"]
BLANK_SQL = "[\\x20\\x09-\\x0D]+"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '{BLANK_SQL}'), lambda x: x <> '') AS w FROM d),
p AS (SELECT r, w, unnest(range(len(w) - 2)) AS i FROM w WHERE len(w) >= 3),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) AS n FROM p),
c AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM g, range(3) x(k) WHERE n > 1 GROUP BY r),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
m AS (SELECT r, doc_id, source, len(w) AS n_words, length(regexp_replace(t, '{BLANK_SQL}', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d JOIN w USING (r) JOIN l USING (r) LEFT JOIN c USING (r)),
f AS (SELECT *, {' OR '.join(f'({RULES[x]})' for x in BASE)} AS base_failed, {' OR '.join(f'({x})' for x in RULES.values())} AS failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS k FROM f GROUP BY source),
o AS (SELECT sum(k) / sum(n) AS mean, sum(n) AS docs, count(*) AS hosts, sum(k * k / n) AS squares FROM h),
q AS (SELECT mean, mean * (1 - mean) AS noise, squares / docs - mean * mean - mean * (1 - mean) * hosts / docs AS between_hosts FROM o),
v AS (SELECT source, CASE WHEN greatest(between_hosts, 0) * 1e9 <= noise THEN mean ELSE
    (k + mean * greatest(noise / between_hosts - 1, 0)) / (n + greatest(noise / between_hosts - 1, 0)) END AS rate FROM h, q),
j AS (SELECT f.*, CASE WHEN rate <= 0.02 THEN 'trusted' WHEN rate > 0.6 THEN 'rejected' ELSE 'mixed' END AS host_verdict
    FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    n_repeat_words::BIGINT AS n_repeat_words, base_failed, host_verdict,
    NOT base_failed AND (host_verdict = 'trusted' OR (host_verdict = 'mixed' AND NOT failed)) AS kept FROM j
"""


@query("op1_quality_rules", SQL)
def op1(spark, folder):
    return judge(read(spark, folder, "documents"), carry=["doc_id"]).select("row.doc_id", *FIELDS)
