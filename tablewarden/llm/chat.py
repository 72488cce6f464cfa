"""Chat formatting of multi-party dialogues: one rendering per participant, with that one as the assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import query, read

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
CHUNK = 1024  # turns numbered together; a dialogue of any length is never one group


def escaped(text: Column) -> Column:
    """Text in which no marker of the format can be read."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def named(role: Column) -> Column:
    """A speaker's name without white space and signs that the format uses."""
    return F.regexp_replace(role, r"[\x00-\x20<|>\x7F]", "_")


def rotate(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    *,
    system: str = "system",
) -> DataFrame:
    """Messages of each dialogue as each participant sees it: conv_id, perspective, position, speaker, segment,
    seg_start, seg_end, loss_start, loss_end.

    A participant is a role of the dialogue other than ``system``; turns without a role are by ``unknown``. The
    participant's own turns are the assistant's, all others are named users, system turns stay. The segments of one
    perspective, one after another by position, are its text; seg_start and seg_end are their places in characters. The loss
    covers the participant's own words with the end marker, loss_start to loss_end, and is NULL in other turns.

    Turns are ordered by number (NULL last), then role and text; NULL texts are empty; repeated rows are turns of
    their own; a NULL conv_id is one dialogue; a dialogue of system turns alone has no perspective.
    Turns are numbered in chunks whose sums are added up, so no task holds a long dialogue.
    """
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("unknown"))
    own = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        role.alias("speaker"), escaped(F.col(f"`{text_col}`").cast("string")).alias("words"),
    )
    parties = own.where(F.col("speaker") != system).select(
        F.col("conv_id").alias("party_conv"), F.col("speaker").alias("perspective")
    ).distinct()
    seen = own.join(parties, F.col("conv_id").eqNullSafe(F.col("party_conv"))).drop("party_conv")
    mine = F.col("speaker") == F.col("perspective")
    tag = F.when(F.col("speaker") == system, "system").when(mine, "assistant").otherwise(
        F.concat(F.lit("user name="), named(F.col("speaker")))
    )
    head = F.concat(F.lit(OPEN), tag, F.lit("\n"))
    seen = seen.withColumn("segment", F.concat(head, F.col("words"), F.lit(CLOSE))).withColumn("head", F.length(head))
    seen = seen.withColumn("size", F.length("segment").cast("bigint"))
    chunk = F.floor(F.col("turn") / CHUNK)
    seen = seen.withColumn("late", F.col("turn").isNull()).withColumn("chunk", F.coalesce(chunk, F.lit(0)))
    key = ["conv_id", "perspective"]
    place = ["late", "chunk"]
    sums = seen.groupBy(*key, *place).agg(F.count("*").alias("n"), F.sum("size").alias("chars"))
    earlier = Window.partitionBy(*key).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(c).alias(f"sum_{c}") for c in key + place],
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
    )
    match = [F.col(c).eqNullSafe(F.col(f"sum_{c}")) for c in key + place]
    order = Window.partitionBy(*key, *place).orderBy("turn", "speaker", "words")
    numbered = seen.withColumn("nth", F.row_number().over(order)).withColumn(
        "upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    joined = numbered.join(sums, match[0] & match[1] & match[2] & match[3])
    end = F.col("chars_before") + F.col("upto")
    start = end - F.col("size")
    return joined.select(
        "conv_id", "perspective", (F.col("n_before") + F.col("nth") - 1).alias("position"), "speaker", "segment",
        start.alias("seg_start"), end.alias("seg_end"),
        F.when(mine, start + F.col("head")).alias("loss_start"), F.when(mine, end).alias("loss_end"),
    )


SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|im_', '<| im_') AS words FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (SELECT t.*, perspective, '{OPEN}' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
    ELSE 'user name=' || regexp_replace(speaker, '[\\x00-\\x20<|>\\x7F]', '_', 'g') END || chr(10) AS head
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
g AS (SELECT *, head || words || '<|im_end|>' || chr(10) AS segment FROM s),
n AS (SELECT *, row_number() OVER w - 1 AS position, sum(length(segment)) OVER (w ROWS UNBOUNDED PRECEDING) AS seg_end FROM g
    WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, words))
SELECT conv_id, perspective, position::BIGINT AS position, speaker, segment, (seg_end - length(segment))::BIGINT AS seg_start, seg_end::BIGINT AS seg_end,
    CASE WHEN speaker = perspective THEN (seg_end - length(segment) + length(head))::BIGINT END AS loss_start,
    CASE WHEN speaker = perspective THEN seg_end::BIGINT END AS loss_end FROM n
"""


@query("op7_chat_formatting", SQL)
def op7(spark, folder):
    return rotate(read(spark, folder, "conversations"))
