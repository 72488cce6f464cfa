"""Deterministic hashing: the same row gives the same draw on any cluster."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_RANGE = 1 << 32  # eight hexadecimal digits


def hex_to_long(digest: Column, start: int = 1, digits: int = 8) -> Column:
    """Read ``digits`` hexadecimal characters of a digest as a bigint."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def draw(key: Column, op: str, seed: int = 42) -> Column:
    """Pseudo-random bigint in [0, 2**32) that depends on seed, operation and row key only."""
    return hex_to_long(F.md5(F.concat(F.lit(f"{seed}|{op}|"), key.cast("string"))))


def threshold(prob: float) -> int:
    """Draws below this value are selected with the given probability."""
    return int(prob * DRAW_RANGE)


def chosen(key: Column, op: str, prob: float, seed: int = 42) -> Column:
    return draw(key, op, seed) < F.lit(threshold(prob))


LONG_TEXT = 128  # characters; longer texts are compared by their SHA-256


def compact(value: str) -> str:
    """SQL text for the value itself, or for a long one its start and the digest of all of it.

    Equal exactly when the texts are, and in the order of the texts unless their starts agree.
    """
    short = f"concat(substring({value}, 1, {LONG_TEXT}), ' sha256:', sha2({value}, 256))"
    return f"CASE WHEN length({value}) > {LONG_TEXT} THEN {short} ELSE {value} END"


def row_text(columns: list[Column]) -> Column:
    """Rows as one text: each field with its length before it, NULL as a dash. Unlike rows have unlike texts."""
    fields = []
    for column in columns:
        text = column.cast("string")
        fields.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat_ws("|", *fields)


def hex_to_decimal(digest: Column, digits: int = 16) -> Column:
    """Read the first 16 hexadecimal digits (64 bits) of a digest as an unsigned number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("decimal(20,0)")


def row_digest(columns: list[Column]) -> Column:
    return F.md5(row_text(columns))
