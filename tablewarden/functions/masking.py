"""Masks for sensitive columns: each is defined once, as the body of an SQL function; columns are masked by calling it."""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# fixed values
MASK = "****"
REDACTED = "***REDACTED***"

ADDRESS = r"r'(?s)^([^@]?)[^@]*(@[^@]*).*$'"  # the initial, the rest of the user, and the part up to a second @

DEFINITIONS = {
    # both ends of two characters stay where there are four or more; the middle becomes stars, one at least
    "mask_partial": (
        f"if(char_length(value) >= 4, overlay(value PLACING rpad('', greatest(char_length(value) - 4, 1), '*') "
        f"FROM 3 FOR char_length(value) - 4), '{MASK}')"
    ),
    "mask_email": f"if(value RLIKE {ADDRESS}, regexp_replace(value, {ADDRESS}, '$1***$2'), '{MASK}')",
    "hash_id": "sha2(coalesce(value, ''), 256)",
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session and return their names."""
    for name, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {body}")
    return list(DEFINITIONS)


def _called(name: str, value: Column) -> Column:
    spark = SparkSession.active()
    if not spark.catalog.functionExists(name):
        register(spark)
    return F.call_function(name, value.cast("string"))


def mask_partial(value: Column) -> Column:
    """The first two and last two characters with stars between; short or missing values vanish."""
    return _called("mask_partial", value)


def mask_email(value: Column) -> Column:
    """The user's initial and the part between the first and second ``@``; anything else vanishes."""
    return _called("mask_email", value)


def hash_id(value: Column) -> Column:
    """Unsalted SHA-256, so that pseudonyms still join across tables."""
    return _called("hash_id", value)


def redact(value: Column) -> Column:
    """A constant in place of the value."""
    return F.lit(REDACTED)


def tokenize(value: Column, salt: str) -> Column:
    """Salted pseudonym; NULL stays NULL."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)
