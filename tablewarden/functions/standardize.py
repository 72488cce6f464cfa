"""Repair expressions: dates in several formats, e-mail, phone, names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the canonical format first, then the drifted ones. A date such
# as 05/01/2024 fits two of them, so the order is the caller's to choose.
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MMM-yyyy", "yyyyMMdd", "dd.MM.yyyy"]


def parse_date(value: Column, formats: list[str] | None = None) -> Column:
    """First format that parses wins; NULL when none does."""
    text = F.trim(value)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats or DATE_FORMATS])


def clean_email(value: Column) -> Column:
    """Trim, lower-case, commas back to dots, doubled dots to one; '' becomes NULL."""
    text = F.regexp_replace(F.translate(F.lower(F.trim(value)), ",", "."), r"\.{2,}", ".")
    return F.nullif(text, F.lit(""))


def clean_phone(value: Column, country_code: str = "1") -> Column:
    """``+<country><ten digits>`` when ten digits can be recovered, else NULL."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    full = F.concat(F.lit("+" + country_code), F.right(digits, F.lit(10)))
    plain = F.length(digits) == 10
    prefixed = (F.length(digits) == 10 + len(country_code)) & digits.startswith(country_code)
    return F.when(plain | prefixed, full)


def squeeze_spaces(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"\s+", " "))
