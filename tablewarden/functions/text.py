"""Regular expressions used by rules, profiling and classification."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the accepted e-mail shapes -------------------------------
EMAIL_STRICT = r"^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}$"  # matched ignoring case
EMAIL_LOOSE = r"^[^@]+@[^@]+\.[^@]+$"
EMAIL_NO_SPACE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

# --- fixed values: semantic types in voting order (the first match wins) ----
SEMANTIC_PATTERNS = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$",
    "phone_e164": r"^\+?[1-9]\d{7,14}$",
    "phone_us": r"^\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}$",
    "date_iso": r"^\d{4}-\d{2}-\d{2}$",
    "date_us": r"^\d{1,2}/\d{1,2}/\d{2,4}$",
    "integer": r"^-?\d+$",
    "decimal": r"^-?\d+\.\d+$",
    "uuid": r"^[0-9a-fA-F-]{36}$",
}


def semantic_label(value: str) -> str:
    """SQL text for the name of the first semantic pattern the trimmed value matches, else NULL."""
    cases = " ".join(f"WHEN trim({value}) RLIKE r'{pattern}' THEN '{name}'" for name, pattern in SEMANTIC_PATTERNS.items())
    return f"CASE {cases} END"


def title_case(value: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(F.lower(value), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), run.substr(F.lit(2), F.length(run)))
        ),
        "",
    )


def replace_first(value: Column, needle: str, replacement: str) -> Column:
    """Replace the first occurrence of ``needle`` only."""
    at = F.instr(value, needle)
    return F.when(at > 0, F.overlay(value, F.lit(replacement), at, F.lit(len(needle)))).otherwise(value)
