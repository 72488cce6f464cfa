"""Time arithmetic that does not depend on the session time zone."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(as_of: "str | datetime | Column") -> Column:
    """A timestamp without time zone from a literal, or the column itself."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def ago(as_of: "str | datetime | Column", interval: str) -> Column:
    return moment(as_of) - F.expr(f"interval {interval}")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end, as a double with the fraction kept."""
    gap = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    whole = (
        F.extract(F.lit("DAY"), gap) * 86400
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
    )
    return whole.cast("double") + F.extract(F.lit("SECOND"), gap).cast("double")
