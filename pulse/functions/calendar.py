"""Fixed-offset calendar arithmetic. Every time comes from the caller, never from the clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: how a time reads in a CSV output, in UTC.
CSV_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSS]'Z'"
# The same to the microsecond, for outputs that must read back as they were.
EXACT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"


def timestamp_literal(moment: datetime) -> Column:
    """A naive UTC moment as a constant without time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def shift_hours(column: Column, hours: int) -> Column:
    """Move a timestamp back by a fixed number of hours (an offset, not a time zone)."""
    return column - F.make_dt_interval(hours=F.lit(hours))


def month_key(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM")


def stamp(as_of: datetime) -> Column:
    """The day of the run as text."""
    return F.lit(as_of.strftime("%Y-%m-%d"))
