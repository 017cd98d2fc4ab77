"""Casts for source columns that may arrive as text. Text that does not parse becomes null.

A column that already has the wanted type is returned as it is, so that filters on it still
reach the Parquet scan.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.calendar import timestamp_literal


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a timestamp without zone, in the session's zone (UTC)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    # By way of an instant: an offset written in the text is then taken into account.
    return F.col(name).try_cast("timestamp").cast("timestamp_ntz")


def not_before(df: DataFrame, name: str, bound: datetime) -> Column:
    """True where the column is at or after `bound`; null where it is null."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.col(name) >= F.lit(f"{bound.isoformat(sep=' ')} UTC").cast("timestamp")
    return as_timestamp(df, name) >= timestamp_literal(bound)


def as_boolean(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.col(name)
    return F.col(name).try_cast("boolean")


def as_long(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name)
    return F.col(name).try_cast("bigint")
