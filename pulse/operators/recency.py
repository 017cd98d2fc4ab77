"""Recency against a fixed reference time; the lower bound is inclusive."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.casts import not_before
from pulse.operators.rollups import distinct_by


def recency_flag(
    df: DataFrame, name: str, as_of: datetime, window: timedelta, active: str, inactive: str
) -> Column:
    """Two-way status of a time column of `df`; null counts as inactive."""
    fresh = not_before(df, name, as_of - window)
    return F.when(fresh, F.lit(active)).otherwise(F.lit(inactive))


def recent(df: DataFrame, name: str, as_of: datetime, window: timedelta) -> DataFrame:
    return df.filter(not_before(df, name, as_of - window))


def recent_distinct(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    *,
    time: str,
    as_of: datetime,
    window: timedelta,
) -> DataFrame:
    """Distinct values per key among the recent rows; keys without one are absent."""
    return distinct_by(recent(df, time, as_of, window), keys, value, out)
