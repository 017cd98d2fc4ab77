"""Counts per key, and their attachment to a spine.

All of them reduce rows before the shuffle. Distinct counts shuffle by key and value first, so a
hot key is spread over its values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.operators.enrich import Keys, lookup


def distinct_by(
    df: DataFrame, keys: Sequence[str], value: str, out: str, *, skip_null: bool = False
) -> DataFrame:
    """Exact distinct values per key. With `skip_null`, keys with nulls only are left out
    instead of counting zero."""
    if skip_null:
        df = df.filter(F.col(value).isNotNull())
    return df.groupBy(*keys).agg(F.count_distinct(value).alias(out))


def distinct_split(
    df: DataFrame, keys: Sequence[str], value: str, counts: Mapping[str, Column | None]
) -> DataFrame:
    """Several distinct counts of one value in one pass, each over the rows that meet its
    condition (None for all rows).

    Rows are first reduced to one per key and value with a flag for each condition; a plain
    aggregate with several distinct counts would copy every row once per count instead.
    """
    flags = {
        out: F.lit(True) if condition is None else condition for out, condition in counts.items()
    }
    values = df.groupBy(*keys, value).agg(
        *(F.bool_or(flag).alias(f"__{out}") for out, flag in flags.items())
    )
    present = F.col(value).isNotNull()
    return values.groupBy(*keys).agg(
        *(F.count_if(present & F.col(f"__{out}")).alias(out) for out in flags)
    )


def conditional_counts(
    df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column], *extra: Column
) -> DataFrame:
    """Rows per key that meet each condition, all in one pass, with `extra` aggregates of the
    same grouping alongside. A null condition does not count."""
    return df.groupBy(*keys).agg(
        *(F.count_if(condition).alias(out) for out, condition in counts.items()), *extra
    )


def attach_metrics(
    spine: DataFrame, metrics: Iterable[tuple[DataFrame, Keys]], fill: Sequence[str]
) -> DataFrame:
    """Left-join metrics that have one row per key, and zero-fill the named columns only."""
    for metric, on in metrics:
        spine = lookup(spine, metric, on)
    return spine.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in fill})
