"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The first row of every key in the given order.

    All kept columns close the order, so equal leaders are told apart by value and the result
    does not depend on the layout of the input. Spark limits each key to one row per task before
    the shuffle, so a hot key sends one row per task.
    """
    if not order:
        raise ValueError("an order is needed: without one the kept row is arbitrary")
    keep = list(df.columns if keep is None else keep)
    ties = [F.col(name).asc_nulls_last() for name in keep if name not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return (
        df.withColumn("__position", F.row_number().over(window))
        .filter(F.col("__position") == 1)
        .select(*keep)
    )
