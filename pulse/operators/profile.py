"""Row counts, value counts and samples."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructType

log = logging.getLogger(__name__)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows as a by-product of the next action: read `observation.get["n_rows"]`
    after it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows")), observation


def require_rows(n_rows: int, name: str, *, strict: bool = False) -> int:
    """Log the row count; an empty result is an error in the log, or raised when strict."""
    if n_rows:
        log.info("%s: %d rows", name, n_rows)
    elif strict:
        raise ValueError(f"{name} is empty")
    else:
        log.error("%s is empty", name)
    return n_rows


def _as_text(df: DataFrame, column: str) -> Column:
    """A value as text, different values as different texts."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (StructType, ArrayType)):
        return F.to_json(F.struct(value), {"ignoreNullFields": "false"})
    if isinstance(kind, (FloatType, DoubleType)):
        # Both zeros are one value.
        value = value + F.lit(0.0).cast(kind)
    return value.cast("string")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n_rows): how often every value occurs, null among them, as text.

    A row becomes a name and a value per column, which are counted in every task before the
    shuffle, so a hot value sends one row per task."""
    pairs = [
        F.struct(
            F.lit(name).alias("column"),
            F.when(F.col(f"`{name}`").isNotNull(), _as_text(df, name)).alias("value"),
        )
        for name in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def profile_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls, distinct values, and rows of the most frequent value."""
    filled = F.col("value").isNotNull()
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.coalesce(F.sum(F.when(~filled, F.col("n_rows"))), F.lit(0)).alias("n_null"),
            F.count_if(filled).alias("n_distinct"),
            F.coalesce(F.max(F.when(filled, F.col("n_rows"))), F.lit(0)).alias("n_top"),
        )
    )


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the row count and, for each column, its number of distinct non-null values."""
    if not columns:
        return df.agg(F.count(F.lit(1)).alias("n_rows"))
    # Rows are counted once per column.
    found = value_counts(df, columns)
    rows = F.sum(F.when(F.col("column") == columns[0], F.col("n_rows")))
    return found.agg(
        F.coalesce(rows, F.lit(0)).alias("n_rows"),
        *(
            F.count_if((F.col("column") == name) & F.col("value").isNotNull()).alias(f"n_{name}")
            for name in columns
        ),
    )


def column_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def total_order(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """`order`, closed by all columns that can be sorted, so that every run picks the same rows."""
    sortable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    return [*order, *(F.col(f"`{name}`").asc_nulls_last() for name in sortable)]


def sample_rows(df: DataFrame, n: int = 5, order: Sequence[Column] = ()) -> DataFrame:
    """The first n rows by a total order, the same at every run; every task sends n rows at most."""
    return df.orderBy(*total_order(df, order)).limit(n)


def sample_per_key(
    df: DataFrame, keys: Sequence[str], n: int = 5, order: Sequence[Column] = ()
) -> DataFrame:
    """The first n rows of every key by a total order; every task sends n rows a key at most."""
    window = Window.partitionBy(*keys).orderBy(*total_order(df, order))
    return (
        df.withColumn("__position", F.row_number().over(window))
        .filter(F.col("__position") <= n)
        .drop("__position")
    )
