"""Label translation from a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.operators.enrich import lookup


def translate_labels(
    df: DataFrame,
    column: str,
    mapping: DataFrame | None,
    out: str,
    *,
    source: str = "source",
    target: str = "target",
) -> DataFrame:
    """Add `out`: the mapped text, or the text itself where the mapping has none. Null stays
    null. A key listed twice takes its smallest target, so the row count never changes."""
    if mapping is None:
        return df.withColumn(out, F.col(column))
    unique = mapping.groupBy(F.col(source).alias("__source")).agg(F.min(target).alias(out))
    return lookup(df, unique, {column: "__source"}, split_hot=True).withColumn(
        out, F.coalesce(F.col(out), F.col(column))
    )
