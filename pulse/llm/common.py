"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from pulse.session import bound_batches, scratch_path, shared_folder

# Words are runs of anything but ASCII white space; bytes.split() in Python cuts the same runs.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PART_ROWS = 256


def in_parts(values: pa.Array, rows: int = PART_ROWS) -> Iterator[list]:
    """The values of a batch, a few at a time. Spark bounds a batch by its bytes; this bounds what
    Python makes of it at once."""
    for start in range(0, len(values), rows):
        yield values.slice(start, rows).to_pylist()


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder; later reads survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Compute once into a Parquet table in the shared folder, for the larger tables. It is deleted
    when the session ends, since what is planned on it may be read until then."""
    path = scratch_path(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def free_name(df: DataFrame, wanted: str, *more: str) -> str:
    """A column name that the table does not have, whatever the case of its letters."""
    taken = {name.lower() for name in (*df.columns, *more)}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def row_hash(df: DataFrame) -> Column:
    """A hash of all values of a row, to order rows that are equal in all else that counts."""
    columns = (
        F.to_json(F.col(f"`{field.name}`")) if isinstance(field.dataType, MapType) else F.col(f"`{field.name}`")
        for field in df.schema
        if isinstance(field.dataType, MapType) or "map<" not in field.dataType.simpleString()
    )
    return F.xxhash64(*columns)


def sums_before(df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds, under the names given, the sums of these values over all rows that come before.

    The rows are dealt into slices by range of the order, so no task sorts more than a slice; sums
    of whole slices are then added, of which there are as many as shuffle partitions."""
    piece = free_name(df, "slice", *sums)
    inner = {name: free_name(df, f"{name}_value", piece, *sums) for name in sums}
    valued = df.withColumns({inner[name]: value for name, value in sums.items()})
    sliced = cut(valued.repartitionByRange(*order).withColumn(piece, F.spark_partition_id()))
    earlier = Window.partitionBy(piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    slices = Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(piece).agg(*(F.sum(inner[name]).alias(name) for name in sums))
    zero = F.lit(0).cast("bigint")
    starts = totals.select(
        piece, *(F.coalesce(F.sum(name).over(slices), zero).alias(name) for name in sums)
    )
    within = {name: F.coalesce(F.sum(inner[name]).over(earlier), zero) for name in sums}
    summed = sliced.withColumns({inner[name]: column for name, column in within.items()})
    return summed.join(starts, piece).select(
        *df.columns, *((F.col(inner[name]) + F.col(name)).alias(name) for name in sums)
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver, in a session whose batches are bounded."""
    return bound_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")
