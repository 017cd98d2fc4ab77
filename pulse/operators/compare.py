"""Comparison of two stored datasets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from pulse.sinks.files import csv_description, csv_read_options


def read_any(
    spark: SparkSession, path: str, schema: StructType | None = None, *, multi_line: bool = False
) -> DataFrame:
    """Read a Parquet or CSV file or folder, told apart by the end of its name.

    A CSV output of this package reads back with the schema and format kept beside it. Other CSV
    files have text columns unless a schema is given; `multi_line` lets their quoted values hold line
    breaks, which keeps a file from being split among tasks."""
    if not path.rstrip("/").endswith(".csv"):
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    kept = csv_description(spark, path)
    if kept is not None:
        kept_schema, options = kept
        schema = kept_schema if schema is None else schema
        multi_line = multi_line or any(isinstance(f.dataType, StringType) for f in kept_schema)
    else:
        options = csv_read_options(StructType() if schema is None else schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if multi_line:
        # A line ends where the writer ended it, whatever breaks the values hold.
        reader = reader.options(multiLine=True, lineSep="\n")
    return reader.options(**options).csv(path)


def shape(df: DataFrame) -> tuple[int, int]:
    """Rows and columns."""
    return df.count(), len(df.columns)


def schema_diff(left: DataFrame, right: DataFrame) -> tuple[set[str], set[str]]:
    """Column names only on the left, and only on the right."""
    ours, theirs = set(left.columns), set(right.columns)
    return ours - theirs, theirs - ours


def type_rows(kind: DataType, nullable: bool, path: str = "") -> Iterator[tuple[str, str, bool]]:
    """Path, type and nullability of every field, element, key and value inside a type."""
    if path:
        yield path, kind.typeName() if kind.simpleString().endswith(">") else kind.simpleString(), nullable
    if isinstance(kind, StructType):
        for field in kind:
            yield from type_rows(field.dataType, field.nullable, f"{path}.{field.name}" if path else field.name)
    elif isinstance(kind, ArrayType):
        yield from type_rows(kind.elementType, kind.containsNull, f"{path}[]")
    elif isinstance(kind, MapType):
        yield from type_rows(kind.keyType, False, f"{path}[key]")
        yield from type_rows(kind.valueType, kind.valueContainsNull, f"{path}[value]")


def schema_rows(left: StructType, right: StructType) -> list[tuple]:
    """(path, left_type, right_type, status) of all fields of two schemas, however deep: `same`,
    `type`, `nullable` (only that differs), `left` or `right` (only there)."""
    ours = {path: found for path, *found in type_rows(left, False)}
    theirs = {path: found for path, *found in type_rows(right, False)}
    result = []
    for path in sorted(ours.keys() | theirs.keys()):
        a, b = ours.get(path), theirs.get(path)
        if a is None or b is None:
            status = "right" if a is None else "left"
        else:
            status = "same" if a == b else "type" if a[0] != b[0] else "nullable"
        result.append((path, a and a[0], b and b[0], status))
    return result


def compare_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per field of either schema, as in `schema_rows`, with the number of values that are
    not null on each side for top-level columns. Each side is read once, and only for the counts."""
    rows = schema_rows(left.schema, right.schema)

    def filled(df: DataFrame, name: str) -> DataFrame:
        counts = df.agg(*(F.count(F.col(f"`{column}`")).alias(f"c{n}") for n, column in enumerate(df.columns)))
        pairs = [
            F.struct(F.lit(column).alias("path"), F.col(f"c{n}").alias(name))
            for n, column in enumerate(df.columns)
        ]
        return counts.select(F.inline(F.array(*pairs)))

    fields = left.sparkSession.createDataFrame(
        rows, "path string, left_type string, right_type string, status string"
    )
    return fields.join(filled(left, "n_left"), "path", "left").join(
        filled(right, "n_right"), "path", "left"
    )


def row_diff(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that do not occur equally often on both sides, with their two counts.

    One grouping of the two sides together: copies of a row are counted before the shuffle, and
    each side is read once.
    """
    columns = list(left.columns if columns is None else columns)
    both = (
        left.select(*columns, F.lit(1).alias("__left"), F.lit(0).alias("__right"))
        .unionByName(right.select(*columns, F.lit(0).alias("__left"), F.lit(1).alias("__right")))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("__left").alias("n_left"), F.sum("__right").alias("n_right"))
        .filter(F.col("n_left") != F.col("n_right"))
    )
