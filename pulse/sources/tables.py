"""Source tables, from a catalog database or from a folder of Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession

from pulse.operators.profile import observed, require_rows


def load_table(
    spark: SparkSession, table: str, *, database: str | None = None, folder: str | None = None
) -> DataFrame:
    """A catalog table, or `<folder>/<table>.parquet` when a folder is given."""
    if folder is not None:
        return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
    return spark.read.table(f"{database}.{table}" if database else table)


def load_tables(
    spark: SparkSession,
    tables: Iterable[str],
    *,
    database: str | None = None,
    folder: str | None = None,
    persist: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Lazy DataFrames by name. Nothing is cached unless asked for: a cached table is read whole
    and stops filters and column choice from reaching its files."""
    loaded = {}
    for table in tables:
        df = load_table(spark, table, database=database, folder=folder)
        loaded[table] = df.persist() if table in persist else df
    return loaded


def read_parquet(spark: SparkSession, path: str) -> tuple[DataFrame, Observation]:
    """A Parquet file or folder; its row count comes with the first action."""
    return observed(spark.read.parquet(path), path)


class CountedTables:
    """Tables whose rows are counted by the first action that reads each of them whole.

    `rows` gives the counts after that; `check` compares them with the counts expected, such as those
    of a manifest, and with what `strict` asks of empty tables."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables, self.seen = {}, {}
        for name, df in tables.items():
            self.tables[name], self.seen[name] = observed(df, name)

    def rows(self, name: str) -> int:
        return self.seen[name].get["n_rows"]

    def check(self, expected: Mapping[str, int] | None = None, *, strict: bool = False) -> dict[str, int]:
        found = {name: require_rows(self.rows(name), name, strict=strict) for name in self.tables}
        wrong = {
            name: (n, found.get(name)) for name, n in (expected or {}).items() if found.get(name) != n
        }
        if wrong:
            raise ValueError(f"rows expected and read differ: {wrong}")
        return found


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """Temporary views, and their names by table."""
    names = {name: f"{prefix}{name}" for name in tables}
    for name, df in tables.items():
        df.createOrReplaceTempView(names[name])
    return names


@contextmanager
def named_views(tables: Mapping[str, DataFrame]) -> Iterator[dict[str, str]]:
    """Views under names of this use alone, so that two uses in one session never meet; they go at
    the end. What was planned over them stays valid, since a plan holds the tables themselves."""
    names = register_views(tables, f"v_{uuid.uuid4().hex}_")
    try:
        yield names
    finally:
        for df, view in zip(tables.values(), names.values(), strict=True):
            df.sparkSession.catalog.dropTempView(view)


def sql_over(tables: Mapping[str, DataFrame], query: str) -> DataFrame:
    """A query in SQL; `{name}` in it stands for the view of a table."""
    spark = next(iter(tables.values())).sparkSession
    with named_views(tables) as names:
        return spark.sql(query.format(**names))
