from pulse.sources.tables import (
    CountedTables, load_table, load_tables, named_views, read_parquet, register_views, sql_over,
)

__all__ = [
    "CountedTables", "load_table", "load_tables", "named_views", "read_parquet", "register_views",
    "sql_over",
]
