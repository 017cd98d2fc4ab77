"""The datasets against SQL over small random farm tables, full of nulls, duplicates and misses."""

import random
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import pyarrow as pa
import pytest

from farm_fixture import ROWS, SCHEMAS
from pulse.plans import build_dataset
from workload.farm_tables import PARAMS
from workload.oracles import DATASETS
from workload.queries import DATASET_KEYS

KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
TIMES = {"last_read", "removal", "created_at", "birth", "last_delivery", "timestamp"}
KEYED = {  # tables whose id is a key
    "animals", "farms", "collars", "users", "farm_addresses", "cities", "states", "countries",
    "companies", "company_portfolios", "c_envs",
}
BOUNDS = {"timestamp": PARAMS.since, "last_read": PARAMS.as_of - PARAMS.window}


def value(rng, name, kind, is_time):
    if rng.random() < 0.15:
        return None
    if is_time:
        around = BOUNDS.get(name, datetime(2020, 1, 31))
        return around + timedelta(hours=rng.choice([-30 * 24, -1, 0, 1, 2, 3, 40 * 24]))
    if name == "demo":
        return rng.choice(["true", "false", "false", "maybe"])
    if name == "status":
        return rng.choice(["pregnant", "pregnant-pre-delivery", "open"])
    if name == "production_status":
        return rng.choice(["dry", "lactating", "other"])
    if name in ("page", "source"):
        return rng.choice("abcde")
    if name == "deleted_at":
        return rng.choice([None, None, "2020-01-01 00:00:00"])
    if name == "code" and kind == "long":
        return rng.randint(-1, 4)
    return {
        "long": lambda: rng.randint(0, 6),
        "double": lambda: rng.choice([0.25, 0.5, 0.75]),
        "boolean": lambda: rng.random() < 0.5,
        "string": lambda: rng.choice(["x", "y", "z"]),
    }[kind]()


def random_table(rng, name):
    fields = [field.split() for field in SCHEMAS[name].split(", ")]
    times = TIMES | ({"deleted_at"} if name == "animals" else set())
    size = rng.randint(15, 30)
    ids = list(range(7)) if name in KEYED else [None] * size
    rows = [
        {
            column: i if name in KEYED and column == "id" else value(rng, column, kind, column in times)
            for column, kind in fields
        }
        for i in ids
    ]
    if name == "page_labels":
        rows = [{"source": source, "target": rng.choice("pqr")} for source in "abc"]
    types = [
        (column, pa.timestamp("us") if column in times else KINDS[kind]) for column, kind in fields
    ]
    return pa.Table.from_pylist(rows, schema=pa.schema(types))


@pytest.fixture(scope="module", params=range(4))
def tables(request):
    rng = random.Random(request.param)
    return {name: random_table(rng, name) for name in ROWS}


@pytest.mark.parametrize("key", list(DATASETS))
def test_dataset_matches_sql(spark, tables, key):
    duck = duckdb.connect()
    for name, table in tables.items():
        duck.register(name, table)
    needed, query, more = DATASETS[key]
    named = ", ".join(f"{name} as ({sql})" for name, sql in more.items())
    expected = duck.execute((f"with {named} " if named else "") + query)
    columns = [field[0] for field in expected.description]
    frames = {name: spark.createDataFrame(table) for name, table in tables.items()}
    # Arrow times without a zone arrive as timestamp_ntz.
    df = build_dataset(DATASET_KEYS[key], frames, PARAMS)
    assert sorted(df.columns) == sorted(columns)
    found = Counter(map(tuple, df.select(*columns).collect()))
    assert found == Counter(map(tuple, expected.fetchall()))
