"""Plan shapes, and hot keys that hold a third of all rows."""

import re
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from farm_fixture import PARAMS, farm_tables
from pulse import operators as op
from pulse.plans import build_dataset, run
from pulse.plans.datasets import accesses
from pulse.session import hashed_joins
from workload.farm_tables import PARAMS as DRIVER_PARAMS
from workload.farm_tables import farm_tables as driver_farm_tables
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

# No broadcast, and thresholds under which a few kilobytes count as a skewed partition.
AT_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


N = 24_000


def hot(modulus, phase=0):
    """A key that is 1 for a third of the rows."""
    return F.when(F.col("i") % 3 == phase, 1).otherwise(F.col("i") % modulus + 2).cast("long")


def log(i, column=None):
    """Text that does not compress, so that partition sizes follow row counts."""
    return F.sha2(F.concat_ws("-", F.lit(column), i.cast("string")), 256)


@pytest.fixture(scope="module")
def skewed(spark):
    """Farm tables where one animal, collar, farm, user or page holds a third of the big ones."""
    def base(n=N):
        return spark.range(0, n, 1, 8).withColumnRenamed("id", "i")
    tables = farm_tables(spark)
    i = F.col("i")

    def fill(name, df):
        for column in tables[name].columns:
            if column not in df.columns:
                df = df.withColumn(column, F.lit(None).cast(tables[name].schema[column].dataType))
        return df.select(tables[name].columns)

    ids = base(400).select((i + 1).alias("id"), "i")
    made = {
        "farms": ids.select("id", (i + 1).alias("code"), F.lit("false").alias("demo"),
                            (i + 1).alias("address_id")),
        "farm_addresses": ids.select("id", F.lit(1).cast("long").alias("city_id")),
        "animals": base().select(
            (i + 1).alias("id"), hot(300).alias("farm_id"), log(i, "a").alias("earring"),
            F.when(i % 2 == 0, "pregnant").alias("status"), (i % 500).alias("collar_id"),
            (i % 3).alias("total_deliveries")),
        "collars": ids.select("id", log(i, "c").alias("code"), hot(300).alias("farm_id"),
                              F.lit("2025-03-10 00:00:00").alias("last_read")),
        "animal_collar": base().select(
            hot(20_000).alias("animal_id"), hot(300, 1).alias("collar_id"),
            F.when(i % 2 == 0, "2025-02-01 00:00:00").alias("removal"),
            F.lit("2025-01-01 00:00:00").alias("created_at")),
        "animal_breed": base().select(
            hot(20_000).alias("animal_id"), log(i % 5, "b").alias("breed"),
            (i % 100).cast("double").alias("numerator")),
        "user_activities": base().select(
            hot(300).alias("user_id"), hot(300).alias("context_id"),
            F.lit("2025-03-01 00:00:00").alias("timestamp"),
            hot(300, 1).cast("string").alias("page"),
            log(i, "s").alias("source")),
        "users": ids.select("id", log(i, "u").alias("name")),
        "farm_user": ids.select(F.col("id").alias("user_id"), F.col("id").alias("farm_id")),
        "company_farm": base().select(hot(300).alias("farm_id"), i.alias("company_id")),
        "companies": base().select(i.alias("id"), log(i, "k").alias("slug")),
        "company_portfolio_farm": ids.select(
            F.col("id").alias("farm_id"), F.lit(1).cast("long").alias("company_portfolio_id")),
        "page_labels": ids.select(
            (i + 2).cast("string").alias("source"), log(i, "l").alias("target")),
        "collar_farm": base().select(hot(300).alias("farm_id"), i.alias("collar_id")),
    }
    stored = {}
    for name, df in made.items():
        stored[name] = fill(name, df).persist()
    yield tables | stored
    for df in stored.values():
        df.unpersist()


# The joins of each dataset whose left side has a hot key, by their first key.
HOT_JOINS = {
    "coleiras_reportando": ["animal_id", "farm_id", "collar_id"],
    "coleiras_vinculadas": ["farm_id", "animal_id", "collar_id"],
    "animals": ["farm_id"],
    "users_active": ["user_id", "page"],
    "farm_states": ["farm_id", "farm_id"],
}


@pytest.mark.parametrize("name", list(HOT_JOINS))
def test_hot_keys_are_split(spark, skewed, name):
    def digest():
        df = build_dataset(name, skewed, PARAMS)
        columns = sorted(df.columns)
        hashed = df.withColumn("__digest", F.xxhash64(*columns).cast("decimal(38,0)"))
        return hashed.agg(F.count(F.lit(1)), F.sum("__digest"))

    expected = digest().collect()
    with settings(spark, AT_SCALE):
        result = digest()
        assert result.collect() == expected
        split = re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", plan_of(result))
    assert not Counter(HOT_JOINS[name]) - Counter(split)


@pytest.mark.parametrize("name", ["coleiras_vinculadas", "farm_states"])
def test_hot_keys_are_split_where_a_run_hashes(spark, skewed, name):
    expected = build_dataset(name, skewed, PARAMS)
    with settings(spark, AT_SCALE), hashed_joins(spark):
        df = build_dataset(name, skewed, PARAMS)
        n = df.count()
        n = df.count()
        result = df.groupBy(*df.columns).count()
        result.collect()
        joins = re.findall(r"(\w+Join)(\(skew=true\))? \[(\w+)#", plan_of(result))
    split = [key for _, skew, key in joins if skew]
    assert not Counter(HOT_JOINS[name]) - Counter(split)
    assert "ShuffledHashJoin" in {kind for kind, *_ in joins}
    assert n == expected.count()


def test_first_per_key_limits_before_the_shuffle(spark, skewed):
    df = op.first_per_key(skewed["animal_breed"], ["animal_id"], [F.col("numerator").desc()])
    df.collect()
    plan = plan_of(df)
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "BroadcastExchange" not in plan


def exchanges_above(plan, marker):
    """How often the rows of the scan whose line has `marker` are shuffled on their way up."""
    lines = [line for line in plan.split("\n") if line.strip(" :")]
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    (scan,) = [n for n, line in enumerate(lines) if "FileScan" in line and marker in line]
    count, level = 0, depth[scan]
    for n in range(scan, -1, -1):
        if depth[n] < level:
            level = depth[n]
            count += "Exchange" in lines[n]
    return count


def test_the_access_log_is_shuffled_once(spark):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        tables = driver_farm_tables(spark, SF_DIR)
        plan = plan_of(accesses(tables, DRIVER_PARAMS))
    assert exchanges_above(plan, "event_id") == 1


def test_monthly_accesses_are_read_once(spark):
    plan = plan_of(QUERIES["ds_access_by_month"](spark, SF_DIR))
    assert sum("FileScan" in line and "event_id" in line for line in plan.split("\n")) == 1


def test_links_are_shuffled_by_animal_and_by_collar_only(spark):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(QUERIES["ds_linked_devices"](spark, SF_DIR))
    assert exchanges_above(plan, "l_linestatus") == 2


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["shift_and_month"](spark, SF_DIR)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_site_state_reads_each_metric_table_once(spark):
    df = QUERIES["ds_site_state"](spark, SF_DIR)
    scans = [line for line in plan_of(df).split("\n") if "FileScan" in line]
    assert sum("o_orderpriority" in line for line in scans) == 1
    assert sum("p_partkey" in line for line in scans) == 1


def test_a_sorted_list_spreads_a_hot_farm(spark, skewed):
    sensors = spark.range(0, N, 1, 8).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 300 + 2)
        .cast("long").alias("farm_id")
    )
    with settings(spark, AT_SCALE):
        df = build_dataset("c_env_list", skewed | {"c_envs": sensors}, PARAMS)
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in sizes) == N
    assert max(row["count"] for row in sizes) < N / 4


def test_the_full_run_holds_under_skew(spark, skewed, tmp_path):
    with settings(spark, AT_SCALE):
        paths = run(skewed, PARAMS, str(tmp_path), ["parquet"], ["users_active", "contagem_acessos"])
        stored = spark.read.parquet(paths["contagem_acessos"]["parquet"])
    planned = build_dataset("contagem_acessos", skewed, PARAMS)
    assert op.row_diff(stored, planned).count() == 0
