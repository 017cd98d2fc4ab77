"""One query per operator, and one per dataset, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse import operators as op
from pulse.functions import as_boolean, as_timestamp, month_key, not_before, shift_hours, stamp
from pulse.plans import DATASETS, build_dataset, run, source_tables
from pulse.session import configure, scratch_path
from pulse.sinks import write_dataset
from pulse.sources import CountedTables, load_tables, sql_over
from workload.farm_tables import PARAMS, driver_table, farm_tables, label_table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF, WINDOW = PARAMS.as_of, PARAMS.window
SUMMER = datetime(2001, 6, 1)


def over(*names: str) -> Callable[[Callable[..., DataFrame]], Query]:
    """A query that takes these driver tables as arguments."""

    def wrap(build: Callable[..., DataFrame]) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return build(*(driver_table(spark, sf_dir, name) for name in names))

        return query

    return wrap


@over("customer")
def table_scan(customer):
    return customer.select("c_custkey", "c_name", "c_mktsegment")


@over("customer")
def threshold_filter(customer):
    return customer.filter(F.col("c_custkey") > 0).select("c_custkey", "c_name")


@over("lineitem", "orders")
def open_links(lineitem, orders):
    links = lineitem.select(
        F.col("l_partkey").alias("device_id"),
        F.col("l_orderkey").alias("carrier_id"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("removed"),
    )
    carriers = orders.select("o_orderkey", F.col("o_custkey").alias("site_id"))
    return op.open_links(links, carriers, {"carrier_id": "o_orderkey"}, "removed").select(
        "device_id", "site_id", "carrier_id"
    )


@over("customer", "nation", "region")
def geo_chain(customer, nation, region):
    return op.require_chain(
        customer.select("c_custkey", "c_nationkey"),
        [
            (nation, {"c_nationkey": "n_nationkey"}),
            (region, {"n_regionkey": "r_regionkey"}),
        ],
    ).select("c_custkey", "n_name", "r_name")


@over("documents", "labels")
def left_enrich(documents, labels):
    labels = labels.select("doc_id", "quality", F.lit(True).alias("present"))
    return op.lookup(documents.select("doc_id"), labels, "doc_id").select(
        "doc_id",
        "quality",
        op.link_state(F.col("present"), "linked", "unlinked").alias("link_state"),
    )


@over("part", "lineitem", "orders")
def many_links(part, lineitem, orders):
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    links = op.require(
        lineitem.filter((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")).select(
            F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_shipdate"
        ),
        urgent,
        {"l_orderkey": "o_orderkey"},
    )
    return op.attach_many(part.select("p_partkey", "p_name"), links, "p_partkey")


@over("lineitem")
def composite_join(lineitem):
    first = lineitem.groupBy("l_partkey", "l_suppkey").agg(F.min("l_shipdate").alias("first_ship"))
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return op.require(lines, first, ["l_partkey", "l_suppkey"], split_hot=True)


@over("lineitem")
def first_per_key(lineitem):
    return op.first_per_key(
        lineitem,
        ["l_orderkey"],
        [F.col("l_quantity").desc_nulls_last(), F.col("l_partkey").asc()],
        keep=["l_orderkey", "l_partkey", "l_quantity"],
    )


@over("lineitem")
def distinct_by(lineitem):
    return op.distinct_by(lineitem, ["l_suppkey"], "l_partkey", "n_devices")


@over("lineitem")
def distinct_by_non_null(lineitem):
    returned = lineitem.select(
        "l_suppkey", F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("device_id")
    )
    return op.distinct_by(returned, ["l_suppkey"], "device_id", "n_devices", skip_null=True)


@over("orders")
def recent_distinct(orders):
    return op.recent_distinct(
        orders, ["o_custkey"], "o_orderkey", "n_recent",
        time="o_orderdate", as_of=AS_OF, window=WINDOW,
    )


@over("lineitem")
def distinct_split(lineitem):
    return op.distinct_split(
        lineitem,
        ["l_suppkey"],
        "l_partkey",
        {"n_all": None, "n_recent": not_before(lineitem, "l_shipdate", SUMMER)},
    )


@over("orders")
def conditional_counts(orders):
    return op.conditional_counts(
        orders,
        ["o_custkey"],
        {
            "n_p": F.col("o_orderstatus") == "P",
            "n_f": F.col("o_orderstatus") == "F",
            "n_urgent": F.col("o_orderpriority") == "1-URGENT",
            "n_null": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).isNull(),
        },
    )


@over("customer", "orders")
def zero_filled_metric(customer, orders):
    recent = op.recent_distinct(
        orders, ["o_custkey"], "o_orderkey", "n_recent",
        time="o_orderdate", as_of=AS_OF, window=AS_OF - SUMMER,
    )
    return op.attach_metrics(
        customer.select("c_custkey"), [(recent, {"c_custkey": "o_custkey"})], ["n_recent"]
    )


@over("lineitem")
def recency_flag(lineitem):
    # Null for parts none of whose closed lines was accepted back.
    accepted = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")
    devices = lineitem.groupBy(F.col("l_partkey").alias("device_id")).agg(
        F.max(F.when(accepted, F.col("l_shipdate"))).alias("last_read")
    )
    flag = op.recency_flag(devices, "last_read", AS_OF, WINDOW, "active", "inactive")
    return devices.withColumn("status", flag)


@over("lineitem")
def class_ladder(lineitem):
    rank = F.nullif(F.col("l_linenumber") - 1, F.lit(3))
    return lineitem.select(
        "l_orderkey",
        "l_partkey",
        op.class_ladder(rank, {0: "none", 1: "first"}, "multi", null_label="unknown").alias("class"),
        op.class_ladder(rank, {0: "none", 1: "first"}, "multi").alias("plain_class"),
    )


@over("events")
def translate_labels(events):
    return op.translate_labels(
        events.select("event_id", "event_type"), "event_type", label_table(events.sparkSession),
        "label",
    )


@over("events")
def shift_and_month(events):
    local = shift_hours(F.col("ts"), 3)
    return events.filter(not_before(events, "ts", PARAMS.since)).select(
        "event_id", local.alias("local_ts"), month_key(local).alias("year_month")
    )


@over("orders")
def snapshot_stamp(orders):
    return orders.select("o_orderkey", stamp(AS_OF).alias("extraction_date"))


@over("events")
def safe_casts(events):
    kind = F.col("event_type")
    text = events.select(
        "event_id",
        F.when(kind == "click", "2024-02-03 04:05:06").otherwise(kind).alias("t"),
        F.when(kind == "view", "true").when(kind == "error", "0").when(kind != "signup", kind)
        .alias("b"),
    )
    return text.select(
        "event_id", as_timestamp(text, "t").alias("t"), as_boolean(text, "b").alias("b")
    )


def accesses_with_manager(events: DataFrame, customer: DataFrame) -> DataFrame:
    """Accesses to sites that have a manager, have none, or do not exist."""
    log = events.select(
        "user_id",
        (F.col("user_id") * 10 + F.col("event_id") % 20).alias("site_id"),
        month_key(shift_hours(F.col("ts"), 3)).alias("year_month"),
    )
    managers = customer.select(
        F.col("c_custkey").alias("site_id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.expr("c_custkey div 30 * 3")).alias(
            "manager_user_id"
        ),
    )
    return op.lookup(log, managers, "site_id").withColumn(
        "is_manager", op.flag_owner(F.col("manager_user_id"), F.col("user_id"))
    )


@over("events", "customer")
def null_safe_flag(events, customer):
    keys = ["user_id", "manager_user_id", "is_manager"]
    return accesses_with_manager(events, customer).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n")
    )


@over("events", "customer")
def split_counts(events, customer):
    return op.split_counts(
        accesses_with_manager(events, customer), ["year_month", "user_id"], "is_manager",
        when_true="n_manager", when_false="n_other",
    )


@over("events", "customer")
def distinct_members(events, customer):
    return op.column_values(accesses_with_manager(events, customer), "manager_user_id")


@over("events", "customer")
def semi_members(events, customer):
    members = accesses_with_manager(events, customer)
    return op.keep_members(
        customer.select("c_custkey", "c_name"), members, {"c_custkey": "manager_user_id"}
    )


@over("events")
def column_profile(events):
    return op.column_profile(events, ["event_type"])


@over("events")
def value_list(events):
    return op.column_values(events, "event_type")


@over("part")
def ordered_list(part):
    return part.select("p_brand", "p_partkey", "p_name").orderBy("p_brand", "p_partkey")


@over("orders", "lineitem")
def row_diff(orders, lineitem):
    mine = orders.select(F.col("o_orderkey").alias("key"))
    theirs = lineitem.select(F.col("l_orderkey").alias("key"))
    return op.row_diff(mine, theirs)


@over("lineitem")
def wide_profile(lineitem):
    columns = ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"]
    unsure = F.when(F.col("l_linestatus") == "O", F.col("l_returnflag"))
    return op.profile_rows(lineitem.withColumn("l_returnflag", unsure), columns)


@over("events")
def pivot_values(events):
    kind = F.when(F.col("event_type") != "signup", F.col("event_type"))
    return op.pivot_values(
        events.select("user_id", kind.alias("kind")),
        ["user_id"],
        "kind",
        {"click": "n_click", "view": "n_view", "missing": "n_missing", None: "n_null"},
        outside="other",
    )


@over("events")
def pivot_first(events):
    return op.pivot_values(
        events, ["user_id"], "event_type", ["click", "purchase"], op.first_where("event_id", ["ts"])
    )


@over("orders")
def sample_rows(orders):
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    return op.sample_rows(orders.select(*columns), 20, [F.col("o_totalprice").desc_nulls_last()])


@over("orders")
def sample_per_key(orders):
    columns = ["o_orderpriority", "o_orderkey", "o_totalprice"]
    return op.sample_per_key(
        orders.select(*columns), ["o_orderpriority"], 3, [F.col("o_totalprice").desc_nulls_last()]
    )


@over("customer", "supplier")
def schema_rows(customer, supplier):
    segment = F.col("c_mktsegment")
    left = customer.select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
        F.struct(segment.alias("segment"), F.array(F.lit(1)).alias("codes")).alias("more"),
    )
    right = supplier.select(
        F.col("s_suppkey").cast("int").alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.struct(F.col("s_name").alias("segment"), F.array(F.lit("a")).alias("codes")).alias("more"),
    )
    return op.compare_columns(left, right)


@over("customer", "orders")
def view_sql(customer, orders):
    return sql_over(
        {"customer": customer, "orders": orders},
        """
        select c_mktsegment, o_orderstatus, count(*) n_orders, max(o_totalprice) top_price
        from {customer} join {orders} on o_custkey = c_custkey
        group by c_mktsegment, o_orderstatus""",
    )


def observed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts seen while the tables were copied, checked against the copies."""
    configure(spark)
    names = ["customer", "orders", "lineitem"]
    counted = CountedTables(load_tables(spark, names, folder=sf_dir))
    folder = scratch_path(spark, "observed")
    for name, df in counted.tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    copies = {name: spark.read.parquet(f"{folder}/{name}.parquet").count() for name in names}
    rows = ", ".join(f"('{name}', {n}L)" for name, n in counted.check(copies).items())
    return spark.sql(f"select * from values {rows} as seen(table_name, n_rows)")


def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published as a folder, then as one file that is made from the folder it replaces."""
    configure(spark)
    orders = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    folder = scratch_path(spark, "sink")
    path = write_dataset(orders, folder, "orders")
    write_dataset(
        spark.read.parquet(path), folder, "orders", single_file=True, order_by=["o_orderkey"]
    )
    return spark.read.parquet(path)


@over("orders")
def csv_round_trip(orders):
    """All that CSV finds hard: nulls, nothing, quotes, line breaks, blanks, microseconds."""
    spark = orders.sparkSession
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 7
    note = (
        F.when(kind == 1, "").when(kind == 2, 'a "quoted", word').when(kind == 3, "two\nlines\r\n")
        .when(kind == 4, " blanks ").when(kind == 5, '\\"').when(kind == 6, F.col("o_orderpriority"))
    )
    rows = orders.select(
        key,
        note.alias("note"),
        F.when(kind != 0, F.col("o_totalprice")).alias("price"),
        F.when(kind != 1, F.col("o_totalprice") > 100_000).alias("large"),
        F.col("o_orderdate").cast("date").alias("day"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=(key % 1000) / 1e6))
        .alias("moment"),
    )
    path = write_dataset(rows, scratch_path(spark, "csv"), "orders", "csv", exact_times=True)
    return op.read_any(spark, path)


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every dataset in both formats, by a run that is started a second time at the end."""
    configure(spark)
    must, may = source_tables(DATASETS)
    tables = farm_tables(spark, sf_dir, must + may)
    out = scratch_path(spark, "run")
    # A source table in its own right, which three datasets read: derived once.
    collars = f"{scratch_path(spark, 'sources')}/collars.parquet"
    tables["collars"].write.parquet(collars)
    tables["collars"] = spark.read.parquet(collars)
    run(tables, PARAMS, out, only=["users", "users_active"], run_id="once")
    paths = run(tables, PARAMS, out, run_id="once")
    counts = [
        op.read_any(spark, path).agg(
            F.lit(name).alias("dataset"), F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n_rows")
        )
        for name, found in paths.items()
        for fmt, path in found.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def dataset_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        must, may = source_tables([name])
        return build_dataset(name, farm_tables(spark, sf_dir, must + may), PARAMS)

    return query


DATASET_KEYS = {
    "ds_device_status": "coleiras_reportando",
    "ds_linked_devices": "coleiras_vinculadas",
    "ds_animals": "animals",
    "ds_user_activity": "users_active",
    "ds_site_state": "farm_states",
    "ds_access_by_month": "contagem_acessos",
    "ds_user_directory": "users",
    "ds_sensor_list": "c_env_list",
}
assert set(DATASET_KEYS.values()) == set(DATASETS)

OPERATOR_QUERIES: dict[str, Query] = {
    "table_scan": table_scan,
    "threshold_filter": threshold_filter,
    "open_links": open_links,
    "geo_chain": geo_chain,
    "left_enrich": left_enrich,
    "many_links": many_links,
    "composite_join": composite_join,
    "first_per_key": first_per_key,
    "distinct_by": distinct_by,
    "distinct_by_non_null": distinct_by_non_null,
    "recent_distinct": recent_distinct,
    "distinct_split": distinct_split,
    "conditional_counts": conditional_counts,
    "zero_filled_metric": zero_filled_metric,
    "recency_flag": recency_flag,
    "class_ladder": class_ladder,
    "translate_labels": translate_labels,
    "shift_and_month": shift_and_month,
    "snapshot_stamp": snapshot_stamp,
    "safe_casts": safe_casts,
    "null_safe_flag": null_safe_flag,
    "split_counts": split_counts,
    "distinct_members": distinct_members,
    "semi_members": semi_members,
    "column_profile": column_profile,
    "value_list": value_list,
    "ordered_list": ordered_list,
    "row_diff": row_diff,
    "wide_profile": wide_profile,
    "pivot_values": pivot_values,
    "pivot_first": pivot_first,
    "sample_rows": sample_rows,
    "sample_per_key": sample_per_key,
    "schema_rows": schema_rows,
    "view_sql": view_sql,
    "observed_read": observed_read,
    "sink_parquet": sink_parquet,
    "csv_round_trip": csv_round_trip,
    "full_run": full_run,
}

QUERIES: dict[str, Query] = OPERATOR_QUERIES | {
    key: dataset_query(name) for key, name in DATASET_KEYS.items()
}
