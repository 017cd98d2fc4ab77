"""The farm source tables, derived from the whole of the driver's tables.

Farms and users are customers, animals are orders, collars are parts, links and breed shares are
line items, accesses are events, sensors are suppliers. Every table grows with the driver's data.
`FARM_SQL` says the same in SQL for the check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.plans import Params
from pulse.sources import load_table

PARAMS = Params(as_of=datetime(2001, 8, 1), since=datetime(2024, 1, 1, 1))

NATION_PORTFOLIO = 1_000_000_000

PAGE_LABELS = [("click", "clique"), ("view", "visualizacao"), ("purchase", "compra")]


Base = Callable[[str], DataFrame]


def label_table(spark: SparkSession) -> DataFrame:
    pairs = ", ".join(f"('{source}', '{target}')" for source, target in PAGE_LABELS)
    return spark.sql(f"select * from values {pairs} as pairs(source, target)")


def last_reads(lineitem: DataFrame) -> DataFrame:
    """The last ship date per part."""
    return lineitem.groupBy(F.col("l_partkey").alias("device_id")).agg(
        F.max("l_shipdate").alias("last_read")
    )


def farms(base: Base) -> DataFrame:
    segment = F.col("c_mktsegment")
    return base("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("code"),
        F.when(segment == "BUILDING", "true")
        .when(segment == "FURNITURE", "maybe")
        .when(segment != "MACHINERY", "false")
        .alias("demo"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("address_id"),
        segment.alias("contract_status"),
        F.lit(None).cast("string").alias("deleted_at"),
        F.floor("c_acctbal").alias("contract_collars"),
        F.col("c_nationkey").alias("contract_cow_baby_collars"),
        F.floor(F.col("c_acctbal") / 1000).alias("contract_c_envs"),
        segment.alias("plan"),
        F.substring("c_name", 1, 8).alias("ventilation_system"),
        F.col("c_name").alias("system"),
    )


def animals(base: Base) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return base("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("farm_id"),
        priority.alias("earring"),
        F.col("o_orderdate").alias("birth"),
        F.when(status == "F", F.col("o_orderdate")).alias("last_delivery"),
        F.when(status == "P", "pregnant")
        .when(status == "F", "pregnant-pre-delivery")
        .otherwise("open")
        .alias("status"),
        (F.col("o_totalprice") >= 250000).alias("born_at_farm"),
        (F.col("o_orderkey") - 1).alias("mother_id"),
        F.lit(None).cast("bigint").alias("father_id"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
        F.col("o_orderdate").alias("created_at"),
        F.when(priority != "5-LOW", F.expr("o_orderkey div 7")).alias("collar_id"),
        status.alias("health_status"),
        priority.alias("last_reproduction_method"),
        F.col("o_custkey").alias("reproduction_methods_since_last_conception"),
        (status != "O").alias("is_female"),
        F.when(priority == "1-URGENT", "dry")
        .when(priority.isin("2-HIGH", "3-MEDIUM"), "lactating")
        .alias("production_status"),
        F.nullif(F.col("o_custkey") % 4, F.lit(3)).alias("total_deliveries"),
    )


def collars(base: Base) -> DataFrame:
    reads = last_reads(base("lineitem"))
    return base("part").join(reads, F.col("device_id") == F.col("p_partkey"), "left").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("code"),
        F.when(F.col("p_type") != "SMALL", F.col("last_read")).alias("last_read"),
        F.expr("p_partkey div 2").alias("farm_id"),
    )


def animal_collar(base: Base) -> DataFrame:
    shipped = F.col("l_shipdate")
    return base("lineitem").select(
        # Small lines point at an animal that does not exist.
        F.when(F.col("l_quantity") < 3, -1 - F.col("l_orderkey"))
        .otherwise(F.col("l_orderkey"))
        .alias("animal_id"),
        F.col("l_partkey").alias("collar_id"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), None)
        .otherwise(shipped)
        .alias("removal"),
        shipped.alias("created_at"),
    )


def animal_breed(base: Base) -> DataFrame:
    return base("lineitem").select(
        F.col("l_orderkey").alias("animal_id"),
        F.col("l_partkey").cast("string").alias("breed"),
        F.nullif(F.col("l_quantity"), F.lit(50.0)).alias("numerator"),
    )


def user_activities(base: Base) -> DataFrame:
    return base("events").select(
        "user_id",
        (F.col("user_id") * 10 + F.col("event_id") % 20).alias("context_id"),
        F.lit("farm").alias("context_type"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("page"),
        F.col("props").alias("source"),
    )


def users(base: Base) -> DataFrame:
    return base("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "2020-01-01 00:00:00").alias("deleted_at"),
    )


def farm_user(base: Base) -> DataFrame:
    return base("orders").filter(F.col("o_orderstatus") == "P").select(
        F.expr("o_custkey div 10").alias("user_id"),
        F.col("o_custkey").alias("farm_id"),
        F.col("o_orderpriority").alias("through_system"),
        (F.col("o_totalprice") >= 250000).alias("active"),
    )


def company_user(base: Base) -> DataFrame:
    people = base("customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    return people.select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("company_id")
    ).union(base("supplier").select("s_suppkey", "s_nationkey"))


def farm_addresses(base: Base) -> DataFrame:
    return base("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("city_id")
    )


def cities(base: Base) -> DataFrame:
    return base("nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("state_id"),
    )


def states(base: Base) -> DataFrame:
    return base("region").select(
        F.col("r_regionkey").alias("id"),
        F.col("r_name").alias("name"),
        F.substring("r_name", 1, 2).alias("abbreviation"),
        F.col("r_regionkey").alias("country_id"),
    )


def countries(base: Base) -> DataFrame:
    return base("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("code"))


def company_farm(base: Base) -> DataFrame:
    sites = base("customer").filter(F.col("c_mktsegment") != "BUILDING")
    return sites.select(
        F.col("c_custkey").alias("farm_id"), F.col("c_nationkey").alias("company_id")
    ).union(base("supplier").select("s_suppkey", "s_nationkey"))


def companies(base: Base) -> DataFrame:
    return base("nation").filter(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").alias("id"), F.lower("n_name").alias("slug")
    )


def nation_portfolio(column: str) -> Column:
    return F.col(column) + F.lit(NATION_PORTFOLIO).cast("bigint")


def company_portfolio_farm(base: Base) -> DataFrame:
    customer = base("customer")
    return customer.select(
        F.col("c_custkey").alias("farm_id"),
        F.expr("c_custkey div 30").alias("company_portfolio_id"),
    ).union(
        customer.filter(F.col("c_mktsegment") == "MACHINERY").select(
            "c_custkey", nation_portfolio("c_nationkey")
        )
    )


def company_portfolios(base: Base) -> DataFrame:
    """One per thirty customers, without a responsible user where many are builders, and one per
    nation."""
    groups = base("customer").groupBy(F.expr("c_custkey div 30").alias("id")).agg(
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("n_building")
    )
    return groups.select(
        "id",
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("name"),
        F.when(F.col("n_building") < 8, F.col("id") * 3).alias("responsible_id"),
    ).union(
        base("nation").select(
            nation_portfolio("n_nationkey"), "n_name", F.col("n_regionkey").cast("bigint")
        )
    )


def collar_farm(base: Base) -> DataFrame:
    lines = base("lineitem").select("l_orderkey", F.col("l_partkey").alias("collar_id"))
    return base("orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("farm_id"), "collar_id"
    )


def c_envs(base: Base) -> DataFrame:
    return base("supplier").select(
        F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 16).alias("farm_id")
    )


def page_labels(base: Base) -> DataFrame:
    return label_table(SparkSession.active())


FARM_TABLES: dict[str, Callable[[Base], DataFrame]] = {
    table.__name__: table
    for table in (
        animals, farms, collars, animal_collar, animal_breed, user_activities, users, farm_user,
        company_user, farm_addresses, cities, states, countries, company_farm, companies,
        company_portfolio_farm, company_portfolios, collar_farm, c_envs, page_labels,
    )
}


@cache
def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver's table: its files are listed once per session, no rows are kept."""
    return load_table(spark, name, folder=sf_dir)


@cache
def farm_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FARM_TABLES[name](partial(driver_table, spark, sf_dir))


def farm_tables(
    spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """The named tables, or all of them."""
    return {name: farm_table(spark, sf_dir, name) for name in names or FARM_TABLES}


FARM_SQL = {
    "farms": """
        select c_custkey id, c_custkey code,
          case c_mktsegment when 'BUILDING' then 'true' when 'FURNITURE' then 'maybe'
            when 'MACHINERY' then null else 'false' end demo,
          case when c_acctbal >= 0 then c_custkey end address_id,
          c_mktsegment contract_status, cast(null as varchar) deleted_at,
          cast(floor(c_acctbal) as bigint) contract_collars,
          c_nationkey contract_cow_baby_collars,
          cast(floor(c_acctbal / 1000) as bigint) contract_c_envs,
          c_mktsegment plan, substr(c_name, 1, 8) ventilation_system, c_name system
        from customer""",
    "animals": """
        select o_orderkey id, o_custkey farm_id, o_orderpriority earring, o_orderdate birth,
          case when o_orderstatus = 'F' then o_orderdate end last_delivery,
          case o_orderstatus when 'P' then 'pregnant' when 'F' then 'pregnant-pre-delivery'
            else 'open' end status,
          o_totalprice >= 250000 born_at_farm, o_orderkey - 1 mother_id,
          cast(null as bigint) father_id, cast(null as timestamp) deleted_at,
          o_orderdate created_at,
          case when o_orderpriority <> '5-LOW' then o_orderkey // 7 end collar_id,
          o_orderstatus health_status, o_orderpriority last_reproduction_method,
          o_custkey reproduction_methods_since_last_conception,
          o_orderstatus <> 'O' is_female,
          case when o_orderpriority = '1-URGENT' then 'dry'
            when o_orderpriority in ('2-HIGH', '3-MEDIUM') then 'lactating' end production_status,
          nullif(o_custkey % 4, 3) total_deliveries
        from orders""",
    "collars": """
        select p_partkey id, p_name code, case when p_type <> 'SMALL' then last_read end last_read,
          p_partkey // 2 farm_id
        from part left join (
          select l_partkey, max(l_shipdate) last_read from lineitem group by l_partkey
        ) reads on l_partkey = p_partkey""",
    "animal_collar": """
        select case when l_quantity < 3 then -1 - l_orderkey else l_orderkey end animal_id,
          l_partkey collar_id,
          case when l_linestatus = 'O' and l_returnflag = 'N' then null else l_shipdate end removal,
          l_shipdate created_at
        from lineitem""",
    "animal_breed": """
        select l_orderkey animal_id, cast(l_partkey as varchar) breed,
          nullif(l_quantity, 50) numerator
        from lineitem""",
    "user_activities": """
        select user_id, user_id * 10 + event_id % 20 context_id, 'farm' context_type,
          ts "timestamp", event_type page, props source
        from events""",
    "users": """
        select c_custkey id, c_name name,
          case when c_mktsegment = 'HOUSEHOLD' then '2020-01-01 00:00:00' end deleted_at
        from customer""",
    "farm_user": """
        select o_custkey // 10 user_id, o_custkey farm_id, o_orderpriority through_system,
          o_totalprice >= 250000 active
        from orders where o_orderstatus = 'P'""",
    "company_user": """
        select c_custkey user_id, c_nationkey company_id from customer
          where c_mktsegment = 'AUTOMOBILE'
        union all select s_suppkey, s_nationkey from supplier""",
    "farm_addresses": "select c_custkey id, c_nationkey city_id from customer",
    "cities": "select n_nationkey id, n_name name, n_regionkey state_id from nation",
    "states": """
        select r_regionkey id, r_name name, substr(r_name, 1, 2) abbreviation,
          r_regionkey country_id
        from region""",
    "countries": "select r_regionkey id, r_name code from region",
    "company_farm": """
        select c_custkey farm_id, c_nationkey company_id from customer
          where c_mktsegment <> 'BUILDING'
        union all select s_suppkey, s_nationkey from supplier""",
    "companies": "select n_nationkey id, lower(n_name) slug from nation where n_regionkey <> 0",
    "company_portfolio_farm": f"""
        select c_custkey farm_id, c_custkey // 30 company_portfolio_id from customer
        union all select c_custkey, c_nationkey + {NATION_PORTFOLIO} from customer
          where c_mktsegment = 'MACHINERY'""",
    "company_portfolios": f"""
        select id, 'P' || cast(id as varchar) name,
          case when n_building < 8 then id * 3 end responsible_id
        from (select c_custkey // 30 id, count(case when c_mktsegment = 'BUILDING' then 1 end)
          n_building from customer group by 1) g
        union all select n_nationkey + {NATION_PORTFOLIO}, n_name, n_regionkey from nation""",
    "collar_farm": """
        select o_custkey farm_id, l_partkey collar_id
        from orders join lineitem on l_orderkey = o_orderkey""",
    "c_envs": "select s_suppkey id, s_suppkey * 16 farm_id from supplier",
    "page_labels": " union all ".join(
        f"select '{source}' source, '{target}' target" for source, target in PAGE_LABELS
    ),
}


def with_farm_tables(tables: list[str], query: str, **more: str) -> str:
    """`query` behind the definitions of these tables and of the named subqueries in `more`."""
    parts = {name: FARM_SQL[name] for name in tables} | more
    return "with " + ", ".join(f"{name} as ({sql})" for name, sql in parts.items()) + query
