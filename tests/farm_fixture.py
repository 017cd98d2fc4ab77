"""The 19 source tables of FIXTURES.md with their edge-case rows. Times and flags are text."""

from datetime import datetime

import pyarrow as pa

from pulse.plans import Params

AS_OF = datetime(2025, 3, 10, 12)
PARAMS = Params(as_of=AS_OF)

SCHEMAS = {
    "animals": "id long, farm_id long, earring string, birth string, last_delivery string, "
    "status string, born_at_farm boolean, mother_id long, father_id long, deleted_at string, "
    "created_at string, collar_id long, health_status string, last_reproduction_method string, "
    "reproduction_methods_since_last_conception long, is_female boolean, "
    "production_status string, total_deliveries long",
    "farms": "id long, code long, demo string, address_id long, contract_status string, "
    "deleted_at string, contract_collars long, contract_cow_baby_collars long, "
    "contract_c_envs long, plan string, ventilation_system string, system string",
    "collars": "id long, code string, last_read string, farm_id long",
    "animal_collar": "animal_id long, collar_id long, removal string, created_at string",
    "animal_breed": "animal_id long, breed string, numerator double",
    "user_activities": "user_id long, context_id long, context_type string, timestamp string, "
    "page string, source string",
    "users": "id long, name string, deleted_at string",
    "farm_user": "user_id long, farm_id long, through_system string, active boolean",
    "company_user": "user_id long, company_id long",
    "farm_addresses": "id long, city_id long",
    "cities": "id long, name string, state_id long",
    "states": "id long, name string, abbreviation string, country_id long",
    "countries": "id long, code string",
    "company_farm": "farm_id long, company_id long",
    "companies": "id long, slug string",
    "company_portfolio_farm": "farm_id long, company_portfolio_id long",
    "company_portfolios": "id long, name string, responsible_id long",
    "collar_farm": "farm_id long, collar_id long",
    "c_envs": "id long, farm_id long",
    "page_labels": "source string, target string",
}

# table -> (columns given, rows); the other columns are null.
ROWS = {
    "farms": ("id code demo address_id", [
        (1, 101, "false", 1), (2, 102, "true", 2), (3, 0, "false", 3), (4, 104, None, None)]),
    "farm_addresses": ("id city_id", [(1, 1), (2, 1), (3, 1)]),
    "cities": ("id name state_id", [(1, "C1", 1)]),
    "states": ("id name abbreviation country_id", [(1, "S1", "S1", 1)]),
    "countries": ("id code", [(1, "BR")]),
    "animals": ("id farm_id collar_id status production_status total_deliveries", [
        (11, 1, 501, "pregnant", "dry", 0),
        (12, 1, None, "open", "lactating", 1),
        (13, 1, 501, "pregnant-pre-delivery", "lactating", None),
        (14, 2, 503, "open", "dry", 3),
        (15, 4, None, None, None, 2)]),
    "collars": ("id code last_read farm_id", [
        (501, "A", "2025-03-10 00:00:00", 1), (502, "B", "2025-03-08 12:00:00", 1),
        (503, "C", "2025-03-08 11:59:59", 2), (504, "D", None, None)]),
    "animal_collar": ("animal_id collar_id removal", [
        (11, 501, None), (12, 501, None), (14, 503, "2025-02-01 00:00:00"), (99, 504, None)]),
    "animal_breed": ("animal_id breed numerator", [
        (11, "H", 0.5), (11, "J", 0.75), (12, "H", None), (12, "G", 0.25)]),
    "companies": ("id slug", [(1, "x")]),
    "company_farm": ("farm_id company_id", [(1, 1)]),
    "company_portfolios": ("id name responsible_id", [(1, "P1", 7), (2, "P2", 8)]),
    "company_portfolio_farm": ("farm_id company_portfolio_id", [(1, 1), (1, 2)]),
    "users": ("id name deleted_at", [
        (7, "Ana", None), (8, "Bea", None), (9, "Cid", "2025-01-01 00:00:00")]),
    "farm_user": ("user_id farm_id", [(7, 1), (7, 2), (9, 1)]),
    "company_user": ("user_id company_id", [(7, 1)]),
    "collar_farm": ("farm_id collar_id", [(1, 501), (1, 501), (1, 505)]),
    "user_activities": ("user_id context_id timestamp page", [
        (7, 1, "2025-01-01 01:00:00", "home"), (7, 1, "2025-03-01 10:00:00", "other"),
        (7, 2, "2025-03-02 10:00:00", "home"), (9, 1, "2025-03-03 10:00:00", None),
        (8, 1, "2025-03-03 10:00:00", "home"), (7, 1, "2024-12-31 23:59:59", "home")]),
    "c_envs": ("id farm_id", [(31, 2), (32, 1), (33, 99)]),
    "page_labels": ("source target", [("home", "inicio")]),
}


ARROW_TYPES = {
    "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(),
}


def frame(spark, table, columns, rows):
    schema = pa.schema(
        [(name, ARROW_TYPES[kind]) for name, kind in map(str.split, SCHEMAS[table].split(", "))]
    )
    given = [dict(zip(columns.split(), row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(given, schema=schema))


def farm_tables(spark, **changed):
    """All tables; `changed` replaces the rows of some, given as (columns, rows)."""
    return {name: frame(spark, name, *(ROWS | changed)[name]) for name in ROWS}
