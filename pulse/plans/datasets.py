"""The eight reporting datasets, each a lazy plan over the source tables and the parameters.

Joins are ordered so that the largest table of a dataset is shuffled as rarely as possible, and
every table is cut to the columns in use before it is joined. The names of source and output
columns are fixed values, shared with the writers of the tables and the readers of the datasets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.functions import (
    as_boolean, as_long, as_timestamp, month_key, not_before, shift_hours, stamp,
)
from pulse.operators import (
    attach_many, attach_metrics, class_ladder, conditional_counts, cover, distinct_by,
    distinct_split, first_per_key, flag_owner, link_state, link_status, lookup, member_counts,
    open_links, recency_flag, require, require_chain, translate_labels,
)
from pulse.plans.params import Params

Tables = Mapping[str, DataFrame]


def pick(df: DataFrame, *same: str, **renamed: str) -> DataFrame:
    """Columns under their own names, then `new="old"` ones."""
    return df.select(*same, *(F.col(old).alias(new) for new, old in renamed.items()))


def top_breed(breeds: DataFrame) -> DataFrame:
    """The breed with the largest share per animal; equal shares go to the first name."""
    return first_per_key(
        breeds,
        ["animal_id"],
        [F.col("numerator").desc_nulls_last()],
        keep=["animal_id", "breed"],
    )


def collar_state(collars: DataFrame, params: Params) -> DataFrame:
    """Collars with their last reading and whether it is recent."""
    words = params.words
    status = recency_flag(
        collars, "last_read", params.as_of, params.window,
        words.device_active, words.device_inactive,
    )
    return collars.select(
        F.col("id").alias("collar_id"),
        F.col("code").alias("serial_coleira"),
        as_timestamp(collars, "last_read").alias("ultima_leitura"),
        status.alias("status_coleira"),
    )


def device_status(tables: Tables, params: Params) -> DataFrame:
    """D1: one row per collar and open link, or one for a collar without any."""
    links = open_links(
        pick(tables["animal_collar"], "animal_id", "collar_id", "removal"),
        pick(tables["animals"], "farm_id", animal_id="id"),
        "animal_id",
        removed="removal",
    )
    # Farms are looked up on the link side: collars without a link carry no null farm to a join.
    farms = pick(tables["farms"], farm_id="id", farm_code="code")
    links = lookup(links, farms, "farm_id").drop("farm_id")
    collars = collar_state(tables["collars"], params)
    return attach_many(collars, links, "collar_id").select(
        *collars.columns,
        link_state(F.col("animal_id"), params.words.linked, params.words.unlinked).alias(
            "tem_vinculo"
        ),
        "farm_code",
        "animal_id",
        stamp(params.as_of).alias("extraction_date"),
    )


def linked_devices(tables: Tables, params: Params) -> DataFrame:
    """D2: one row per link, open or closed."""
    links = tables["animal_collar"]
    links = links.select(
        "animal_id",
        "collar_id",
        as_timestamp(links, "created_at").alias("data_vinculacao"),
        as_timestamp(links, "removal").alias("data_remocao"),
        # From the source column: text that is no time still is a removal.
        link_status(
            F.col("removal"), params.words.link_active, params.words.link_inactive
        ).alias("status_vinculo"),
    )
    # Farm and breed are looked up per animal, so the links are shuffled by animal and by collar
    # only.
    herd = pick(tables["animals"], "farm_id", animal_id="id", brinco="earring")
    herd = lookup(herd, top_breed(tables["animal_breed"]), "animal_id")
    herd = require(herd, pick(tables["farms"], farm_id="id", farm="code"), "farm_id")
    linked = require(links, herd, "animal_id", split_hot=True)
    return require(linked, collar_state(tables["collars"], params), "collar_id").select(
        "animal_id", "collar_id", "data_vinculacao", "data_remocao", "brinco", "farm",
        "serial_coleira", "ultima_leitura", "breed", "status_vinculo", "status_coleira",
        stamp(params.as_of).alias("extraction_date"),
    )


def animal_list(tables: Tables, params: Params) -> DataFrame:
    """D3: animals of farms known not to be demo farms, with their parity class."""
    source, farms, words = tables["animals"], tables["farms"], params.words
    herd = source.select(
        "farm_id",
        F.col("id").alias("animal_id"),
        F.col("earring").alias("brinco"),
        as_timestamp(source, "birth").alias("data_nascimento"),
        as_timestamp(source, "last_delivery").alias("ultima_ia"),
        "status", "born_at_farm", "mother_id", "father_id",
        as_timestamp(source, "deleted_at").alias("deleted_at"),
        as_timestamp(source, "created_at").alias("created_at"),
        "collar_id", "health_status", "last_reproduction_method",
        F.col("reproduction_methods_since_last_conception").alias("qtd_ia_pp"),
        "is_female", "production_status", "total_deliveries",
    )
    real_farms = farms.filter(as_boolean(farms, "demo") == F.lit(False))
    own = [name for name in herd.columns if name != "farm_id"]
    herd = require(herd, pick(real_farms, farm_id="id", farm="code"), "farm_id")
    return lookup(herd, top_breed(tables["animal_breed"]), "animal_id").select(
        "farm",
        *own,
        "breed",
        stamp(params.as_of).alias("extraction_date"),
        class_ladder(
            F.col("total_deliveries"), words.parity_steps, words.parity_default, words.parity_null
        ).alias("status_reprodutivo"),
    )


def accesses(tables: Tables, params: Params) -> DataFrame:
    """Page accesses by members of the accessed farm, once per membership.

    Memberships, users and farms are joined to each other first, so the access log is shuffled
    once, on user and farm together.
    """
    log = tables["user_activities"]
    members = require_chain(
        pick(tables["farm_user"], "user_id", "farm_id"),
        [
            (pick(tables["users"], user_id="id"), "user_id"),
            (pick(tables["farms"], farm_id="id", farm_code="code"), "farm_id"),
        ],
    )
    log = log.filter(not_before(log, "timestamp", params.since))
    if params.context_type is not None:
        log = log.filter(F.col("context_type") == params.context_type)
    log = log.select(
        # The bound holds for the time as logged; the shift comes after it.
        shift_hours(as_timestamp(log, "timestamp"), params.shift_hours).alias("acesso_timestamp"),
        "user_id", "context_id", "page", "source", "context_type",
    )
    return require(log, members, {"user_id": "user_id", "context_id": "farm_id"}).select(
        "acesso_timestamp", "user_id", "farm_code", "page", "source", "context_type",
        stamp(params.as_of).alias("extraction_date"),
    )


def user_activity(tables: Tables, params: Params) -> DataFrame:
    """D4: accesses with the translated page, from the optional table `page_labels`."""
    return translate_labels(
        accesses(tables, params), "page", tables.get("page_labels"), "page_traduzida"
    )


# The zero-filled counts of the farm profile, in output order.
FARM_METRICS = [
    "colares_na_fazenda", "colares_enviados", "colares_animais", "colares_reportando",
    "vacas_prenhe", "vacas_pre_parto", "vacas_secas", "vacas_lactacao", "vacas_novilhas",
]


def farm_metrics(tables: Tables, params: Params) -> list[tuple[DataFrame, str]]:
    """Counts per farm, one pass over each of the three tables they come from."""
    collars, sent, herd = tables["collars"], tables["collar_farm"], tables["animals"]
    fresh = not_before(collars, "last_read", params.as_of - params.window)
    on_farm = distinct_split(
        collars, ["farm_id"], "id", {"colares_na_fazenda": None, "colares_reportando": fresh}
    )
    by_status = conditional_counts(
        herd,
        ["farm_id"],
        {
            "vacas_prenhe": F.col("status") == "pregnant",
            "vacas_pre_parto": F.col("status") == "pregnant-pre-delivery",
            "vacas_secas": F.col("production_status") == "dry",
            "vacas_lactacao": F.col("production_status") == "lactating",
            "vacas_novilhas": F.col("total_deliveries").isNull(),
        },
        F.count_distinct("collar_id").alias("colares_animais"),
    )
    sent = distinct_by(sent, ["farm_id"], "collar_id", "colares_enviados")
    return [(on_farm, "farm_id"), (sent, "farm_id"), (by_status, "farm_id")]


def site_state(tables: Tables, params: Params) -> DataFrame:
    """D5: one row per farm, company and portfolio, with the farm's profile and counts.

    The profile has one row per farm. Companies and portfolios, of which a farm may have any
    number, are covered for all farms, joined to each other, and then to the profile.
    """
    farms = tables["farms"]
    farms = farms.filter(as_long(farms, "code") > 0)
    geography = [
        (pick(tables["farm_addresses"], "city_id", address_id="id"), "address_id"),
        (pick(tables["cities"], "state_id", city_id="id", city="name"), "city_id"),
        (
            pick(
                tables["states"], "country_id", state_id="id", state="name",
                state_abbreviation="abbreviation",
            ),
            "state_id",
        ),
        (pick(tables["countries"], country_id="id", country="code"), "country_id"),
    ]
    profile = pick(
        farms, "code", "address_id", "contract_status", "deleted_at", "plan", "system",
        farm_id="id", colares_contratados="contract_collars",
        cowbaby_contratados="contract_cow_baby_collars", cenvs_contradados="contract_c_envs",
        sistema_ventilacao="ventilation_system",
    )
    profile = require_chain(profile, geography)
    profile = attach_metrics(profile, farm_metrics(tables, params), FARM_METRICS)

    companies = lookup(
        pick(tables["company_farm"], "farm_id", "company_id"),
        pick(tables["companies"], company_id="id", company_slug="slug"),
        "company_id",
    ).drop("company_id")
    portfolios = lookup(
        pick(tables["company_portfolio_farm"], "farm_id", portfolio_id="company_portfolio_id"),
        pick(
            tables["company_portfolios"], "responsible_id", portfolio_id="id",
            portfolio_name="name",
        ),
        "portfolio_id",
    ).drop("portfolio_id")
    people = pick(
        tables["users"], responsible_id="id", manager="name", manager_user_id="id"
    )
    portfolios = lookup(portfolios, people, "responsible_id").drop("responsible_id")

    farm_keys = pick(farms, farm_id="id")
    owned = require(
        cover(companies, farm_keys, "farm_id"), cover(portfolios, farm_keys, "farm_id"), "farm_id"
    )
    return require(owned, profile, "farm_id", split_hot=True).select(
        "code", F.col("farm_id").alias("id"), "contract_status", "deleted_at",
        "colares_contratados", "cowbaby_contratados", "cenvs_contradados", "plan",
        "sistema_ventilacao", "system", "city", "state", "state_abbreviation", "country",
        "company_slug", "portfolio_name", "manager", "manager_user_id", *FARM_METRICS,
    )


def access_by_month(activity: DataFrame, states: DataFrame) -> DataFrame:
    """D6: accesses per month and user to farms of their own and of others, for users who manage
    an accessed farm.

    Both sides are counted down to their keys before they are joined; the counts multiply to the
    number of joined rows. The joined rows give both the counts and the managers, so the accesses
    are read once.
    """
    log = activity.groupBy(
        month_key(F.col("acesso_timestamp")).alias("year_month"), "user_id", "farm_code"
    ).agg(F.count(F.lit(1)).alias("n_accesses"))
    managers = states.groupBy(F.col("code").alias("farm_code"), "manager_user_id").agg(
        F.count(F.lit(1)).alias("n_states")
    )
    merged = lookup(log, managers, "farm_code").select(
        "year_month",
        "user_id",
        "manager_user_id",
        flag_owner(F.col("manager_user_id"), F.col("user_id")).alias("manager_acess"),
        (F.col("n_accesses") * F.coalesce(F.col("n_states"), F.lit(1))).alias("n"),
    )
    return member_counts(
        merged, ["year_month"], "user_id", "manager_user_id", "manager_acess", "n",
        when_true="Contagem_Manager_True", when_false="Contagem_Manager_False",
    )


def user_directory(tables: Tables, params: Params) -> DataFrame:
    """D7: one row per user not deleted, with the first farm and the first company."""
    users = tables["users"]
    users = pick(users.filter(F.col("deleted_at").isNull()), "name", user_id="id")
    farm_columns = ["farm_id", "through_system", "active"]
    farm = first_per_key(
        tables["farm_user"],
        ["user_id"],
        [F.col("farm_id").asc_nulls_last()],
        keep=["user_id", *farm_columns],
    )
    company = first_per_key(
        tables["company_user"],
        ["user_id"],
        [F.col("company_id").asc_nulls_last()],
        keep=["user_id", "company_id"],
    )
    return lookup(lookup(users, farm, "user_id"), company, "user_id").select(
        "user_id", "name", *farm_columns, "company_id"
    )


def sensor_list(tables: Tables, params: Params) -> DataFrame:
    """D8: sensors of known farms, sorted. The sensor closes the order, so the rows of a large
    farm can be spread over several tasks."""
    return (
        require(
            pick(tables["c_envs"], "farm_id", ce_id="id"),
            pick(tables["farms"], farm_id="id", farm_code="code"),
            "farm_id",
        )
        .select("farm_code", "farm_id", "ce_id")
        .orderBy("farm_code", "farm_id", "ce_id")
    )


@dataclass(frozen=True)
class Dataset:
    """`tables` are read by the builder itself, `uses` are other datasets it is given first."""

    file: str
    tables: tuple[str, ...]
    build: Callable[..., DataFrame]
    uses: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()


# Dataset names and output file names.
DATASETS: dict[str, Dataset] = {
    "coleiras_reportando": Dataset(
        "page_coleiras_reportando",
        ("collars", "animal_collar", "animals", "farms"),
        device_status,
    ),
    "coleiras_vinculadas": Dataset(
        "page_coleiras_vinculadas",
        ("animal_collar", "animals", "collars", "farms", "animal_breed"),
        linked_devices,
    ),
    "animals": Dataset("page_animals", ("animals", "farms", "animal_breed"), animal_list),
    "users_active": Dataset(
        "users_active",
        ("user_activities", "users", "farms", "farm_user"),
        user_activity,
        optional=("page_labels",),
    ),
    "farm_states": Dataset(
        "farm_states",
        (
            "farms", "farm_addresses", "cities", "states", "countries", "company_farm",
            "companies", "company_portfolio_farm", "company_portfolios", "users", "collars",
            "collar_farm", "animals",
        ),
        site_state,
    ),
    "contagem_acessos": Dataset(
        "contagem_acessos_por_usuario", (), access_by_month, uses=("users_active", "farm_states")
    ),
    "users": Dataset("users", ("users", "farm_user", "company_user"), user_directory),
    "c_env_list": Dataset(
        "c_env_list", ("c_envs", "farms"), sensor_list,
        order_by=("farm_code", "farm_id", "ce_id"),
    ),
}


def build_dataset(
    name: str, tables: Tables, params: Params, ready: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The plan of one dataset. Datasets it uses come from `ready` or are planned in place."""
    ready = ready or {}
    dataset = DATASETS[name]
    if not dataset.uses:
        return dataset.build(tables, params)
    used = [
        ready[use] if use in ready else build_dataset(use, tables, params)
        for use in dataset.uses
    ]
    return dataset.build(*used)


def source_tables(names: Iterable[str]) -> tuple[list[str], list[str]]:
    """Tables these datasets need, and tables they take where they exist."""
    wanted = [DATASETS[use] for name in names for use in (*DATASETS[name].uses, name)]
    must = dict.fromkeys(table for dataset in wanted for table in dataset.tables)
    may = dict.fromkeys(table for dataset in wanted for table in dataset.optional)
    return list(must), list(may)
