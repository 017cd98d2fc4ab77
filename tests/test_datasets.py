from datetime import datetime

from farm_fixture import PARAMS, ROWS, farm_tables
from pulse.plans import DATASETS, Params, build_dataset


def rows(df, *columns):
    return sorted(
        (tuple(row) for row in df.select(*columns).collect()),
        key=lambda row: tuple((value is None, value) for value in row),
    )


def build(spark, name, **changed):
    return build_dataset(name, farm_tables(spark, **changed), PARAMS)


def test_device_status(spark):
    df = build(spark, "coleiras_reportando")
    columns = ("collar_id", "status_coleira", "tem_vinculo", "farm_code", "animal_id")
    assert rows(df, *columns) == [
        (501, "ativa", "com_vinculo", 101, 11),
        (501, "ativa", "com_vinculo", 101, 12),
        (502, "ativa", "sem_vinculo", None, None),
        (503, "inativa", "sem_vinculo", None, None),
        (504, "inativa", "sem_vinculo", None, None),
    ]
    assert df.columns == [
        "collar_id", "serial_coleira", "ultima_leitura", "status_coleira", "tem_vinculo",
        "farm_code", "animal_id", "extraction_date",
    ]
    assert {row.extraction_date for row in df.collect()} == {"2025-03-10"}


def test_linked_devices(spark):
    df = build(spark, "coleiras_vinculadas")
    columns = ("animal_id", "collar_id", "farm", "breed", "status_vinculo", "status_coleira")
    assert rows(df, *columns) == [
        (11, 501, 101, "J", "ativo", "ativa"),
        (12, 501, 101, "G", "ativo", "ativa"),
        (14, 503, 102, None, "inativo", "inativa"),
    ]
    assert df.columns == [
        "animal_id", "collar_id", "data_vinculacao", "data_remocao", "brinco", "farm",
        "serial_coleira", "ultima_leitura", "breed", "status_vinculo", "status_coleira",
        "extraction_date",
    ]


def test_animals(spark):
    df = build(spark, "animals")
    assert rows(df, "farm", "animal_id", "breed", "status_reprodutivo") == [
        (101, 11, "J", "Novilha"), (101, 12, "G", "Primipara"), (101, 13, None, "Multípara"),
    ]
    assert df.columns == [
        "farm", "animal_id", "brinco", "data_nascimento", "ultima_ia", "status", "born_at_farm",
        "mother_id", "father_id", "deleted_at", "created_at", "collar_id", "health_status",
        "last_reproduction_method", "qtd_ia_pp", "is_female", "production_status",
        "total_deliveries", "breed", "extraction_date", "status_reprodutivo",
    ]


def test_user_activity(spark):
    df = build(spark, "users_active")
    columns = ("acesso_timestamp", "user_id", "farm_code", "page", "page_traduzida")
    assert rows(df, *columns) == [
        (datetime(2024, 12, 31, 22), 7, 101, "home", "inicio"),
        (datetime(2025, 3, 1, 7), 7, 101, "other", "other"),
        (datetime(2025, 3, 2, 7), 7, 102, "home", "inicio"),
        (datetime(2025, 3, 3, 7), 9, 101, None, None),
    ]
    assert df.columns == [
        "acesso_timestamp", "user_id", "farm_code", "page", "source", "context_type",
        "extraction_date", "page_traduzida",
    ]


def test_page_is_copied_without_labels(spark):
    tables = farm_tables(spark)
    del tables["page_labels"]
    df = build_dataset("users_active", tables, PARAMS)
    assert df.filter("not page <=> page_traduzida").count() == 0


def test_duplicate_memberships_multiply_accesses(spark):
    columns, members = ROWS["farm_user"]
    df = build(spark, "users_active", farm_user=(columns, members + [(7, 2), (7, 2)]))
    assert df.filter("farm_code = 102").count() == 3


def test_context_type_filter_is_optional(spark):
    columns = "user_id context_id context_type timestamp page"
    log = [(7, 1, "farm", "2025-03-01 10:00:00", "a"), (7, 1, "company", "2025-03-01 10:00:00", "b")]
    tables = farm_tables(spark, user_activities=(columns, log))
    assert build_dataset("users_active", tables, PARAMS).count() == 2
    only_farms = Params(as_of=PARAMS.as_of, context_type="farm")
    assert rows(build_dataset("users_active", tables, only_farms), "page") == [("a",)]


def test_site_state(spark):
    df = build(spark, "farm_states")
    columns = (
        "code", "portfolio_name", "manager_user_id", "colares_na_fazenda", "colares_enviados",
        "colares_animais", "colares_reportando", "vacas_prenhe", "vacas_pre_parto", "vacas_secas",
        "vacas_lactacao", "vacas_novilhas",
    )
    assert rows(df, *columns) == [
        (101, "P1", 7, 2, 2, 1, 2, 1, 1, 1, 2, 1),
        (101, "P2", 8, 2, 2, 1, 2, 1, 1, 1, 2, 1),
        (102, None, None, 1, 0, 1, 0, 0, 0, 1, 0, 0),
    ]
    assert rows(df, "code", "city", "state", "country", "company_slug", "manager") == [
        (101, "C1", "S1", "BR", "x", "Ana"), (101, "C1", "S1", "BR", "x", "Bea"),
        (102, "C1", "S1", "BR", None, None),
    ]
    assert df.columns == [
        "code", "id", "contract_status", "deleted_at", "colares_contratados",
        "cowbaby_contratados", "cenvs_contradados", "plan", "sistema_ventilacao", "system",
        "city", "state", "state_abbreviation", "country", "company_slug", "portfolio_name",
        "manager", "manager_user_id", "colares_na_fazenda", "colares_enviados",
        "colares_animais", "colares_reportando", "vacas_prenhe", "vacas_pre_parto",
        "vacas_secas", "vacas_lactacao", "vacas_novilhas",
    ]


ACCESS_COUNTS = ("year_month", "user_id", "Contagem_Manager_True", "Contagem_Manager_False")


def test_access_by_month(spark):
    df = build(spark, "contagem_acessos")
    assert tuple(df.columns) == ACCESS_COUNTS
    assert rows(df, *ACCESS_COUNTS) == [("2024-12", 7, 1, 1), ("2025-03", 7, 1, 1)]


def test_manager_with_null_flags_only_counts_zero(spark):
    columns, log = ROWS["user_activities"]
    log = [row for row in log if row[:2] != (7, 1)]
    members = ROWS["farm_user"][1] + [(8, 1)]
    df = build(
        spark, "contagem_acessos",
        user_activities=(columns, log), farm_user=("user_id farm_id", members),
    )
    assert rows(df, *ACCESS_COUNTS) == [("2025-03", 7, 0, 0), ("2025-03", 8, 1, 1)]


def test_user_directory(spark):
    df = build(spark, "users")
    assert rows(df, "user_id", "name", "farm_id", "company_id") == [
        (7, "Ana", 1, 1), (8, "Bea", None, None),
    ]
    assert df.columns == ["user_id", "name", "farm_id", "through_system", "active", "company_id"]


def test_sensor_list_is_sorted(spark):
    df = build(spark, "c_env_list")
    assert [tuple(row) for row in df.collect()] == [(101, 1, 32), (102, 2, 31)]


def test_text_that_does_not_parse_is_null(spark):
    farms = [(1, 101, "maybe", 1)] + ROWS["farms"][1][1:]
    collars = [(501, "A", "bad", 1)] + ROWS["collars"][1][1:]
    changed = {"farms": (ROWS["farms"][0], farms), "collars": (ROWS["collars"][0], collars)}
    assert build(spark, "animals", **changed).count() == 0
    status = build(spark, "coleiras_reportando", **changed).filter("collar_id = 501")
    assert rows(status, "ultima_leitura", "status_coleira") == [(None, "inativa")] * 2


def test_building_runs_no_job(spark):
    tables = farm_tables(spark)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    for name in DATASETS:
        build_dataset(name, tables, PARAMS)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_times_with_a_zone_become_utc():
    assert Params(as_of=datetime.fromisoformat("2025-03-10T09:00:00-03:00")).as_of == PARAMS.as_of
