"""SQL with the results the queries must have, for DuckDB over the driver's tables."""

from __future__ import annotations

from workload.farm_tables import FARM_SQL, with_farm_tables

AS_OF = "timestamp '2001-08-01 00:00:00'"
SINCE = "timestamp '2024-01-01 01:00:00'"
SUMMER = "timestamp '2001-06-01 00:00:00'"
FRESH = f"last_read >= {AS_OF} - interval '48' hour"
DEVICE_FLAG = f"case when {FRESH} then 'ativa' else 'inativa' end"

ACCESSES = """
  (select e.user_id, strftime(e.ts - interval '3' hour, '%Y-%m') year_month,
     m.manager_user_id, m.manager_user_id = e.user_id is_manager
   from events e left join (
     select c_custkey site_id,
       case when c_mktsegment <> 'BUILDING' then c_custkey // 30 * 3 end manager_user_id
     from customer
   ) m on m.site_id = e.user_id * 10 + e.event_id % 20) acc"""

TOP_BREED = """
  select animal_id, breed from (
    select *, row_number() over (
      partition by animal_id order by numerator desc nulls last, breed) place
    from animal_breed) ranked
  where place = 1"""

OPEN = """
  select k.collar_id, k.animal_id, a.farm_id
  from animal_collar k join animals a on a.id = k.animal_id where k.removal is null"""

MEMBER_ACCESSES = f"""
  select l."timestamp" - interval '3' hour acesso_timestamp, l.user_id, f.code farm_code,
    l.page, l.source, l.context_type, '2001-08-01' extraction_date
  from user_activities l
    join users u on u.id = l.user_id
    join farms f on f.id = l.context_id
    join farm_user m on m.user_id = u.id and m.farm_id = f.id
  where l."timestamp" >= {SINCE}"""

STATES = f"""
  select f.code, f.id, f.contract_status, f.deleted_at,
    f.contract_collars colares_contratados, f.contract_cow_baby_collars cowbaby_contratados,
    f.contract_c_envs cenvs_contradados, f.plan, f.ventilation_system sistema_ventilacao,
    f.system, c.name city, s.name state, s.abbreviation state_abbreviation, co.code country,
    comp.slug company_slug, p.name portfolio_name, u.name manager, u.id manager_user_id,
    coalesce(on_farm.n, 0) colares_na_fazenda, coalesce(sent.n, 0) colares_enviados,
    coalesce(worn.n, 0) colares_animais, coalesce(fresh.n, 0) colares_reportando,
    coalesce(herd.pregnant, 0) vacas_prenhe, coalesce(herd.near, 0) vacas_pre_parto,
    coalesce(herd.dry, 0) vacas_secas, coalesce(herd.lactating, 0) vacas_lactacao,
    coalesce(herd.heifers, 0) vacas_novilhas
  from farms f
    join farm_addresses fa on fa.id = f.address_id
    join cities c on c.id = fa.city_id
    join states s on s.id = c.state_id
    join countries co on co.id = s.country_id
    left join company_farm cf on cf.farm_id = f.id
    left join companies comp on comp.id = cf.company_id
    left join company_portfolio_farm pf on pf.farm_id = f.id
    left join company_portfolios p on p.id = pf.company_portfolio_id
    left join users u on u.id = p.responsible_id
    left join (select farm_id, count(distinct id) n from collars group by 1) on_farm
      on on_farm.farm_id = f.id
    left join (select farm_id, count(distinct collar_id) n from collar_farm group by 1) sent
      on sent.farm_id = f.id
    left join (select farm_id, count(distinct collar_id) n from animals
      where collar_id is not null group by 1) worn on worn.farm_id = f.id
    left join (select farm_id, count(distinct id) n from collars where {FRESH} group by 1) fresh
      on fresh.farm_id = f.id
    left join (select farm_id, count(case when status = 'pregnant' then 1 end) pregnant,
        count(case when status = 'pregnant-pre-delivery' then 1 end) near,
        count(case when production_status = 'dry' then 1 end) dry,
        count(case when production_status = 'lactating' then 1 end) lactating,
        count(case when total_deliveries is null then 1 end) heifers
      from animals group by 1) herd on herd.farm_id = f.id
  where f.code > 0"""

STATE_TABLES = [
    "farms", "farm_addresses", "cities", "states", "countries", "company_farm", "companies",
    "company_portfolio_farm", "company_portfolios", "users", "collars", "collar_farm", "animals",
]

ORACLES = {
    "table_scan": "select c_custkey, c_name, c_mktsegment from customer",
    "threshold_filter": "select c_custkey, c_name from customer where c_custkey > 0",
    "open_links": """
        select l_partkey device_id, o_custkey site_id, l_orderkey carrier_id
        from lineitem join orders on l_orderkey = o_orderkey
        where (case when l_linestatus = 'F' then l_shipdate end) is null""",
    "geo_chain": """
        select c_custkey, n_name, r_name
        from customer join nation on n_nationkey = c_nationkey
          join region on r_regionkey = n_regionkey""",
    "left_enrich": """
        select d.doc_id, l.quality,
          case when l.doc_id is null then 'unlinked' else 'linked' end link_state
        from documents d left join labels l on l.doc_id = d.doc_id""",
    "many_links": """
        select p_partkey, p_name, l_orderkey, l_shipdate
        from part left join (
          select l_partkey, l_orderkey, l_shipdate from lineitem
            join orders on o_orderkey = l_orderkey
          where l_linestatus = 'O' and l_returnflag = 'N' and o_orderpriority = '1-URGENT'
        ) k on l_partkey = p_partkey""",
    "composite_join": """
        select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, f.first_ship
        from lineitem l join (
          select l_partkey, l_suppkey, min(l_shipdate) first_ship from lineitem group by 1, 2
        ) f on f.l_partkey = l.l_partkey and f.l_suppkey = l.l_suppkey""",
    "first_per_key": """
        select l_orderkey, l_partkey, l_quantity from (
          select *, row_number() over (partition by l_orderkey
            order by l_quantity desc, l_partkey, l_suppkey, l_linenumber, l_extendedprice) rn
          from lineitem) t
        where rn = 1""",
    "distinct_by": """
        select l_suppkey, count(distinct l_partkey) n_devices from lineitem group by l_suppkey""",
    "distinct_by_non_null": """
        select l_suppkey, count(distinct k) n_devices from (
          select l_suppkey, case when l_returnflag <> 'N' then l_partkey end k from lineitem) t
        where k is not null group by l_suppkey""",
    "recent_distinct": f"""
        select o_custkey, count(distinct o_orderkey) n_recent from orders
        where o_orderdate >= {AS_OF} - interval '48' hour group by o_custkey""",
    "distinct_split": f"""
        select l_suppkey, count(distinct l_partkey) n_all,
          count(distinct case when l_shipdate >= {SUMMER} then l_partkey end) n_recent
        from lineitem group by l_suppkey""",
    "conditional_counts": """
        select o_custkey, count(case when o_orderstatus = 'P' then 1 end) n_p,
          count(case when o_orderstatus = 'F' then 1 end) n_f,
          count(case when o_orderpriority = '1-URGENT' then 1 end) n_urgent,
          count(case when nullif(o_orderpriority, '5-LOW') is null then 1 end) n_null
        from orders group by o_custkey""",
    "zero_filled_metric": f"""
        select c_custkey, coalesce(n, 0) n_recent from customer left join (
          select o_custkey, count(distinct o_orderkey) n from orders
          where o_orderdate >= {SUMMER} group by o_custkey) a on o_custkey = c_custkey""",
    "recency_flag": f"""
        select device_id, last_read,
          case when {FRESH} then 'active' else 'inactive' end status
        from (select l_partkey device_id,
            max(case when l_linestatus = 'F' and l_returnflag = 'A' then l_shipdate end) last_read
          from lineitem group by l_partkey) d""",
    "class_ladder": """
        select l_orderkey, l_partkey,
          case when k is null then 'unknown' when k = 0 then 'none' when k = 1 then 'first'
            else 'multi' end class,
          case when k = 0 then 'none' when k = 1 then 'first' else 'multi' end plain_class
        from (select l_orderkey, l_partkey, nullif(l_linenumber - 1, 3) k from lineitem) t""",
    "translate_labels": f"""
        select event_id, event_type, coalesce(target, event_type) label
        from events left join ({FARM_SQL["page_labels"]}) m on m.source = event_type""",
    "shift_and_month": f"""
        select event_id, ts - interval '3' hour local_ts,
          strftime(ts - interval '3' hour, '%Y-%m') year_month
        from events where ts >= {SINCE}""",
    "snapshot_stamp": "select o_orderkey, '2001-08-01' extraction_date from orders",
    "safe_casts": """
        select event_id,
          try_cast(case when event_type = 'click' then '2024-02-03 04:05:06' else event_type end
            as timestamp) t,
          try_cast(case event_type when 'view' then 'true' when 'error' then '0'
            when 'signup' then null else event_type end as boolean) b
        from events""",
    "null_safe_flag": f"""
        select user_id, manager_user_id, is_manager, count(*) n
        from {ACCESSES} group by user_id, manager_user_id, is_manager""",
    "split_counts": f"""
        select year_month, user_id, count(case when is_manager then 1 end) n_manager,
          count(case when not is_manager then 1 end) n_other
        from {ACCESSES} group by year_month, user_id""",
    "distinct_members": f"select distinct manager_user_id from {ACCESSES}",
    "semi_members": f"""
        select c_custkey, c_name from customer
        where c_custkey in (select manager_user_id from {ACCESSES})""",
    "column_profile": """
        select count(*) n_rows, count(distinct event_type) n_event_type from events""",
    "value_list": "select distinct event_type from events",
    "ordered_list": "select p_brand, p_partkey, p_name from part order by p_brand, p_partkey",
    "row_diff": """
        select key, count(a) n_left, count(b) n_right from (
          select o_orderkey key, 1 a, null b from orders
          union all select l_orderkey, null, 1 from lineitem) t
        group by key having count(a) <> count(b)""",
}

# The datasets over the farm tables: (tables, query, named subqueries).
FarmSql = tuple[list[str], str, dict[str, str]]


def farm_sql(tables: list[str], query: str, **more: str) -> FarmSql:
    return tables, query, more


DATASETS: dict[str, FarmSql] = {
    "ds_device_status": farm_sql(
        ["collars", "animal_collar", "animals", "farms"],
        f"""
        select c.id collar_id, c.code serial_coleira, c.last_read ultima_leitura,
          {DEVICE_FLAG} status_coleira,
          case when k.collar_id is null then 'sem_vinculo' else 'com_vinculo' end tem_vinculo,
          f.code farm_code, k.animal_id, '2001-08-01' extraction_date
        from collars c left join open_links k on k.collar_id = c.id
          left join farms f on f.id = k.farm_id""",
        open_links=OPEN,
    ),
    "ds_linked_devices": farm_sql(
        ["collars", "animal_collar", "animals", "farms", "animal_breed"],
        f"""
        select k.animal_id, k.collar_id, k.created_at data_vinculacao, k.removal data_remocao,
          a.earring brinco, f.code farm, c.code serial_coleira, c.last_read ultima_leitura,
          b.breed, case when k.removal is null then 'ativo' else 'inativo' end status_vinculo,
          {DEVICE_FLAG} status_coleira, '2001-08-01' extraction_date
        from animal_collar k join animals a on a.id = k.animal_id
          join collars c on c.id = k.collar_id join farms f on f.id = a.farm_id
          left join top_breed b on b.animal_id = a.id""",
        top_breed=TOP_BREED,
    ),
    "ds_animals": farm_sql(
        ["animals", "farms", "animal_breed"],
        """
        select f.code farm, a.id animal_id, a.earring brinco, a.birth data_nascimento,
          a.last_delivery ultima_ia, a.status, a.born_at_farm, a.mother_id, a.father_id,
          a.deleted_at, a.created_at, a.collar_id, a.health_status, a.last_reproduction_method,
          a.reproduction_methods_since_last_conception qtd_ia_pp, a.is_female,
          a.production_status, a.total_deliveries, b.breed, '2001-08-01' extraction_date,
          case when a.total_deliveries = 0 then 'Novilha' when a.total_deliveries = 1
            then 'Primipara' else 'Multípara' end status_reprodutivo
        from animals a join farms f on f.id = a.farm_id
          left join top_breed b on b.animal_id = a.id
        where try_cast(f.demo as boolean) = false""",
        top_breed=TOP_BREED,
    ),
    "ds_user_activity": farm_sql(
        ["user_activities", "users", "farms", "farm_user", "page_labels"],
        """
        select x.*, coalesce(p.target, x.page) page_traduzida
        from accesses x left join page_labels p on p.source = x.page""",
        accesses=MEMBER_ACCESSES,
    ),
    "ds_site_state": farm_sql(STATE_TABLES, STATES),
    "ds_access_by_month": farm_sql(
        [*STATE_TABLES, "user_activities", "farm_user"],
        """
        select year_month, user_id,
          count(case when manager_user_id = user_id then 1 end) "Contagem_Manager_True",
          count(case when manager_user_id <> user_id then 1 end) "Contagem_Manager_False"
        from merged where user_id in (select manager_user_id from merged)
        group by year_month, user_id""",
        accesses=MEMBER_ACCESSES,
        farm_states=STATES,
        merged="""
        select x.user_id, strftime(x.acesso_timestamp, '%Y-%m') year_month, s.manager_user_id
        from accesses x left join farm_states s on s.code = x.farm_code""",
    ),
    "ds_user_directory": farm_sql(
        ["users", "farm_user", "company_user"],
        """
        select user_id, name, farm_id, through_system, active, company_id from (
          select u.id user_id, u.name, m.farm_id, m.through_system, m.active, c.company_id,
            row_number() over (partition by u.id
              order by m.farm_id, m.through_system, m.active, c.company_id) place
          from users u left join farm_user m on m.user_id = u.id
            left join company_user c on c.user_id = u.id
          where u.deleted_at is null) t
        where place = 1""",
    ),
    "ds_sensor_list": farm_sql(
        ["c_envs", "farms"],
        """
        select f.code farm_code, f.id farm_id, e.id ce_id
        from c_envs e join farms f on f.id = e.farm_id order by f.code, f.id, e.id""",
    ),
}

ORACLES |= {
    key: with_farm_tables(tables, query, **more)
    for key, (tables, query, more) in DATASETS.items()
}

PROFILED = {
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "l_quantity": "l_quantity",
    "l_returnflag": "case when l_linestatus = 'O' then l_returnflag end",
    "l_shipdate": "l_shipdate",
}

ORACLES |= {
    "wide_profile": " union all ".join(
        f"""
        select '{name}' "column", cast(sum(n) as bigint) n_rows,
          cast(coalesce(sum(case when v is null then n end), 0) as bigint) n_null,
          count(v) n_distinct, coalesce(max(case when v is not null then n end), 0) n_top
        from (select {value} v, count(*) n from lineitem group by 1)"""
        for name, value in PROFILED.items()
    ),
    "pivot_values": """
        select user_id, count(case when kind = 'click' then 1 end) n_click,
          count(case when kind = 'view' then 1 end) n_view,
          count(case when kind = 'missing' then 1 end) n_missing,
          count(case when kind is null then 1 end) n_null,
          count(case when kind not in ('click', 'view', 'missing') then 1 end) other
        from (select user_id, nullif(event_type, 'signup') kind from events) group by user_id""",
    "pivot_first": """
        select user_id,
          arg_min(event_id, (ts, event_id)) filter (event_type = 'click') click,
          arg_min(event_id, (ts, event_id)) filter (event_type = 'purchase') purchase
        from events group by user_id""",
    "sample_rows": """
        select o_orderkey, o_custkey, o_totalprice from orders
        order by o_totalprice desc nulls last, o_orderkey, o_custkey limit 20""",
    "sample_per_key": """
        select o_orderpriority, o_orderkey, o_totalprice from orders
        qualify row_number() over (
          partition by o_orderpriority order by o_totalprice desc nulls last, o_orderkey) <= 3""",
    "schema_rows": """
        select f.*, n_left, n_right from (values
            ('key', 'bigint', 'int', 'type'), ('name', 'string', 'string', 'same'),
            ('balance', 'double', null, 'left'), ('nation', null, 'int', 'right'),
            ('more', 'struct', 'struct', 'same'), ('more.segment', 'string', 'string', 'same'),
            ('more.codes', 'array', 'array', 'same'), ('more.codes[]', 'int', 'string', 'type')
          ) f(path, left_type, right_type, status)
          left join (
            select unnest(['key', 'name', 'balance', 'more']) path,
              unnest([count(c_custkey), count(c_name),
                count(case when c_acctbal > 0 then 1 end), count(*)]) n_left
            from customer) a using (path)
          left join (
            select unnest(['key', 'name', 'nation', 'more']) path,
              unnest([count(s_suppkey), count(s_name), count(s_nationkey), count(*)]) n_right
            from supplier) b using (path)""",
    "view_sql": """
        select c_mktsegment, o_orderstatus, count(*) n_orders, max(o_totalprice) top_price
        from customer join orders on o_custkey = c_custkey
        group by c_mktsegment, o_orderstatus""",
    "observed_read": " union all ".join(
        f"select '{name}' table_name, count(*) n_rows from {name}"
        for name in ("customer", "orders", "lineitem")
    ),
    "sink_parquet": "select o_orderkey, o_custkey, o_totalprice from orders",
    "csv_round_trip": r"""
        select o_orderkey,
          case o_orderkey % 7 when 1 then '' when 2 then 'a "quoted", word'
            when 3 then 'two' || chr(10) || 'lines' || chr(13) || chr(10) when 4 then ' blanks '
            when 5 then '\"' when 6 then o_orderpriority end note,
          case when o_orderkey % 7 <> 0 then o_totalprice end price,
          case when o_orderkey % 7 <> 1 then o_totalprice > 100000 end large,
          cast(o_orderdate as date) "day",
          cast(o_orderdate as timestamp) + to_microseconds(o_orderkey % 1000) moment
        from orders""",
}

RUN_NAMES = {
    "ds_device_status": "coleiras_reportando",
    "ds_linked_devices": "coleiras_vinculadas",
    "ds_animals": "animals",
    "ds_user_activity": "users_active",
    "ds_site_state": "farm_states",
    "ds_access_by_month": "contagem_acessos",
    "ds_user_directory": "users",
    "ds_sensor_list": "c_env_list",
}

ORACLES["full_run"] = " union all ".join(
    f"select '{name}' dataset, unnest(['parquet', 'csv']) format, n n_rows "
    f"from (select count(*) n from ({ORACLES[key]}))"
    for key, name in RUN_NAMES.items()
)
