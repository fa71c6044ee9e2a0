"""DuckDB SQL that computes every registered query independently of Spark.

Tables ``orders lineitem part events`` are views over the same parquet files. Hubs and links use
their closed form for in-order loads (each key's first load; NULL keys once per load).
Satellites have no closed form: the SQL unrolls the loads, one level per load, and each level
applies the rule in the reference's own shape (rank over the target rows of the batch's keys,
ties kept), over the target accumulated so far.
"""

from __future__ import annotations

from vaultweave.functions.hashing import NULL_TOKEN, SEPARATOR, sentinel
from vaultweave.plans.catalog import DIRTY_TARGETS, INCREMENTAL, RERUN, RERUN_TARGETS, YEARS_TARGETS
from vaultweave.plans.specs import DWL, FP, HubSpec, LinkSpec, SatSpec, StageSpec, VaultSpec

# Loads the satellite SQL unrolls. They are numbered from the dates in the data; the SQL raises an error
# when the data holds more, so no load is ever left out.
ORACLE_LOADS = 16

ENTITY_SQL = {
    "payment": """
        select o_custkey as user_id, o_orderpriority as pay_doc_type, o_orderkey as pay_doc_num,
               'FL-' || cast(o_custkey % 750 as varchar) as account,
               '+' || cast(o_custkey * 10 + o_orderkey % 2 as varchar) as phone,
               substr(cast(o_orderdate as varchar), 1, 7) as billing_period,
               o_orderdate as pay_date, cast(o_totalprice as decimal(10,2)) as "sum"
        from orders""",
    "billing": """
        select o_custkey as user_id, substr(cast(l_shipdate as varchar), 1, 7) as billing_period,
               p_type as service, p_brand as tariff, cast(l_extendedprice as decimal(10,2)) as "sum",
               l_shipdate as created_at
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "issue": """
        select cast(o_custkey as int) as user_id, l_shipdate as start_time,
               l_shipdate + interval 2 day as end_time, 'return ' || p_type as title,
               'line ' || cast(l_linenumber as varchar) || ' status ' || l_linestatus as description,
               p_brand as service
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "traffic": """
        select user_id, ts as timerequest, regexp_extract(props, '([0-9]+)', 1) as device_id,
               '10.0.0.' || cast(event_id % 4 as varchar) as device_ip_addr,
               cast(floor(value * 10) as int) as bytes_sent, cast(floor(value * 100) as int) as bytes_received
        from events""",
}

STG_SQL = {
    "payment": """select user_id, pay_doc_type, pay_doc_num, account, phone, billing_period,
                         cast(pay_date as varchar) as pay_date, cast("sum" as varchar) as "sum" from payment""",
    "billing": """select user_id, billing_period, service, tariff, cast("sum" as varchar) as "sum",
                         cast(created_at as varchar) as created_at from billing""",
    "issue": """select cast(user_id as varchar) as user_id, cast(start_time as varchar) as start_time,
                       cast(end_time as varchar) as end_time, title, description, service from issue""",
    "traffic": """select user_id, epoch_us(timerequest) // 1000 as "timestamp", device_id, device_ip_addr,
                         bytes_sent, bytes_received from traffic""",
}

ODS_SQL = {
    "payment": """select user_id, pay_doc_type, pay_doc_num, account, phone, billing_period,
                         try_cast(pay_date as timestamp) as pay_date, try_cast("sum" as decimal(10,2)) as "sum",
                         cast(year(try_cast(pay_date as timestamp)) as int) as year
                  from stg where try_cast(pay_date as timestamp) is not null""",
    "billing": """select user_id, billing_period, service, tariff, try_cast("sum" as decimal(10,2)) as "sum",
                         try_cast(created_at as timestamp) as created_at,
                         cast(year(try_cast(created_at as timestamp)) as int) as year
                  from stg where try_cast(created_at as timestamp) is not null""",
    "issue": """select try_cast(user_id as int) as user_id, try_cast(start_time as timestamp) as start_time,
                       try_cast(end_time as timestamp) as end_time, title, description, service,
                       cast(year(try_cast(start_time as timestamp)) as int) as year
                from stg where try_cast(start_time as timestamp) is not null""",
    "traffic": """select user_id, make_timestamp("timestamp" * 1000) as "timestamp", device_id, device_ip_addr,
                         bytes_sent, bytes_received, cast(year(make_timestamp("timestamp" * 1000)) as int) as year
                  from stg where "timestamp" is not null""",
}


def _q(c: str) -> str:
    return f'"{c}"'


def _n(c: str) -> str:
    return f"nullif(upper(trim(cast({_q(c)} as varchar))), '')"


def _joined(cols) -> str:
    parts = ", ".join(f"coalesce({_n(c)}, '{NULL_TOKEN}')" for c in cols)
    return f"concat_ws('{SEPARATOR}', {parts})"


def stage_sql(spec: StageSpec) -> str:
    t = spec.time_col
    src_cols = []
    for c in spec.columns:
        orig = next((o for o, n in spec.renames.items() if n == c), c)
        src_cols.append(f"{_q(orig)} as {_q(c)}" if orig != c else _q(c))
    sel = [_q(c) for c in spec.columns]
    sel += [f"cast({_q(c)} as varchar) as {k}" for k, c in spec.keys.items()]
    sel.append(f"'{spec.record_source}' as record_source")
    sel += [f"md5({_n(c)}) as {pk}" for pk, c in spec.single.items()]
    sel += [f"md5(nullif({_joined(ins)}, '{sentinel(p)}')) as {pk}" for pk, (ins, p) in spec.composite.items()]
    for hd, (ins, p) in spec.hashdiffs.items():
        sel.append(f"md5({_joined(ins)}) as {hd}" if p is None
                   else f"md5(nullif({_joined(ins)}, '{sentinel(p)}')) as {hd}")
    sel.append(f"make_timestamp(year({_q(t)}), 1, 1, 0, 0, 0) as load_date")
    sel.append(f"{_q(t)} as effective_from")
    return (f"select {', '.join(sel)} from (select {', '.join(src_cols)} from {spec.name}) as src "
            f"where {_q(t)} is not null")


def _with(spec: StageSpec, extra: list[str], entity: str | None = None) -> str:
    ctes = [f"{spec.name} as ({entity or ENTITY_SQL[spec.name]})", f"stage as ({stage_sql(spec)})", *extra]
    return "with " + ",\n".join(ctes)


# Dirty payments and their keys, written out by hand: nothing here comes from the specs or the key recipe of the library.
_BASE = {"user": ("'Cust-' || cast(o_custkey as varchar)", 11), "account": ("'Fl-' || cast(o_custkey % 750 as varchar)", 17),
         "phone": ("'ext ' || cast(o_orderkey % 3 as varchar)", 19)}


def _spoiled(what: str) -> str:
    base, step = _BASE[what]
    return (f"case o_orderkey % {step} when 0 then null when 1 then '' when 2 then '   ' when 3 then '  ' || {base} || ' ' "
            f"when 4 then lower({base}) when 5 then upper({base}) when 6 then chr(9) || {base} else {base} end")


DIRTY_STAGE_SQL = f"""
    raw as (select {_spoiled('user')} as user_id,
        case o_orderkey % 13 when 0 then null when 1 then ' ' else o_orderpriority end as pay_doc_type,
        case when o_orderkey % 13 < 2 then null else o_orderkey % 50 end as pay_doc_num,
        {_spoiled('account')} as account, {_spoiled('phone')} as phone,
        case when o_orderkey % 23 = 0 then null else substr(cast(o_orderdate as varchar), 1, 7) end as billing_period,
        o_orderdate as pay_date, cast(o_totalprice as decimal(10,2)) as payment_sum from orders),
    text as (select *, nullif(upper(trim(user_id)), '') as u, nullif(upper(trim(account)), '') as a, nullif(upper(trim(phone)), '') as p,
        nullif(upper(trim(pay_doc_type)), '') as dt, cast(pay_doc_num as varchar) as dn, nullif(trim(billing_period), '') as b from raw),
    stage as (select pay_date, payment_sum, phone, user_id as user_key, account as account_key, billing_period as billing_period_key,
        pay_doc_type as pay_doc_type_key, cast(pay_doc_num as varchar) as pay_doc_num_key, 'PAYMENT - GCS' as record_source,
        md5(u) as user_pk, md5(a) as account_pk, md5(b) as billing_period_pk,
        case when dt is not null or dn is not null then md5(coalesce(dt, '^^') || '||' || coalesce(dn, '^^')) end as pay_doc_pk,
        case when u is not null or a is not null then md5(coalesce(u, '^^') || '||' || coalesce(a, '^^')) end as user_account_pk,
        case when a is not null or dt is not null or dn is not null or b is not null then
            md5(coalesce(a, '^^') || '||' || coalesce(dt, '^^') || '||' || coalesce(dn, '^^') || '||' || coalesce(b, '^^')) end as account_billing_pay_pk,
        md5(coalesce(p, '^^')) as user_hashdiff, md5(cast(pay_date as varchar) || '||' || cast(payment_sum as varchar)) as pay_doc_hashdiff,
        make_timestamp(year(pay_date), 1, 1, 0, 0, 0) as load_date, pay_date as effective_from from text where pay_date is not null)"""

YEARS_TRAFFIC_SQL = """
    select user_id, ts - to_days(cast((event_id // 4) % 4 * 366 as int)) as timerequest, regexp_extract(props, '([0-9]+)', 1) as device_id,
           '10.0.0.' || cast(event_id % 4 as varchar) as device_ip_addr,
           cast(floor(value * 10) as int) as bytes_sent, cast(floor(value * 100) as int) as bytes_received
    from events"""


def hub_sql(spec: StageSpec, h: HubSpec) -> str:
    keys = list(h.keys)
    out = ", ".join([h.pk, *keys, "load_date", "record_source"])
    if not h.dedup_by or h.dedup_by == h.pk:
        order = ", ".join(["load_date", *[f"{k} nulls first" for k in keys], "record_source"])
        ranked = (f"ranked as (select {out}, row_number() over (partition by {h.pk}, "
                  f"case when {h.pk} is null then load_date end order by {order}) as rn from stage)")
        return _with(spec, [ranked]) + f"\nselect {out} from ranked where rn = 1"
    order = ", ".join([f"{h.pk} nulls first", *[f"{k} nulls first" for k in keys], "record_source"])
    picked = (f"picked as (select {out} from (select {out}, row_number() over (partition by load_date, "
              f"{h.dedup_by} order by {order}) as rn from stage) where rn = 1)")
    firsts = f"firsts as (select {h.pk}, min(load_date) as first_load from picked where {h.pk} is not null group by {h.pk})"
    cols = ", ".join(f"p.{c}" for c in [h.pk, *keys, "load_date", "record_source"])
    return (_with(spec, [picked, firsts]) +
            f"\nselect {cols} from picked p left join firsts f on p.{h.pk} = f.{h.pk} "
            f"where p.{h.pk} is null or p.load_date = f.first_load")


def link_sql(spec: StageSpec, lk: LinkSpec) -> str:
    d_cols = ", ".join([lk.pk, *lk.parents, *lk.also_distinct_on, "load_date", "record_source"])
    d = f"d as (select distinct {d_cols} from stage)"
    f = f"f as (select {lk.pk}, min(load_date) as first_load from d where {lk.pk} is not null group by {lk.pk})"
    cols = ", ".join(f"d.{c}" for c in [lk.pk, *lk.parents, "load_date", "record_source"])
    return (_with(spec, [d, f]) +
            f"\nselect {cols} from d left join f on d.{lk.pk} = f.{lk.pk} "
            f"where d.{lk.pk} is null or d.load_date = f.first_load")


def sat_sql(spec: StageSpec, s: SatSpec) -> str:
    cols = [s.pk, s.hashdiff, *s.payload, "effective_from", "load_date", "record_source"]
    qc = ", ".join(_q(c) for c in cols)
    ctes = [f"cand as (select distinct {qc} from stage)",
            "loads as materialized (select load_date as ld, row_number() over (order by load_date) as k "
            "from (select distinct load_date from cand))"]
    prev = None
    for k in range(1, ORACLE_LOADS + 1):
        ld = f"(select ld from loads where k = {k})"
        batch = f"b{k} as materialized (select {qc} from cand where load_date = {ld})"
        if prev is None:
            ctes += [batch, f"t{k} as materialized (select {qc} from b{k})"]
        else:
            latest = (f"l{k} as (select {s.pk}, {s.hashdiff} from (select {s.pk}, {s.hashdiff}, "
                      f"rank() over (partition by {s.pk} order by load_date desc) as r from {prev} "
                      f"where load_date <= {ld} and {s.pk} in (select {s.pk} from b{k})) where r = 1)")
            ins = (f"t{k} as materialized (select {qc} from {prev} union all select {qc} from b{k} b "
                   f"where not exists (select 1 from l{k} l where l.{s.pk} = b.{s.pk} "
                   f"and l.{s.hashdiff} = b.{s.hashdiff}))")
            ctes += [batch, latest, ins]
        prev = f"t{k}"
    guard = f"(select case when count(*) > {ORACLE_LOADS} then error('more loads than the SQL unrolls') end from loads) is null"
    return _with(spec, ctes) + f"\nselect {qc} from {prev} where {guard}"


def runs_sql(with_stage: str, t, loads: list[int] | None = None) -> str:
    """Any target, run by run in the order of ``loads`` (years; every year in the data, ascending, without it), against the
    rows of the earlier runs. A satellite looks at rows of loads up to its own date; hubs and links at all rows."""
    sat = isinstance(t, SatSpec)
    if sat:
        cols = [t.pk, t.hashdiff, *t.payload, "effective_from", "load_date", "record_source"]
    else:
        cols = [t.pk, *(t.keys if isinstance(t, HubSpec) else t.parents), "load_date", "record_source"]
    qc = ", ".join(_q(c) for c in cols)
    if isinstance(t, HubSpec):
        order = ", ".join(f"{c} nulls first" for c in [t.pk, *t.keys, "record_source"])
        cand = (f"select {qc} from (select *, row_number() over (partition by load_date, {t.dedup_by or t.pk} order by {order}) as rn "
                "from stage) where rn = 1")
    elif sat:
        cand = f"select distinct {qc} from stage"
    else:
        cand = f"select {qc} from (select distinct {', '.join([t.pk, *t.parents, *t.also_distinct_on, 'load_date', 'record_source'])} from stage)"
    ctes, prev = [f"cand as materialized ({cand})"], None
    if loads is None:
        ctes.append("loads as materialized (select load_date as ld, row_number() over (order by load_date) as k from (select distinct load_date from cand))")
    for k in range(1, (len(loads) if loads else ORACLE_LOADS) + 1):
        ld = f"make_timestamp({loads[k - 1]}, 1, 1, 0, 0, 0)" if loads else f"(select ld from loads where k = {k})"
        batch = f"select {qc} from cand b where load_date = {ld}"
        if prev is None:
            ctes.append(f"t{k} as materialized ({batch})")
        elif sat:
            ctes.append(f"l{k} as (select {t.pk}, {t.hashdiff} from (select {t.pk}, {t.hashdiff}, rank() over (partition by {t.pk} "
                        f"order by load_date desc) as r from {prev} where load_date <= {ld}) where r = 1)")
            ctes.append(f"t{k} as materialized (select {qc} from {prev} union all {batch} and not exists "
                        f"(select 1 from l{k} l where l.{t.pk} = b.{t.pk} and l.{t.hashdiff} = b.{t.hashdiff}))")
        else:
            ctes.append(f"t{k} as materialized (select {qc} from {prev} union all {batch} and not exists "
                        f"(select 1 from {prev} x where x.{t.pk} = b.{t.pk}))")
        prev = f"t{k}"
    guard = "" if loads else f" where (select case when count(*) > {ORACLE_LOADS} then error('more loads than the SQL unrolls') end from loads) is null"
    return with_stage + ",\n" + ",\n".join(ctes) + f"\nselect {qc} from {prev}{guard}"


def _entity_cte(entity: str) -> str:
    return f"{entity} as ({ENTITY_SQL[entity]})"


def ods_sql(entity: str) -> str:
    return (f"with {_entity_cte(entity)},\nstg as ({STG_SQL[entity]}),\nods as ({ODS_SQL[entity]})\n"
            f"select * from ods")


def dm_traffic_sql() -> str:
    return (f"with {_entity_cte('traffic')},\nstg as ({STG_SQL['traffic']}),\nods as ({ODS_SQL['traffic']})\n"
            "select user_id, max(bytes_received) as max_bytes_received, min(bytes_received) as min_bytes_received,\n"
            "       round(avg(bytes_received)) as avg_traf, year\nfrom ods group by year, user_id")


def target_sql(vault: VaultSpec, name: str) -> str:
    t = vault.target(name)
    spec = vault.stages[t.source]
    if isinstance(t, HubSpec):
        return hub_sql(spec, t)
    if isinstance(t, LinkSpec):
        return link_sql(spec, t)
    return sat_sql(spec, t)


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    for e in ENTITY_SQL:
        o[f"ods_{e}"] = ods_sql(e)
    o["dm_traffic"] = dm_traffic_sql()
    for s, spec in FP.stages.items():
        o[f"stage_{s}"] = _with(spec, []) + "\nselect * from stage"
    o["stage_payment_dwl"] = _with(DWL.stages["payment"], []) + "\nselect * from stage"
    for t in FP.targets():
        o[t.name] = target_sql(FP, t.name)
    for t in DWL.targets():
        o[f"dwl_{t.name}"] = target_sql(DWL, t.name)
    for name in INCREMENTAL:
        o[f"inc_{name}"] = target_sql(FP, name)
    for e in ENTITY_SQL:
        o[f"inc_ods_{e}"] = o[f"catalog_ods_{e}"] = ods_sql(e)
    o["inc_dm_traffic"] = o["catalog_dm_traffic"] = o["state_dm_traffic"] = dm_traffic_sql()
    for s in FP.stages:
        o[f"view_stage_{s}"] = o[f"stage_{s}"]
        o[f"one_scan_{s}"] = "\nunion all ".join(f"select '{t.name}' as target, {t.pk} as pk, load_date, record_source from ({o[t.name]}) as x_{t.name}"
                                                 for t in (*FP.hubs, *FP.links) if t.source == s)
    for name in RERUN_TARGETS:
        t = FP.target(name)
        o[f"rerun_{name}"] = runs_sql(_with(FP.stages[t.source], []), t, list(RERUN))
    for name in DIRTY_TARGETS:
        o[f"dirty_{name}"] = runs_sql(f"with {DIRTY_STAGE_SQL}", FP.target(name))
    for name in YEARS_TARGETS:
        o[f"years_{name}"] = runs_sql(_with(FP.stages["traffic"], [], YEARS_TRAFFIC_SQL), FP.target(name))
    return o
