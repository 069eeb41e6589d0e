"""DuckDB oracle SQL, one statement per registered query.

The fixture views of ``fixtures.py`` are repeated here as CTEs over the
driver's pre-registered tables. Every column is aliased to the Spark name.
"""

from __future__ import annotations

VIEWS = {
    "tx": """select event_id as trans_id, ts as trans_date, cast(ts as date) as trans_day,
        value as amt, user_id as card_num, event_type as oper_type,
        case when event_type in ('click','view','error') then 'REJECT'
             when event_type = 'purchase' then 'SUCCESS' else 'OTHER' end as oper_result,
        cast(json_extract_string(props, '$.k') as int) as terminal
      from events""",
    "terminals": """select terminal_id,
        case when terminal_id % 3 = 0 then 'ATM' else 'POS' end as terminal_type,
        'CITY_' || cast(terminal_id % 5 as varchar) as terminal_city,
        'ADDR_' || cast(terminal_id as varchar) as terminal_address,
        date '2023-01-01' as effective_from,
        case when terminal_id % 23 = 0 then date '2023-12-31' else date '2999-01-01' end as effective_to,
        terminal_id % 23 = 0 as deleted_flg
      from (select distinct terminal as terminal_id from tx)""",
    "cards": """select c_custkey as card_num, c_custkey + 1000000 as account_num,
        date '2023-01-01' as effective_from,
        case when c_custkey % 19 = 0 then date '2023-12-31' else date '2999-01-01' end as effective_to,
        c_custkey % 19 = 0 as deleted_flg
      from customer""",
    "accounts": """select c_custkey + 1000000 as account_num,
        cast(date '2024-01-01' + cast((c_custkey * 11) % 45 as int) as date) as valid_to,
        c_custkey + 2000000 as client,
        date '2023-01-01' as effective_from, date '2999-01-01' as effective_to, false as deleted_flg
      from customer""",
    "clients": """select c_custkey + 2000000 as client_id, c_name as fio,
        cast(date '1960-01-01' + cast(c_custkey % 15000 as int) as date) as date_of_birth,
        'P' || cast(c_custkey as varchar) as passport_num,
        case when c_custkey % 29 = 3 then null
             else cast(date '2024-01-01' + cast((c_custkey * 7) % 60 as int) as date) end as passport_valid_to,
        '+7' || lpad(cast(c_custkey as varchar), 10, '0') as phone,
        date '2023-01-01' as effective_from, date '2999-01-01' as effective_to, false as deleted_flg
      from customer""",
    "blacklist": """select 'P' || cast(c_custkey as varchar) as passport_num, date '2024-01-01' as entry_dt
      from customer where c_custkey % 13 = 0""",
    "chain": """select c.card_num, c.account_num, a.valid_to, k.client_id, k.fio, k.passport_num,
        k.passport_valid_to, k.phone
      from (select * from cards where deleted_flg = false and effective_to = date '2999-01-01') c
      join (select * from accounts where deleted_flg = false and effective_to = date '2999-01-01') a
        on a.account_num = c.account_num
      join (select * from clients where deleted_flg = false and effective_to = date '2999-01-01') k
        on k.client_id = a.client""",
}

_VIEW_ORDER = ["tx", "terminals", "cards", "accounts", "clients", "blacklist", "chain"]


def with_views(body: str, *needed: str, views: dict | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (plus their dependencies); ``views`` overrides definitions."""
    defs = {**VIEWS, **(views or {})}
    deps = {"terminals": ["tx"], "chain": ["cards", "accounts", "clients"]}
    want: list[str] = []

    def add(v):
        for d in deps.get(v, []):
            add(d)
        if v not in want:
            want.append(v)

    for v in needed:
        add(v)
    ordered = [v for v in _VIEW_ORDER if v in want]
    ctes = ",\n".join(f"{v} as ({defs[v]})" for v in ordered)
    return f"with {ctes}\n{body}"


REPORT_SELECT = """strftime({ts}, '%H:%M:%S') as event_dt, {c}.passport_num as passport, {c}.fio,
  {c}.phone, {etype} as event_type, {rdt} as report_dt, {ts} as event_ts"""


def _report(ts: str, etype: int, rdt: str, c: str = "c") -> str:
    return REPORT_SELECT.format(ts=ts, etype=etype, rdt=rdt, c=c)


def r1_sql(views: dict | None = None) -> str:
    body = f"""select {_report('t.trans_date', 1, 't.trans_day')}
    from tx t join chain c on c.card_num = t.card_num
    left join (select distinct passport_num as bl_passport from blacklist) b on b.bl_passport = c.passport_num
    where b.bl_passport is not null or c.passport_valid_to <= t.trans_day"""
    return with_views(body, "tx", "chain", "blacklist", views=views)


def r2_sql(strict: bool = False, views: dict | None = None) -> str:
    cond = "c.valid_to < t.trans_day" if strict else "cast(c.valid_to as timestamp) < t.trans_date"
    body = f"""select {_report('t.trans_date', 2, 't.trans_day')}
    from tx t join chain c on c.card_num = t.card_num
    where {cond}"""
    return with_views(body, "tx", "chain", views=views)


_W = "partition by card_num, trans_day order by trans_date, trans_id"


def r3_hits_sql(strict: bool = False, gap: str = "interval 1 hour", sfx: str = "") -> str:
    """CTEs ending in ``h{sfx}``: per (card, day) event_ts of the last hop."""
    base = f"""j{sfx} as (select t.card_num, t.trans_day, t.trans_date, t.trans_id, m.terminal_city
        from tx t join (select * from terminals where deleted_flg = false
                        and effective_to = date '2999-01-01') m on m.terminal_id = t.terminal),
      a{sfx} as (select *, lead(trans_date) over ({_W}) as next_ts,
                      lead(terminal_city) over ({_W}) as next_city0 from j{sfx})"""
    if strict:
        return base + f""",
      h{sfx} as (select card_num, trans_day, max(next_ts) as event_ts from a{sfx}
            where next_ts - trans_date < {gap} and terminal_city <> next_city0
            group by card_num, trans_day)"""
    return base + f""",
      b{sfx} as (select *, lead(terminal_city) over ({_W}) as next_city
            from a{sfx} where next_ts - trans_date < {gap}),
      h{sfx} as (select card_num, trans_day, max(trans_date) as event_ts from b{sfx}
            where terminal_city <> next_city group by card_num, trans_day)"""


def _ctes(*needed: str, views: dict | None = None) -> str:
    return with_views("select 1", *needed, views=views)[: -len("\nselect 1")]


def r3_sql(strict: bool = False) -> str:
    return f"""{_ctes("tx", "terminals", "chain")},
      {r3_hits_sql(strict)}
    select {_report('h.event_ts', 3, 'h.trans_day')}
    from h join chain c on c.card_num = h.card_num"""


def r4_hits_sql(span: str, per_day: bool = True, rejects: int = 3, sfx: str = "") -> str:
    """CTEs ending in ``h{sfx}``: the success rows of amount-probing sequences."""
    part = "card_num, trans_day" if per_day else "card_num"
    w = f"partition by {part} order by trans_date, trans_id"
    lags = ",\n            ".join(
        f"lag(oper_result, {i}) over ({w}) as r{i}, lag(amt, {i}) over ({w}) as a{i}"
        for i in range(1, rejects + 1))
    conds = " and ".join(f"r{i} = 'REJECT'" for i in range(1, rejects + 1))
    amts = ["amt"] + [f"a{i}" for i in range(1, rejects + 1)]
    mono = " and ".join(f"{amts[i + 1]} >= {amts[i]}" for i in range(rejects))
    return f"""p{sfx} as (select trans_id, card_num, trans_day, trans_date, oper_result,
            cast(amt as double) as amt,
            {lags},
            lag(trans_date, {rejects}) over ({w}) as first_ts
          from tx),
      h{sfx} as (select * from p{sfx} where oper_result = 'SUCCESS' and {conds} and {mono}
            and trans_date - first_ts <= {span})"""


def r4_sql(span: str = "interval 20 minute", per_day: bool = True) -> str:
    return f"""{_ctes("tx", "chain")},
      {r4_hits_sql(span, per_day)}
    select {_report('h.trans_date', 4, 'h.trans_day')}
    from h join chain c on c.card_num = h.card_num"""


def report_sql(views: dict | None = None, strict: bool = False, span: str = "interval 20 minute") -> str:
    """All four rules, bag union. ``strict``: rules 2 and 3 strict, rule 4 across days."""
    r1_body = r1_sql(views).split("\nselect ", 1)[1]
    r2_body = r2_sql(strict=strict, views=views).split("\nselect ", 1)[1]
    return f"""{_ctes("tx", "terminals", "chain", "blacklist", views=views)},
      {r3_hits_sql(strict=strict, sfx="3")},
      {r4_hits_sql(span, per_day=not strict, sfx="4")}
    select {r1_body}
    union all select {r2_body}
    union all select {_report('h3.event_ts', 3, 'h3.trans_day')} from h3 join chain c on c.card_num = h3.card_num
    union all select {_report('h4.trans_date', 4, 'h4.trans_day')} from h4 join chain c on c.card_num = h4.card_num"""


# --- SCD2 (unrolled daily steps) ---------------------------------------------------

SNAP_SQL = {
    1: "select c_custkey as k, c_mktsegment as s from customer where c_custkey % 10 <> 0",
    2: """select c_custkey as k, case when c_custkey % 5 = 1 then 'CHANGED'
            when c_custkey % 11 = 2 then null else c_mktsegment end as s
          from customer where c_custkey % 7 <> 3""",
    3: """select c_custkey as k, case when c_custkey % 5 = 1 and c_custkey % 2 = 0 then 'CHANGED'
            when c_custkey % 11 = 2 then null else c_mktsegment end as s
          from customer where c_custkey % 9 <> 4""",
}

SHAPE_SQL = {
    "generic": ("k", ["s"], "select k, s from ({src})"),
    "terminals": ("terminal_id", ["terminal_type", "terminal_city", "terminal_address"],
                  """select k as terminal_id, s as terminal_type, 'CITY_' || cast(k % 5 as varchar) as terminal_city,
                     'ADDR_' || cast(k as varchar) as terminal_address from ({src})"""),
    "cards": ("card_num", ["account_num"], "select k as card_num, s as account_num from ({src})"),
    "accounts": ("account_num", ["valid_to", "client"],
                 """select k as account_num, cast(date '2024-01-01' + cast((k * 11) % 45 as int) as date) as valid_to,
                    s as client from ({src})"""),
    "clients": ("client_id", ["fio", "date_of_birth", "passport_num", "passport_valid_to", "phone"],
                """select k as client_id, s as fio, cast(date '1960-01-01' + cast(k % 15000 as int) as date) as date_of_birth,
                   'P' || cast(k as varchar) as passport_num,
                   cast(date '2024-01-01' + cast((k * 7) % 60 as int) as date) as passport_valid_to,
                   cast(null as varchar) as phone from ({src})"""),
}

SCD2_DAYS_SQL = ["2024-03-01", "2024-03-02", "2024-03-03"]
OPEN = "date '2999-01-01'"


def _distinct(attrs, a, b):
    return " or ".join(f"{a}.{x} is distinct from {b}.{x}" for x in attrs)


def scd2_step_sql(n: int, key: str, attrs: list[str], day: str, staging: str, strict: bool) -> str:
    """CTEs turning h{n-1} (+ wm{n-1}, src{n}) into h{n} and wm{n}."""
    p = n - 1
    D = f"date '{day}'"
    Dm1 = f"(date '{day}' - interval 1 day)::date"
    cols = ", ".join([key, *attrs])
    open_live = f"deleted_flg = false and effective_to = {OPEN}"
    if staging == "snapshot":
        match = " and ".join(f"s.{c} is not distinct from c.{c}" for c in [key, *attrs])
        stg = f"""stg{n} as (select * from (select {', '.join('s.' + c for c in [key, *attrs])},
              coalesce(c.effective_from, {D}) as update_dt
            from src{n} s left join (select * from h{p} where {open_live}) c on {match}) x
            where update_dt > (select wm from wm{p}))"""
    else:
        stg = f"stg{n} as (select {cols}, {D} as update_dt from src{n})"
    if not strict:
        body = f"""new{n} as (select {cols} from stg{n} g where not exists (select 1 from h{p} t where t.{key} = g.{key})),
      chg{n} as (select distinct {', '.join('g.' + c for c in [key, *attrs])} from stg{n} g
                 join h{p} t on g.{key} = t.{key} where {_distinct(attrs, 'g', 't')}),
      h{n} as (
        select {cols}, effective_from,
          case when {key} not in (select {key} from src{n}) then {Dm1}
               when {key} in (select {key} from chg{n}) and effective_to = {OPEN} then {Dm1}
               else effective_to end as effective_to,
          case when {key} not in (select {key} from src{n}) then true else deleted_flg end as deleted_flg
        from h{p}
        union all select {cols}, {D}, {OPEN}, false from new{n}
        union all select {cols}, {D}, {OPEN}, false from chg{n})"""
    else:
        body = f"""cls{n} as (select {', '.join('g.' + c for c in [key, *attrs])},
              c.{key} is not null as has_open,
              c.{key} is not null and ({_distinct(attrs, 'g', 'c')}) as changed
            from stg{n} g left join (select * from h{p} where {open_live}) c on c.{key} = g.{key}),
      h{n} as (
        select {cols}, effective_from,
          case when {open_live} and ({key} not in (select {key} from src{n})
                    or {key} in (select {key} from cls{n} where changed)) then {Dm1}
               else effective_to end as effective_to,
          case when {open_live} and {key} not in (select {key} from src{n}) then true
               else deleted_flg end as deleted_flg
        from h{p}
        union all select {cols}, {D}, {OPEN}, false from cls{n} where not has_open or changed)"""
    wm = f"wm{n} as (select coalesce((select max(update_dt) from stg{n}), (select wm from wm{p})) as wm)"
    return f"{stg},\n      {body},\n      {wm}"


def scd2_fold_sql(shape: str = "generic", staging: str = "snapshot", strict: bool = False,
                  days: int = 3, final: str | None = None, day_list: list[str] | None = None) -> str:
    day_list = day_list or SCD2_DAYS_SQL
    key, attrs, tmpl = SHAPE_SQL[shape]
    srcs = ",\n      ".join(f"src{i} as ({tmpl.format(src=SNAP_SQL[i])})" for i in range(1, days + 1))
    h0 = f"""h0 as (select {', '.join([key, *attrs])}, cast(null as date) as effective_from,
        cast(null as date) as effective_to, cast(null as boolean) as deleted_flg from src1 where false)"""
    steps = ",\n      ".join(scd2_step_sql(i, key, attrs, day_list[i - 1], staging, strict)
                            for i in range(1, days + 1))
    return f"""with {srcs},
      {h0},
      wm0 as (select date '1900-01-01' as wm),
      {steps}
    {final or f'select * from h{days}'}"""
