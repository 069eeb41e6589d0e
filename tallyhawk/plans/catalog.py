"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus their oracle SQL."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.functions.scalars import decimal_comma as _decimal_comma
from tallyhawk.operators import asof as asof_ops
from tallyhawk.operators import chain as chain_ops
from tallyhawk.operators import checks as check_ops
from tallyhawk.operators import facts as fact_ops
from tallyhawk.operators import fraud, sequence
from tallyhawk.operators import scd2 as scd2_ops
from tallyhawk.plans import fixtures as fx
from tallyhawk.plans import asof_catalog, backfill, history, oracle
from tallyhawk.plans import daily as pipe
from tallyhawk.plans.state import FACTS, Warehouse
from tallyhawk.schemas import DIMENSIONS, MAX_LENGTHS, REFERENCE, STRICT
from tallyhawk.session import scratch_path
from tallyhawk.sources import files as file_ops
from tallyhawk.streaming import amount_probe as stream_ops

Query = Callable[[SparkSession, str], DataFrame]

FACT_DAY = _dt.date(2024, 1, 15)


def _chain(spark, d):
    return chain_ops.dim_chain(fx.cards(spark, d), fx.accounts(spark, d), fx.clients(spark, d))


# --- facts and dimensions ----------------------------------------------------

def _loaded_facts(spark, d):
    """All operations written as the facts of one input day, published and ready to read back."""
    wh = Warehouse(spark, scratch_path(spark, "facts"))
    fact_ops.write_day(fx.tx_as_facts(spark, d), wh.day_path(FACTS, FACT_DAY, 1), "trans_day")
    wh.commit(FACT_DAY, {}, days={FACTS: [1]})
    return wh


def q_fact_transactions(spark, d):
    """The facts written by day, published and read back."""
    return _loaded_facts(spark, d).read_facts().withColumn("amt", F.col("amt").cast("double"))


def q_fact_day(spark, d):
    """One day's facts by partition."""
    return _loaded_facts(spark, d).read_facts(FACT_DAY).withColumn("amt", F.col("amt").cast("double"))


def q_dim_current(spark, d):
    return chain_ops.current(fx.cards(spark, d))


def q_dim_chain(spark, d):
    return chain_ops.dim_chain(fx.cards(spark, d), fx.accounts(spark, d), fx.clients(spark, d))


# --- rules ---------------------------------------------------------------------

def q_fraud_expired_passport(spark, d):
    return fraud.fraud_expired_passport(fx.tx(spark, d), _chain(spark, d), fx.blacklist(spark, d))


def q_fraud_expired_contract(spark, d):
    return fraud.fraud_expired_contract(fx.tx(spark, d), _chain(spark, d), REFERENCE)


def q_fraud_expired_contract_strict(spark, d):
    return fraud.fraud_expired_contract(fx.tx(spark, d), _chain(spark, d), STRICT)


def q_txn_gap(spark, d):
    """Gap to the next operation of the card on the same day, in whole seconds."""
    t = fx.tx(spark, d).select("trans_id", "card_num", "trans_day", "trans_date")
    t = t.withColumn("ts_s", F.date_trunc("second", "trans_date"))
    t = sequence.chunked(t, sequence.find_hot(t, "card_num", "trans_date"), "card_num", "trans_date")
    n = sequence.with_next(t, ["card_num", "trans_day"], ["trans_date", "trans_id"], ["ts_s"])
    return n.select("trans_id", "card_num", "trans_day",
                    F.timestamp_diff("SECOND", "ts_s", "next_ts_s").alias("gap_s"))


def q_fraud_city_hop(spark, d):
    return fraud.fraud_city_hop(fx.tx(spark, d), fx.terminals(spark, d), _chain(spark, d), semantics=REFERENCE)


def q_fraud_city_hop_strict(spark, d):
    return fraud.fraud_city_hop(fx.tx(spark, d), fx.terminals(spark, d), _chain(spark, d), semantics=STRICT)


def q_fraud_amount_probe(spark, d):
    """Rule 4 per (card, day) with a one-day span (20 minutes finds nothing in the driver data)."""
    return fraud.fraud_amount_probe(fx.tx(spark, d), _chain(spark, d), max_span="1 day", per_day=True)


def q_fraud_amount_probe_20min(spark, d):
    return fraud.fraud_amount_probe(fx.tx(spark, d), _chain(spark, d), max_span="20 minutes", per_day=True)


def q_fraud_amount_probe_multiday(spark, d):
    """Rule 4 per card across days (strict form of Q14), three-day span."""
    return fraud.fraud_amount_probe(fx.tx(spark, d), _chain(spark, d), max_span="3 days", per_day=False)


def q_fraud_report(spark, d):
    return fraud.fraud_report(fx.tx(spark, d), _chain(spark, d), fx.blacklist(spark, d),
                              fx.terminals(spark, d), semantics=REFERENCE)


def _report(semantics, span):
    def q(spark, d):
        return fraud.fraud_report(fx.tx(spark, d), _chain(spark, d), fx.blacklist(spark, d), fx.terminals(spark, d),
                                  semantics=semantics, probe_span=span)
    return q


QUERIES: dict[str, Query] = {
    "fraud_report_wide": _report(REFERENCE, "1 day"),
    "fraud_report_strict": _report(STRICT, "3 days"),
    "fact_transactions": q_fact_transactions,
    "fact_day": q_fact_day,
    "dim_current": q_dim_current,
    "dim_chain": q_dim_chain,
    "fraud_expired_passport": q_fraud_expired_passport,
    "fraud_expired_contract": q_fraud_expired_contract,
    "fraud_expired_contract_strict": q_fraud_expired_contract_strict,
    "txn_gap": q_txn_gap,
    "fraud_city_hop": q_fraud_city_hop,
    "fraud_city_hop_strict": q_fraud_city_hop_strict,
    "fraud_amount_probe": q_fraud_amount_probe,
    "fraud_amount_probe_20min": q_fraud_amount_probe_20min,
    "fraud_amount_probe_multiday": q_fraud_amount_probe_multiday,
    "fraud_report": q_fraud_report,
}


def _txn_gap_sql() -> str:
    return oracle.with_views(f"""select trans_id, card_num, trans_day,
        date_diff('second', ts_s, lead(ts_s) over (partition by card_num, trans_day
                                                 order by trans_date, trans_id)) as gap_s
      from (select *, date_trunc('second', trans_date) as ts_s from tx)""", "tx")


FACT_SQL = """select cast(trans_id as varchar) as trans_id, trans_date, trans_day,
    cast(cast(amt as decimal(30,2)) as double) as amt, cast(card_num as varchar) as card_num, oper_type, oper_result,
    cast(terminal as varchar) as terminal from tx"""

ORACLE: dict[str, str] = {
    "fact_transactions": oracle.with_views(FACT_SQL, "tx"),
    "fact_day": oracle.with_views(FACT_SQL + " where trans_day = date '2024-01-15'", "tx"),
    "dim_current": oracle.with_views(
        "select * from cards where deleted_flg = false and effective_to = date '2999-01-01'", "cards"),
    "dim_chain": oracle.with_views("select * from chain", "chain"),
    "fraud_expired_passport": oracle.r1_sql(),
    "fraud_expired_contract": oracle.r2_sql(strict=False),
    "fraud_expired_contract_strict": oracle.r2_sql(strict=True),
    "txn_gap": _txn_gap_sql(),
    "fraud_city_hop": oracle.r3_sql(strict=False),
    "fraud_city_hop_strict": oracle.r3_sql(strict=True),
    "fraud_amount_probe": oracle.r4_sql("interval 1 day", per_day=True),
    "fraud_amount_probe_20min": oracle.r4_sql("interval 20 minute", per_day=True),
    "fraud_amount_probe_multiday": oracle.r4_sql("interval 3 day", per_day=False),
    "fraud_report": oracle.report_sql(),
    "fraud_report_wide": oracle.report_sql(span="interval 1 day"),
    "fraud_report_strict": oracle.report_sql(strict=True, span="interval 3 day"),
}


# --- SCD2 ----------------------------------------------------------------------------



def _fold(spark, d, shape, staging, semantics):
    snaps = [fx.snapshot(spark, d, n) for n in (1, 2, 3)]
    if shape == "generic":
        key, attrs = "k", ["s"]
    else:
        key, attrs, _ = DIMENSIONS[shape]
        snaps = [fx.snapshot_as(shape, s) for s in snaps]
    return history.fold_days(spark, fx.SCD2_DAYS, snaps, key, attrs, staging, semantics)


def _fold_query(shape, staging, semantics):
    return lambda spark, d: _fold(spark, d, shape, staging, semantics)


def _day1(spark, d):
    """History after loading S1 on the first day, and S2 staged against it."""
    s1, s2 = fx.snapshot(spark, d, 1), fx.snapshot(spark, d, 2)
    d1, d2 = fx.SCD2_DAYS[0], fx.SCD2_DAYS[1]
    h1 = history.fold_days(spark, [d1], [s1], "k", ["s"], history.SNAPSHOT, REFERENCE)
    staged = scd2_ops.stage_snapshot(s2, h1, "k", ["s"], d1, d2)
    return h1, staged, s2, d2


def q_stage_terminals(spark, d):
    return _day1(spark, d)[1]


def q_scd2_new(spark, d):
    h1, staged, _, _ = _day1(spark, d)
    return scd2_ops.scd2_new(h1, staged, "k")


def q_scd2_changed(spark, d):
    h1, staged, _, _ = _day1(spark, d)
    return scd2_ops.scd2_changed(h1, staged, "k", ["s"])


def q_scd2_close(spark, d):
    h1, staged, _, d2 = _day1(spark, d)
    return scd2_ops.scd2_close(h1, scd2_ops.scd2_changed(h1, staged, "k", ["s"]), d2, "k")


def q_scd2_deleted(spark, d):
    h1, _, s2, d2 = _day1(spark, d)
    return scd2_ops.scd2_deleted(h1, s2.select("k"), d2, "k")


def q_watermark_advance(spark, d):
    """New watermark after staging S2 (advances) and after an empty staging (keeps the old one)."""
    h1, staged, _, _ = _day1(spark, d)
    old = fx.SCD2_DAYS[0]
    def after(rows):
        return spark.range(1).select(scd2_ops.watermark_advance(rows, old).alias("max_update_dt"))
    adv, keep = after(staged), after(staged.filter(F.lit(False)))
    return (adv.select(F.lit("staged").alias("case_name"), "max_update_dt")
            .unionByName(keep.select(F.lit("empty").alias("case_name"), "max_update_dt")))


def _stage(kind):
    def q(spark, d):
        if kind == "cards":
            src = fx.source_cards(spark, d).withColumnRenamed("account", "account_num")
        elif kind == "accounts":
            src = fx.source_accounts(spark, d).withColumnRenamed("account", "account_num")
        else:
            from tallyhawk.functions.scalars import full_name
            src = fx.source_clients(spark, d).withColumn(
                "fio", full_name("last_name", "first_name", "patronymic"))
        key, attrs, _ = DIMENSIONS[kind]
        return scd2_ops.stage_incremental(src, key, attrs, fx.STAGE_WATERMARK, fx.STAGE_DAY)
    return q


QUERIES.update({
    "stage_cards": _stage("cards"),
    "stage_accounts": _stage("accounts"),
    "stage_clients": _stage("clients"),
    "stage_terminals": q_stage_terminals,
    "scd2_new": q_scd2_new,
    "scd2_changed": q_scd2_changed,
    "scd2_close": q_scd2_close,
    "scd2_deleted": q_scd2_deleted,
    "watermark_advance": q_watermark_advance,
    "scd2_three_days": _fold_query("generic", history.SNAPSHOT, REFERENCE),
    "scd2_three_days_strict": _fold_query("generic", history.SNAPSHOT, STRICT),
    "scd2_restage_three_days": _fold_query("generic", history.RESTAGE_ALL, REFERENCE),
    "scd2_restage_three_days_strict": _fold_query("generic", history.RESTAGE_ALL, STRICT),
    "scd2_terminals": _fold_query("terminals", history.SNAPSHOT, REFERENCE),
    "scd2_cards": _fold_query("cards", history.RESTAGE_ALL, REFERENCE),
    "scd2_accounts": _fold_query("accounts", history.RESTAGE_ALL, REFERENCE),
    "scd2_clients": _fold_query("clients", history.RESTAGE_ALL, REFERENCE),
})


def _stage_sql(kind):
    upd = ("case when c_custkey % 4 = 0 then null "
           "else cast(date '2024-01-01' + cast(c_custkey % 10 as int) as date) end")
    if kind == "cards":
        src = f"select c_custkey as card_num, c_custkey + 1000000 as account_num, {upd} as update_dt from customer"
        cols = "card_num, account_num"
    elif kind == "accounts":
        src = (f"select c_custkey + 1000000 as account_num, "
               f"cast(date '2024-01-01' + cast((c_custkey * 11) % 45 as int) as date) as valid_to, "
               f"c_custkey + 2000000 as client, {upd} as update_dt from customer")
        cols = "account_num, valid_to, client"
    else:
        src = f"""select c_custkey + 2000000 as client_id,
            split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) || ' ' ||
              (case when c_custkey % 6 = 0 then null else 'N' || cast(c_custkey % 7 as varchar) end) as fio,
            cast(date '1960-01-01' + cast(c_custkey % 15000 as int) as date) as date_of_birth,
            'P' || cast(c_custkey as varchar) as passport_num,
            case when c_custkey % 29 = 3 then null
                 else cast(date '2024-01-01' + cast((c_custkey * 7) % 60 as int) as date) end as passport_valid_to,
            '+7' || lpad(cast(c_custkey as varchar), 10, '0') as phone, {upd} as update_dt from customer"""
        cols = "client_id, fio, date_of_birth, passport_num, passport_valid_to, phone"
    return (f"select {cols}, date '2024-01-10' as update_dt from ({src}) "
            f"where update_dt > date '2024-01-05' or update_dt is null")


def _day1_sql(final: str) -> str:
    return oracle.scd2_fold_sql("generic", "snapshot", False, days=2, final=final)


ORACLE.update({
    "stage_cards": _stage_sql("cards"),
    "stage_accounts": _stage_sql("accounts"),
    "stage_clients": _stage_sql("clients"),
    "stage_terminals": _day1_sql("select k, s, update_dt from stg2"),
    "scd2_new": _day1_sql("select k, s, update_dt from stg2 g where not exists (select 1 from h1 t where t.k = g.k)"),
    "scd2_changed": _day1_sql("select k, s from chg2"),
    "scd2_close": _day1_sql("""select k, s, effective_from,
        case when k in (select k from chg2) and effective_to = date '2999-01-01'
             then date '2024-03-01' else effective_to end as effective_to, deleted_flg from h1"""),
    "scd2_deleted": _day1_sql("""select k, s, effective_from,
        case when k not in (select k from src2) then date '2024-03-01' else effective_to end as effective_to,
        case when k not in (select k from src2) then true else deleted_flg end as deleted_flg from h1"""),
    "watermark_advance": _day1_sql("""select 'staged' as case_name,
        coalesce((select max(update_dt) from stg2), date '2024-03-01') as max_update_dt
      union all select 'empty', coalesce((select max(update_dt) from stg2 where false), date '2024-03-01')"""),
    "scd2_three_days": oracle.scd2_fold_sql("generic", "snapshot", False),
    "scd2_three_days_strict": oracle.scd2_fold_sql("generic", "snapshot", True),
    "scd2_restage_three_days": oracle.scd2_fold_sql("generic", "restage", False),
    "scd2_restage_three_days_strict": oracle.scd2_fold_sql("generic", "restage", True),
    "scd2_terminals": oracle.scd2_fold_sql("terminals", "snapshot", False),
    "scd2_cards": oracle.scd2_fold_sql("cards", "restage", False),
    "scd2_accounts": oracle.scd2_fold_sql("accounts", "restage", False),
    "scd2_clients": oracle.scd2_fold_sql("clients", "restage", False),
})


# --- files, sinks, checks ------------------------------------------------------------


_EXT = {"transactions": ".txt", "terminals": ".xlsx", "passport_blacklist": ".xlsx"}


def _file_names(spark, d):
    """Input names for every business day present in the events: kind_DDMMYYYY.ext."""
    days = fx.tx(spark, d).select("trans_day").distinct()
    kind = F.explode(F.array(*[F.lit(k) for k in _EXT])).alias("kind0")
    ext = F.when(F.col("kind0") == "transactions", F.lit(".txt")).otherwise(F.lit(".xlsx"))
    names = days.select("trans_day", kind).select(
        F.concat(F.col("kind0"), F.lit("_"), F.date_format("trans_day", "ddMMyyyy"), ext).alias("name"))
    return names.withColumn("path", F.col("name"))


def q_file_day(spark, d):
    return _file_names(spark, d).select("name", file_ops.day_from_name("name").alias("day"))


def _pick(semantics):
    def q(spark, d):
        chosen = file_ops.choose_files(file_ops.classify_names(_file_names(spark, d)), semantics)
        return chosen.select("kind", "name", "day")
    return q


def q_decimal_comma(spark, d):
    o = fx.table(spark, d, "orders")
    text = F.regexp_replace(o["o_totalprice"].cast("decimal(30,2)").cast("string"), r"\.", ",")
    t = o.select("o_orderkey", text.alias("amount_text"))
    return t.select("o_orderkey", "amount_text", _decimal_comma("amount_text").cast("double").alias("amt"))


def q_check_unique_key(spark, d):
    return check_ops.check_unique_key(fx.table(spark, d, "orders"), "o_custkey")


def q_check_unique_key_customer(spark, d):
    return check_ops.check_unique_key(fx.table(spark, d, "customer"), "c_custkey")


def q_check_lengths(spark, d):
    """Orders whose priority text is longer than a declared 10 characters."""
    return check_ops.check_lengths(fx.table(spark, d, "orders").select("o_orderkey", "o_orderpriority"),
                                   {"o_orderpriority": 10})


def q_check_lengths_report(spark, d):
    """Report rows (from customers) with a value longer than the report declares."""
    c, k = fx.table(spark, d, "customer"), F.col("c_custkey")
    rows = c.select(F.concat(F.lit("P"), k.cast("string")).alias("passport"), F.concat("c_name", "c_name").alias("fio"),
                    F.lpad(k.cast("string"), (10 + k % 10).cast("int"), F.lit("0")).alias("phone"))
    return check_ops.check_lengths(rows, MAX_LENGTHS["report"])


def q_blacklist_refresh(spark, d):
    """Full refresh: the second snapshot replaces the first at the same path."""
    path = scratch_path(spark, "blacklist")
    c = fx.table(spark, d, "customer")
    k = F.col("c_custkey")

    def snap(m):
        return c.filter(k % m == 0).select(F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
                                           F.lit(fx.BASE_DAY).alias("entry_dt"))
    fact_ops.refresh_snapshot(snap(13), path)
    fact_ops.refresh_snapshot(snap(17), path)
    return spark.read.parquet(path)


def write_transactions_file(tx, path):
    """The fact rows as a ';'-separated file with a decimal comma (what the bank sends)."""
    out = tx.select(
        F.col("trans_id").cast("string").alias("transaction_id"),
        F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        F.regexp_replace(F.col("amt").cast("decimal(30,2)").cast("string"), r"\.", ",").alias("amount"),
        F.col("card_num").cast("string").alias("card_num"),
        F.col("oper_type"), F.col("oper_result"),
        F.col("terminal").cast("string").alias("terminal"))
    out.write.option("sep", ";").option("header", True).mode("overwrite").csv(path)


def q_scan_transactions(spark, d):
    path = scratch_path(spark, "input") + "/transactions_01012024.txt"
    write_transactions_file(fx.tx(spark, d), path)
    good, _ = file_ops.scan_transactions(spark, path)
    return good.withColumn("amt", F.col("amt").cast("double"))


def q_scan_transactions_rejects(spark, d):
    """The lines of a file in which every seventh has a field too many and every eleventh two too few."""
    path = scratch_path(spark, "input") + "/transactions_01012024.txt"
    t, i = fx.tx(spark, d), F.col("trans_id")
    fields = F.array(i.cast("string"), F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss"), F.lit("1,00"),
                     F.col("card_num").cast("string"), F.col("oper_type"), F.col("oper_result"), F.lit("9"))
    fields = F.when(i % 7 == 0, F.array_append(fields, F.lit("more"))).when(i % 11 == 0, F.slice(fields, 1, 5)).otherwise(fields)
    t.select(F.array_join(fields, ";").alias("value")).write.text(path)
    lines = spark.read.schema(file_ops.RAW_TRANSACTIONS).option("sep", ";").options(**file_ops.RAW_OPTIONS).csv(path)
    return file_ops.parse_transactions(lines).filter("_reject is not null").select(
        F.split("_amount_text", ";")[0].cast("long").alias("trans_id"), F.col("_reject").alias("reason"))


def q_scan_snapshot(spark, d):
    path = scratch_path(spark, "input") + "/terminals_01012024.csv"
    snap = chain_ops.current(fx.terminals(spark, d)).select(
        F.col("terminal_id").cast("string").alias("terminal_id"), "terminal_type", "terminal_city",
        "terminal_address")
    snap.write.option("sep", ";").option("header", True).mode("overwrite").csv(path)
    return file_ops.read_terminals(spark, path)


def q_scan_snapshot_xlsx(spark, d):
    """The current terminals written as workbooks (one per partition) and read back by the xlsx job."""
    from tallyhawk.sources.excel import write_xlsx_files
    path = scratch_path(spark, "input") + "/terminals_01012024.xlsx"
    snap = chain_ops.current(fx.terminals(spark, d)).select(
        "terminal_id", "terminal_type", "terminal_city", "terminal_address")
    write_xlsx_files(snap, path).collect()   # one (path, rows) row per written file
    return file_ops.read_terminals(spark, path)


QUERIES.update({
    "scan_snapshot_xlsx": q_scan_snapshot_xlsx,
    "file_day": q_file_day,
    "pick_files": _pick(STRICT),
    "pick_files_reference": _pick(REFERENCE),
    "decimal_comma": q_decimal_comma,
    "check_unique_key": q_check_unique_key,
    "check_unique_key_customer": q_check_unique_key_customer,
    "check_lengths": q_check_lengths,
    "blacklist_refresh": q_blacklist_refresh,
    "scan_transactions": q_scan_transactions,
    "scan_transactions_rejects": q_scan_transactions_rejects,
    "check_lengths_report": q_check_lengths_report,
    "scan_snapshot": q_scan_snapshot,
})

_NAMES_SQL = """with names as (
    select k || '_' || strftime(d, '%d%m%Y') || case when k = 'transactions' then '.txt' else '.xlsx' end as name,
           k as kind, d as day
    from (select distinct cast(ts as date) as d from events) days,
         (select unnest(['passport_blacklist', 'terminals', 'transactions']) as k) kinds)"""

ORACLE.update({
    "file_day": _NAMES_SQL + " select name, day from names",
    "pick_files": _NAMES_SQL + """, full_days as (select day from names group by day having count(distinct kind) = 3)
        select kind, min(name) as name, day from names where day = (select min(day) from full_days)
        group by kind, day""",
    "pick_files_reference": _NAMES_SQL + """ select kind, min(name) as name,
        arg_min(day, name) as day from names group by kind""",
    "decimal_comma": """select o_orderkey, replace(cast(cast(o_totalprice as decimal(30,2)) as varchar), '.', ',')
          as amount_text,
        cast(cast(replace(replace(cast(cast(o_totalprice as decimal(30,2)) as varchar), '.', ','), ',', '.')
          as decimal(30,2)) as double) as amt from orders""",
    "check_unique_key": "select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 1",
    "check_unique_key_customer":
        "select c_custkey, count(*) as n from customer group by c_custkey having count(*) > 1",
    "check_lengths": "select o_orderkey, o_orderpriority from orders where length(o_orderpriority) > 10",
    "scan_transactions_rejects": """select event_id as trans_id, 'wrong number of fields' as reason from events
        where event_id % 7 = 0 or event_id % 11 = 0""",
    "check_lengths_report": """select 'P' || cast(c_custkey as varchar) as passport, c_name || c_name as fio,
        lpad(cast(c_custkey as varchar), cast(10 + c_custkey % 10 as int), '0') as phone from customer where c_custkey % 10 > 6""",
    "blacklist_refresh": """select 'P' || cast(c_custkey as varchar) as passport_num, date '2024-01-01' as entry_dt
        from customer where c_custkey % 17 = 0""",
    "scan_transactions": oracle.with_views("""select cast(trans_id as varchar) as trans_id,
        date_trunc('second', trans_date) as trans_date, cast(cast(amt as decimal(30,2)) as double) as amt,
        cast(card_num as varchar) as card_num, oper_type, oper_result, cast(terminal as varchar) as terminal,
        cast(date_trunc('second', trans_date) as date) as trans_day from tx""", "tx"),
    "scan_snapshot": oracle.with_views("""select cast(terminal_id as varchar) as terminal_id, terminal_type,
        terminal_city, terminal_address from terminals
        where deleted_flg = false and effective_to = date '2999-01-01'""", "terminals"),
})
ORACLE["scan_snapshot_xlsx"] = ORACLE["scan_snapshot"]


# --- the daily run end to end ------ -----------------------------------------------------


PIPELINE_DAYS = (_dt.date(2024, 1, 1), _dt.date(2024, 1, 2), _dt.date(2024, 1, 3))


def _daily_sources(spark, d):
    """info.* tables from customer; update_dt is NULL, so every row is restaged daily."""
    c = fx.table(spark, d, "customer")
    k = F.col("c_custkey")
    none = F.lit(None).cast("date")
    s = lambda e: e.cast("string")
    cards = c.filter(k % 19 != 0).select(s(k).alias("card_num"), s(k + 1000000).alias("account"),
                                         none.alias("update_dt"))
    accounts = c.select(s(k + 1000000).alias("account"),
                        F.date_add(F.lit(fx.BASE_DAY), ((k * 11) % 45).cast("int")).alias("valid_to"),
                        s(k + 2000000).alias("client"), none.alias("update_dt"))
    clients = fx.source_clients(spark, d).withColumn("client_id", s(F.col("client_id"))) \
        .withColumn("update_dt", none)
    return pipe.Sources(cards, accounts, clients)


def _three_days_tx(spark, d):
    """All operations, dealt by day of month onto three business days; the time of day stays."""
    t = fx.tx(spark, d)
    shift = F.make_dt_interval(days=(F.dayofmonth("trans_day") - 1) % 3 + 1 - F.dayofmonth("trans_day"))
    moved = (F.col("trans_date") + shift).cast("timestamp_ntz")
    return t.withColumn("trans_date", moved).withColumn("trans_day", F.to_date("trans_date"))


def write_day_inputs(spark, d, input_dir, day):
    """The three input files of one day, written by Spark from the driver tables."""
    name = day.strftime("%d%m%Y")
    write_transactions_file(_three_days_tx(spark, d).filter(F.col("trans_day") == F.lit(day)),
                            f"{input_dir}/transactions_{name}.txt")
    write_snapshot_files(spark, d, input_dir, day)


def write_snapshot_files(spark, d, input_dir, day):
    """The terminals and blacklist files of one day."""
    name = day.strftime("%d%m%Y")
    term = chain_ops.current(fx.terminals(spark, d)).select(
        F.col("terminal_id").cast("string").alias("terminal_id"), "terminal_type", "terminal_city",
        "terminal_address")
    term.write.option("sep", ";").option("header", True).mode("overwrite").csv(f"{input_dir}/terminals_{name}.csv")
    bl = fx.blacklist(spark, d).select(F.date_format("entry_dt", "yyyy-MM-dd").alias("date"),
                                       F.col("passport_num").alias("passport"))
    bl.write.option("sep", ";").option("header", True).mode("overwrite") \
        .csv(f"{input_dir}/passport_blacklist_{name}.csv")


def _run_daily(spark, d, replay=False, semantics=REFERENCE):
    base = scratch_path(spark, "daily")
    inp, arc = f"{base}/input", f"{base}/archive"
    for day in PIPELINE_DAYS:
        write_day_inputs(spark, d, inp, day)
    wh = Warehouse(spark, f"{base}/warehouse")
    src = _daily_sources(spark, d)
    pipe.run_days(spark, wh, inp, arc, src, semantics=semantics)
    if replay:
        pipe.reset(spark, wh, inp, arc, replay if isinstance(replay, _dt.date) else None)
        pipe.run_days(spark, wh, inp, arc, src, semantics=semantics)
    return wh


def _report_of(wh):
    return wh.read_report().select("event_dt", "passport", "fio", "phone", "event_type", "report_dt", "event_ts")


def q_daily_run_straggler_rerun(spark, d):
    """Three days of which the last is loaded twice: first from a file with half its rows, after an attempt that
    stopped before it published, then from the whole file."""
    base = scratch_path(spark, "daily")
    inp, arc = f"{base}/input", f"{base}/archive"
    for day in PIPELINE_DAYS:
        write_day_inputs(spark, d, inp, day)
    wh, src = Warehouse(spark, f"{base}/warehouse"), _daily_sources(spark, d)
    pipe.run_days(spark, wh, inp, arc, src, max_days=2)
    last = PIPELINE_DAYS[-1]
    tx_file = f"{inp}/transactions_{last:%d%m%Y}.txt"
    day_tx = _three_days_tx(spark, d).filter(F.col("trans_day") == F.lit(last))
    write_transactions_file(day_tx.filter(F.col("trans_id") % 2 == 0), tx_file)
    stopped = Warehouse(spark, f"{base}/warehouse")
    stopped.commit = lambda *a, **k: (_ for _ in ()).throw(InterruptedError("stopped before publishing"))
    try:
        pipe.run_day(spark, stopped, inp, arc, src)
    except InterruptedError:
        pass
    pipe.run_day(spark, wh, inp, arc, src)
    write_transactions_file(day_tx, tx_file)
    write_snapshot_files(spark, d, inp, last)
    pipe.run_day(spark, wh, inp, arc, src)
    return _report_of(wh)


def q_daily_run_facts(spark, d):
    """Operations and amounts a day in the facts of the three loads: every row of events is there."""
    return _run_daily(spark, d).read_facts().groupBy("trans_day").agg(
        F.count("*").alias("n"), F.sum("amt").cast("double").alias("total"))


def q_daily_backfill(spark, d):
    """The three days loaded at once: no fold."""
    base = scratch_path(spark, "daily")
    for day in PIPELINE_DAYS:
        write_day_inputs(spark, d, f"{base}/input", day)
    wh = Warehouse(spark, f"{base}/warehouse")
    backfill.backfill(spark, wh, f"{base}/input", f"{base}/archive", _daily_sources(spark, d))
    return _report_of(wh)


QUERIES.update({
    "daily_backfill_three_days": q_daily_backfill,
    "daily_run_three_days": lambda spark, d: _report_of(_run_daily(spark, d)),
    "replay_equals_first_run": lambda spark, d: _report_of(_run_daily(spark, d, replay=True)),
    "replay_from_day": lambda spark, d: _report_of(_run_daily(spark, d, replay=PIPELINE_DAYS[1])),
    "daily_run_three_days_strict": lambda spark, d: _report_of(_run_daily(spark, d, semantics=STRICT)),
    "daily_run_straggler_rerun": q_daily_run_straggler_rerun,
    "daily_run_facts": q_daily_run_facts,
})

_DAILY_VIEWS = {
    "tx": """select cast(event_id as varchar) as trans_id, date_trunc('second', ts) as trans_date,
        cast(ts as date) as trans_day, cast(cast(value as decimal(30,2)) as double) as amt,
        cast(user_id as varchar) as card_num, event_type as oper_type,
        case when event_type in ('click','view','error') then 'REJECT'
             when event_type = 'purchase' then 'SUCCESS' else 'OTHER' end as oper_result,
        json_extract_string(props, '$.k') as terminal
      from (select * replace (cast(ts + to_days(cast((day(ts) - 1) % 3 + 1 - day(ts) as int)) as timestamp) as ts)
            from events) events""",
    "terminals": """select cast(terminal_id as varchar) as terminal_id, 'CITY_' || cast(terminal_id % 5 as varchar)
        as terminal_city, date '2999-01-01' as effective_to, false as deleted_flg
      from (select distinct cast(json_extract_string(props, '$.k') as int) as terminal_id from events)
      where terminal_id % 23 <> 0""",
    "chain": """select cast(c_custkey as varchar) as card_num, cast(c_custkey + 1000000 as varchar) as account_num,
        cast(date '2024-01-01' + cast((c_custkey * 11) % 45 as int) as date) as valid_to,
        cast(c_custkey + 2000000 as varchar) as client_id,
        split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) || ' ' ||
          (case when c_custkey % 6 = 0 then null else 'N' || cast(c_custkey % 7 as varchar) end) as fio,
        'P' || cast(c_custkey as varchar) as passport_num,
        case when c_custkey % 29 = 3 then null
             else cast(date '2024-01-01' + cast((c_custkey * 7) % 60 as int) as date) end as passport_valid_to,
        '+7' || lpad(cast(c_custkey as varchar), 10, '0') as phone
      from customer where c_custkey % 19 <> 0""",
}
ORACLE.update({
    "daily_run_three_days": oracle.report_sql(_DAILY_VIEWS),
    "replay_equals_first_run": oracle.report_sql(_DAILY_VIEWS),
    "replay_from_day": oracle.report_sql(_DAILY_VIEWS),
    "daily_run_three_days_strict": oracle.report_sql(_DAILY_VIEWS, strict=True),
    "daily_backfill_three_days": oracle.report_sql(_DAILY_VIEWS, strict=True),
    "daily_run_straggler_rerun": oracle.report_sql(_DAILY_VIEWS),
    "daily_run_facts": """with tx as (""" + _DAILY_VIEWS["tx"] + """)
        select trans_day, count(*) as n, cast(sum(cast(amt as decimal(30,2))) as double) as total from tx group by trans_day""",
})


# --- many days in one job (as-of) --------------------------------------------------------


ASOF_DAYS = (_dt.date(2024, 1, 1), _dt.date(2024, 1, 10), _dt.date(2024, 1, 20))


def _all_snapshots(spark, d, days):
    snaps = [fx.snapshot(spark, d, n).withColumn("day", F.lit(day)) for n, day in zip((1, 2, 3), days)]
    return snaps[0].unionByName(snaps[1]).unionByName(snaps[2])


def q_scd2_from_snapshots(spark, d):
    return asof_ops.scd2_from_snapshots(_all_snapshots(spark, d, fx.SCD2_DAYS), "k", ["s"])


def q_asof_join(spark, d):
    """Each transaction with the card's version (attribute s) valid on its day."""
    hist = asof_ops.scd2_from_snapshots(_all_snapshots(spark, d, ASOF_DAYS), "k", ["s"])
    t = fx.tx(spark, d).select("trans_id", "card_num", "trans_day")
    return asof_ops.asof_join(t, hist, "card_num", "k", "trans_day", ["s"])


QUERIES.update({
    "scd2_from_snapshots": q_scd2_from_snapshots,
    "asof_join": q_asof_join,
})
ORACLE.update({
    "scd2_from_snapshots": oracle.scd2_fold_sql("generic", "snapshot", True),
    "asof_join": oracle.scd2_fold_sql(
        "generic", "snapshot", True, day_list=[x.isoformat() for x in ASOF_DAYS],
        # the final clause extends the fold's CTE list with the transactions view
        final=""", tx as ({tx})
        select t.trans_id, t.card_num, t.trans_day, h.s from tx t join h3 h
          on h.k = t.card_num and h.effective_from <= t.trans_day and t.trans_day <= h.effective_to"""
        .format(tx=oracle.VIEWS["tx"])),
})


# --- streaming ----------------------------------------------------------------------------


STREAM_CHUNKS = ((1, 10), (11, 20), (21, 31))


def q_stream_amount_probe(spark, d):
    """Rule 4 per card across days (3-day span): three files of four unsorted parts each, a few parts a batch."""
    base = scratch_path(spark, "stream")
    tx = fx.tx(spark, d)
    for lo, hi in STREAM_CHUNKS:
        part = tx.filter(F.dayofmonth("trans_day").between(lo, hi))
        write_transactions_file(part.repartition(4, "trans_id"), f"{base}/input/transactions_{lo:02d}012024.txt")
    q = stream_ops.run_probe_stream(spark, f"{base}/input/transactions_*/part-*.csv", f"{base}/out", f"{base}/checkpoint",
                                    max_span="3 days", delay="31 days", max_files_per_trigger=3)
    q.awaitTermination()
    stream_ops.settle(spark, f"{base}/out", f"{base}/checkpoint", q.lastProgress["batchId"], max_span="3 days")
    return stream_ops.read_hits(spark, f"{base}/out")


QUERIES["stream_amount_probe"] = q_stream_amount_probe


def q_stream_ingest_three_days(spark, d):
    """The three daily loads triggered by a file stream (foreachBatch) instead of a loop."""
    from tallyhawk.streaming.ingest import ingest_on_arrival
    base = scratch_path(spark, "ingest")
    inp = f"{base}/input"
    for day in reversed(PIPELINE_DAYS):          # arrive out of order; loaded by parsed day
        write_day_inputs(spark, d, inp, day)
    wh = Warehouse(spark, f"{base}/warehouse")
    ingest_on_arrival(spark, wh, inp, f"{base}/archive", _daily_sources(spark, d),
                      f"{base}/checkpoint").awaitTermination()
    return _report_of(wh)


QUERIES["stream_ingest_three_days"] = q_stream_ingest_three_days
ORACLE["stream_ingest_three_days"] = ORACLE["daily_run_three_days"]

_STREAM_TX = {"tx": _DAILY_VIEWS["tx"].split("from (select * replace")[0] + "from events"}
ORACLE["stream_amount_probe"] = f"""{oracle._ctes("tx", views=_STREAM_TX)},
      {oracle.r4_hits_sql("interval 3 day", per_day=False)}
    select trans_id, card_num, trans_day, trans_date from h"""


# --- the report under a hot card ------------------------------------------------------------
# A third of all operations moved onto card 1 (an existing, active card): the skew the plans
# are built for, over the whole events table.

HOT_CARD = 1
#: Rows of a stretch: the hot card's windows are cut at every scale of the driver tables.
HOT_CARD_ROWS = 100


def q_fraud_report_hot_card(spark, d):
    tx = fx.tx(spark, d).withColumn(
        "card_num", F.when(F.col("trans_id") % 3 == 0, F.lit(HOT_CARD).cast("long")).otherwise(F.col("card_num")))
    return fraud.fraud_report(tx, _chain(spark, d), fx.blacklist(spark, d), fx.terminals(spark, d),
                              semantics=REFERENCE, hot_rows=HOT_CARD_ROWS)


QUERIES["fraud_report_hot_card"] = q_fraud_report_hot_card
ORACLE["fraud_report_hot_card"] = oracle.report_sql({"tx": oracle.VIEWS["tx"].replace(
    "user_id as card_num", f"case when event_id % 3 = 0 then {HOT_CARD} else user_id end as card_num")})

# --- many days in one job, over dimensions that change daily -------------------------------------
QUERIES.update(asof_catalog.QUERIES)
ORACLE.update(asof_catalog.ORACLE)
