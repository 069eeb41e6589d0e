"""Registered queries over dimensions that change from day to day, each in one job for all days, and their SQL.

The driver's customers and terminals become thirty daily snapshots (January 2024, the days of the events):

  cards      missing on days where (k + n) mod 17 = 0; from day 15 on, every third card is paid from the account of
             the first customer of its ten
  accounts   every fourth contract is renewed by 20 days on day k mod 20
  clients    every fifth client has another passport, valid 40 days longer, from day k mod 25
  blacklist  P<k> of every thirteenth client, from day k mod 30; even ones are taken off after day 25
  terminals  another city every ten days; missing on days where (id + n) mod 23 = 0

with k = c_custkey and n = days since 2024-01-01. The SQL reads the snapshot of an operation's own day, without any
history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.operators import asof, report_asof
from tallyhawk.plans import fixtures as fx
from tallyhawk.plans import oracle
from tallyhawk.schemas import REFERENCE, STRICT

DAYS = 30


def _daily(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Every row once a day, with the day and its number ``n``; ``rows`` rows are first dealt to tasks that stay small."""
    df = df if rows is None else df.repartition(asof.tasks_for(rows * DAYS))
    return df.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(DAYS - 1)))).withColumn("day", F.date_add(F.lit(fx.BASE_DAY), F.col("n")))


def _date(plus: Column) -> Column:
    return F.date_add(F.lit(fx.BASE_DAY), plus.cast("int"))


def snapshots(spark: SparkSession, d: str, customers: int | None = None) -> dict[str, DataFrame]:
    k, n = F.col("c_custkey"), F.col("n")
    c = _daily(fx.table(spark, d, "customer").select("c_custkey", "c_name"), customers)
    moved = (k % 3 == 0) & (n >= 15) & (k % 10 != 0)
    renewed = F.when((k % 4 == 0) & (n >= k % 20), 20).otherwise(0)
    fresh = (k % 5 == 0) & (n >= k % 25)
    number = F.concat(F.when(fresh, F.lit("Q")).otherwise(F.lit("P")), k.cast("string"))
    t = F.col("terminal_id")
    ids = _daily(fx.tx(spark, d).select(F.col("terminal").alias("terminal_id")).distinct())
    return {
        "cards": c.filter((k + n) % 17 != 0).select(
            k.alias("card_num"), (F.when(moved, k - k % 10 + 1).otherwise(k) + 1000000).alias("account_num"), "day"),
        "accounts": c.select((k + 1000000).alias("account_num"), _date(k * 11 % 45 + renewed).alias("valid_to"),
                             (k + 2000000).alias("client"), "day"),
        "clients": c.select(
            (k + 2000000).alias("client_id"), F.col("c_name").alias("fio"), number.alias("passport_num"),
            F.when(k % 29 != 3, _date(k * 7 % 60 + F.when(fresh, 40).otherwise(0))).alias("passport_valid_to"),
            F.concat(F.lit("+7"), F.lpad(k.cast("string"), 10, "0")).alias("phone"), "day"),
        "blacklist": c.filter((k % 13 == 0) & (n >= k % 30) & ((k % 2 != 0) | (n <= 25))).select(
            F.concat(F.lit("P"), k.cast("string")).alias("passport_num"), _date(k % 30).alias("entry_dt"), "day"),
        "terminals": ids.filter((t + n) % 23 != 0).select(
            t, F.concat(F.lit("CITY_"), ((t + F.floor(n / 10)) % 5).cast("string")).alias("terminal_city"), "day"),
    }


#: Key and attributes of each history.
SHAPES = {"cards": ("card_num", ["account_num"]), "accounts": ("account_num", ["valid_to", "client"]),
          "clients": ("client_id", ["fio", "passport_num", "passport_valid_to", "phone"]),
          "terminals": ("terminal_id", ["terminal_city"]), "blacklist": ("passport_num", ["entry_dt"])}


def histories(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    calendar = spark.range(DAYS).select(_date(F.col("id")).alias("day"))
    customers = fx.table(spark, d, "customer").count()   # from the files' footers; an upper bound of all but the terminals
    return {name: asof.scd2_from_snapshots(df, *SHAPES[name], days=calendar, rows=None if name == "terminals" else customers * DAYS)
            for name, df in snapshots(spark, d, customers).items()}


def q_temporal_chain(spark, d):
    """The chain's versions over the thirty days."""
    h = histories(spark, d)
    return asof.temporal_chain(h["cards"], h["accounts"], h["clients"])


def _report(semantics):
    def q(spark, d):
        h = histories(spark, d)
        return report_asof.fraud_report_asof(fx.tx(spark, d), h["cards"], h["accounts"], h["clients"], h["terminals"],
                                             h["blacklist"], semantics, probe_span="3 days" if semantics == STRICT else "1 day")
    return q


QUERIES = {"temporal_chain": q_temporal_chain, "fraud_report_asof": _report(STRICT),
           "fraud_report_asof_reference": _report(REFERENCE)}

_VIEWS = f"""with {", ".join(f"{n} as ({oracle.VIEWS[n]})" for n in ("tx",))},
  days as (select cast(i as int) as n, cast(date '2024-01-01' + cast(i as int) as date) as day from generate_series(0, {DAYS - 1}) as g(i)),
  c as (select c_custkey as k, c_name, n, day from customer, days),
  cards as (select k as card_num, day, 1000000 + case when k % 3 = 0 and n >= 15 and k % 10 <> 0 then k - k % 10 + 1 else k end as account_num
    from c where (k + n) % 17 <> 0),
  accounts as (select k + 1000000 as account_num, k + 2000000 as client_id, day,
    cast(date '2024-01-01' + cast(k * 11 % 45 + case when k % 4 = 0 and n >= k % 20 then 20 else 0 end as int) as date) as valid_to from c),
  clients as (select k + 2000000 as client_id, day, c_name as fio,
    case when k % 5 = 0 and n >= k % 25 then 'Q' else 'P' end || cast(k as varchar) as passport_num,
    case when k % 29 <> 3 then cast(date '2024-01-01' + cast(k * 7 % 60 + case when k % 5 = 0 and n >= k % 25 then 40 else 0 end as int) as date)
      end as passport_valid_to, '+7' || lpad(cast(k as varchar), 10, '0') as phone from c),
  blacklist as (select 'P' || cast(k as varchar) as listed, day from c where k % 13 = 0 and n >= k % 30 and (k % 2 <> 0 or n <= 25)),
  terminals as (select terminal_id, day, 'CITY_' || cast((terminal_id + n // 10) % 5 as varchar) as terminal_city
    from (select distinct terminal as terminal_id from tx), days where (terminal_id + n) % 23 <> 0),
  chain as (select card_num, day, account_num, valid_to, client_id, fio, passport_num, passport_valid_to, phone
    from cards join accounts using (account_num, day) join clients using (client_id, day))"""

_CHAIN = "card_num, account_num, valid_to, client_id, fio, passport_num, passport_valid_to, phone"


def _report_sql(strict: bool) -> str:
    rule_2 = "valid_to < trans_day" if strict else "cast(valid_to as timestamp) < trans_date"
    hits = oracle.r3_hits_sql(strict=strict, sfx="3")
    hits = f"""j3 as (select t.card_num, t.trans_day, t.trans_date, t.trans_id, m.terminal_city
        from tx t join terminals m on m.terminal_id = t.terminal and m.day = t.trans_day),
      {hits[hits.index("a3 as ("):]}"""
    out = oracle._report
    return f"""{_VIEWS},
      o as (select * from tx join chain on chain.card_num = tx.card_num and chain.day = tx.trans_day
        left join blacklist b on b.listed = chain.passport_num and b.day = chain.day),
      {hits}, {oracle.r4_hits_sql("interval 3 day" if strict else "interval 1 day", per_day=not strict, sfx="4")}
    select {out('o.trans_date', 1, 'o.trans_day', 'o')} from o where listed is not null or passport_valid_to <= trans_day
    union all select {out('o.trans_date', 2, 'o.trans_day', 'o')} from o where {rule_2}
    union all select {out('h3.event_ts', 3, 'h3.trans_day')} from h3 join chain c on c.card_num = h3.card_num and c.day = h3.trans_day
    union all select {out('h4.trans_date', 4, 'h4.trans_day')} from h4 join chain c on c.card_num = h4.card_num and c.day = h4.trans_day"""


ORACLE = {
    "temporal_chain": f"""{_VIEWS},
      g as (select *, day - cast(row_number() over (partition by {_CHAIN} order by day) as int) as island from chain)
    select {_CHAIN}, min(day) as effective_from,
      case when max(day) = date '2024-01-{DAYS}' then date '2999-01-01' else max(day) end as effective_to
    from g group by {_CHAIN}, island""",
    "fraud_report_asof": _report_sql(True),
    "fraud_report_asof_reference": _report_sql(False),
}
