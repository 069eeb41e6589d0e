"""The four rules over many days in one job, each operation judged by the rows valid on its own day.

The daily run judges a day by the rows current after that day's load, so its results depend on loading the
days in order. With the dimensions' histories the same report comes from one query: the histories are
intersected into versions of the card -> account -> client chain (:func:`tallyhawk.operators.asof.temporal_chain`),
and every lookup is an equi join on the key whose residual condition picks the version of the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.functions.scalars import time_of_day
from tallyhawk.operators import fraud, sequence
from tallyhawk.operators.asof import asof_join, temporal_chain
from tallyhawk.schemas import (
    CITY_HOP_GAP,
    EVENT_AMOUNT_PROBE,
    EVENT_CITY_HOP,
    EVENT_CONTRACT,
    EVENT_PASSPORT,
    PROBE_SPAN,
    REFERENCE,
    STRICT,
)

_CLIENT = ["passport_num", "fio", "phone"]


def listed_days(blacklist: DataFrame) -> DataFrame:
    """passport_num, listed: the stretches of days on which a passport is on the list (one a change of the list)."""
    stretch = F.struct(F.col("effective_from").alias("since"), F.col("effective_to").alias("until"))
    return blacklist.groupBy("passport_num").agg(F.collect_set(stretch).alias("listed"))


def flagged_chain(chain: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Chain versions with the stretches on which their passport is listed (NULL: never)."""
    return chain.join(listed_days(blacklist), "passport_num", "left")


def _listed_between(since: Column, until: Column) -> Column:
    return F.coalesce(F.exists("listed", lambda x: (x["since"] <= until) & (since <= x["until"])), F.lit(False))


def fraud_report_asof(tx: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame, terminals: DataFrame,
                      blacklist: DataFrame, semantics: str = STRICT, city_gap=CITY_HOP_GAP, probe_span=PROBE_SPAN,
                      hot: DataFrame | str | None = sequence.FIND, hot_rows: int | None = None) -> DataFrame:
    """All four rules over every day of ``tx`` as one bag union; ``report_dt`` is the operation's day.

    ``cards``, ``accounts``, ``clients`` and ``terminals`` are strict histories, ``blacklist`` one of the daily
    lists (passport_num, effective_from, effective_to). ``semantics`` chooses the variant of rules 2 to 4, which
    strict takes across midnight for rule 4. Equal to the daily reports of a strict fold over the same days.

    Operations meet only the chain versions that can hit rules 1 and 2 while they are valid (usually few); rules 3
    and 4 look up their hits.
    """
    fraud._check_semantics(semantics)
    chain = flagged_chain(temporal_chain(cards, accounts, clients), blacklist)
    valid = ["effective_from", "effective_to"]
    last = F.col("effective_to")
    may_hit = chain.filter(_listed_between(F.col("effective_from"), last) | (F.col("passport_valid_to") <= last)
                           | (F.col("valid_to") <= last))
    ops = tx.select("card_num", F.col("trans_date").alias("event_ts"), "trans_day")
    j12 = asof_join(ops, may_hit, "card_num", "card_num", "trans_day", ["valid_to", "passport_valid_to", "listed", *_CLIENT])
    day = F.col("trans_day")
    rule_1 = _listed_between(day, day) | (F.col("passport_valid_to") <= day)
    rule_2 = F.col("valid_to").cast("timestamp_ntz") < F.col("event_ts") if semantics == REFERENCE else F.col("valid_to") < day
    kinds = F.array(F.when(rule_1, F.lit(EVENT_PASSPORT)), F.when(rule_2, F.lit(EVENT_CONTRACT)))
    rows12 = j12.select("event_ts", "trans_day", *_CLIENT, F.explode(F.array_compact(kinds)).alias("event_type"))

    hot = sequence.resolve(hot, tx, "card_num", "trans_date", hot_rows)
    located = asof_join(tx.select("card_num", "trans_day", "trans_date", "trans_id", "terminal"), terminals, "terminal",
                        "terminal_id", "trans_day", ["terminal_city"])
    hops = fraud.located_city_hops(located, city_gap, semantics, hot).select(
        "card_num", "event_ts", "trans_day", F.lit(EVENT_CITY_HOP).alias("event_type"))
    probes = fraud.amount_probes(tx, max_span=probe_span, per_day=(semantics == REFERENCE), hot=hot).select(
        "card_num", F.col("trans_date").alias("event_ts"), "trans_day", F.lit(EVENT_AMOUNT_PROBE).alias("event_type"))
    j34 = asof_join(hops.unionByName(probes), chain.select("card_num", *_CLIENT, *valid), "card_num", "card_num", "trans_day", _CLIENT)

    rows = rows12.unionByName(j34.select(*rows12.columns))
    return rows.select(time_of_day("event_ts").alias("event_dt"), F.col("passport_num").alias("passport"), "fio", "phone",
                       F.col("event_type").cast("int").alias("event_type"), F.col("trans_day").alias("report_dt"), "event_ts")
