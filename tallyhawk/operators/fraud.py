"""The four fraud rules and the report.

Inputs are plain DataFrames:

* ``tx``: trans_id, trans_date (timestamp_ntz), trans_day (date), amt,
  card_num, oper_result, terminal -- one or many business days; every
  day is treated as its own daily run (windows never cross days unless a
  rule is asked to).
* ``chain``: the card -> account -> client chain of current rows
  (:func:`tallyhawk.operators.chain.dim_chain`).
* ``blacklist``: passport_num (+ entry_dt).
* ``terminals``: terminal history (current rows are taken here).

Each rule returns report rows: event_dt (HH:mm:ss text), passport, fio,
phone, event_type, report_dt, event_ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.functions.intervals import micros_between, to_micros
from tallyhawk.functions.scalars import time_of_day
from tallyhawk.operators import sequence
from tallyhawk.operators.chain import BROADCAST_MAX_ROWS, broadcast_if_small, current
from tallyhawk.schemas import (
    CITY_HOP_GAP,
    EVENT_AMOUNT_PROBE,
    EVENT_CITY_HOP,
    EVENT_CONTRACT,
    EVENT_PASSPORT,
    PROBE_REJECTS,
    PROBE_SPAN,
    REFERENCE,
    REJECT,
    STRICT,
    SUCCESS,
)

REPORT_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt", "event_ts"]


def _report(df: DataFrame, event_type: int, ts: str, report_dt: Column) -> DataFrame:
    return df.select(
        time_of_day(ts).alias("event_dt"),
        F.col("passport_num").alias("passport"),
        F.col("fio"),
        F.col("phone"),
        F.lit(event_type).cast("int").alias("event_type"),
        report_dt.alias("report_dt"),
        F.col(ts).alias("event_ts"),
    )


def _report_day(report_day) -> Column:
    """The run's day (file day) when given, else each transaction's own day."""
    return F.lit(report_day).cast("date") if report_day is not None else F.col("trans_day")


def _check_semantics(semantics: str) -> None:
    if semantics not in (REFERENCE, STRICT):
        raise ValueError(f"semantics must be {REFERENCE!r} or {STRICT!r}, got {semantics!r}")


# --- rule 1 ----------------------------------------------------------------

def fraud_expired_passport(tx: DataFrame, chain: DataFrame, blacklist: DataFrame,
                           check_entry_date: bool = False,
                           max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rule 1: operation with an expired (``valid_to <= day``) or blacklisted passport.

    One row per transaction; ``report_dt`` is the transaction's day. The
    blacklist meets the chain (one row per card), and the operations meet only
    the cards that can hit. ``check_entry_date`` additionally requires
    ``entry_dt <= day`` (off in the reference).
    """
    flags = chain_with_flags(chain, blacklist, max_broadcast_rows, check_entry_date=check_entry_date)
    may_hit = flags.filter(F.col("_listed") | F.col("passport_valid_to").isNotNull())
    j = tx.select("card_num", "trans_date", "trans_day").join(
        may_hit.select("card_num", "passport_num", "passport_valid_to", "fio", "phone", "_listed_from"), "card_num")
    return _report(j.filter(_rule_1()), EVENT_PASSPORT, "trans_date", F.col("trans_day"))


def _rule_1() -> Column:
    day = F.col("trans_day")
    return F.coalesce(F.col("_listed_from") <= day, F.lit(False)) | (F.col("passport_valid_to") <= day)


# --- rule 2 ----------------------------------------------------------------

def fraud_expired_contract(tx: DataFrame, chain: DataFrame, semantics: str = REFERENCE,
                           report_day=None) -> DataFrame:
    """Rule 2: operation under an expired contract (account ``valid_to``).

    reference: the DATE is promoted to midnight and compared with the
    timestamp, so the contract is already expired during its last day.
    strict: ``valid_to < transaction day``.
    """
    _check_semantics(semantics)
    t = tx.select("card_num", "trans_date", "trans_day")
    j = t.join(chain.select("card_num", "valid_to", "passport_num", "fio", "phone"), "card_num")
    if semantics == REFERENCE:
        expired = F.col("valid_to").cast("timestamp_ntz") < F.col("trans_date")
    else:
        expired = F.col("valid_to") < F.col("trans_day")
    return _report(j.filter(expired), EVENT_CONTRACT, "trans_date", _report_day(report_day))


# --- rule 3 ----------------------------------------------------------------

def city_hops(tx: DataFrame, terminals: DataFrame, max_gap=CITY_HOP_GAP, semantics: str = REFERENCE,
              hot: DataFrame | str | None = sequence.FIND, hot_rows: int | None = None,
              max_broadcast_rows: int = BROADCAST_MAX_ROWS, known_rows: int | None = None) -> DataFrame:
    """Per (card, day): the time of the last city hop within ``max_gap``.

    reference: the gap to the next operation is computed first, rows with a
    gap of ``max_gap`` or more are dropped, and only then is the next city
    taken -- over the surviving rows. ``event_ts`` is the first leg of the
    last hit.
    strict: compare each operation with its true next one; ``event_ts`` is
    the second leg of the last hit.

    Transactions at unknown or inactive terminals are dropped before any of it.
    ``hot`` are the cards whose windows are cut (:mod:`tallyhawk.operators.sequence`), by default looked for.
    """
    _check_semantics(semantics)
    term = current(terminals).select(F.col("terminal_id").alias("terminal"), "terminal_city")
    term = broadcast_if_small(term, max_broadcast_rows, known_rows=known_rows)
    hot = sequence.resolve(hot, tx, "card_num", "trans_date", hot_rows)
    located = tx.select("card_num", "trans_day", "trans_date", "trans_id", "terminal").join(term, "terminal")
    return located_city_hops(located, max_gap, semantics, hot)


def located_city_hops(located: DataFrame, max_gap=CITY_HOP_GAP, semantics: str = REFERENCE,
                      hot: DataFrame | None = None) -> DataFrame:
    """:func:`city_hops` of operations that carry their ``terminal_city``."""
    gap_us = to_micros(max_gap)
    part, order = ["card_num", "trans_day"], ["trans_date", "trans_id"]
    rows = sequence.chunked(located, hot, "card_num", "trans_date")
    nxt = sequence.with_next(rows, part, order, ["trans_date", "terminal_city"])
    close = micros_between("trans_date", "next_trans_date") < F.lit(gap_us)
    if semantics == REFERENCE:
        kept = nxt.filter(close).drop("next_terminal_city", "next_trans_date")
        kept = sequence.with_next(kept, part, order, ["terminal_city"])
        hits = kept.filter(F.col("terminal_city") != F.col("next_terminal_city"))
        ts = "trans_date"
    else:
        hits = nxt.filter(close & (F.col("terminal_city") != F.col("next_terminal_city")))
        ts = "next_trans_date"
    return hits.groupBy(*part).agg(F.max(ts).alias("event_ts"))


def fraud_city_hop(tx: DataFrame, terminals: DataFrame, chain: DataFrame, max_gap=CITY_HOP_GAP,
                   semantics: str = REFERENCE, report_day=None,
                   hot: DataFrame | str | None = sequence.FIND, hot_rows: int | None = None) -> DataFrame:
    """Rule 3: operations in different cities within ``max_gap``; one row per (card, day)."""
    per_card = city_hops(tx, terminals, max_gap, semantics, hot, hot_rows)
    j = per_card.join(chain.select("card_num", "passport_num", "fio", "phone"), "card_num")
    return _report(j, EVENT_CITY_HOP, "event_ts", _report_day(report_day))


# --- rule 4 ----------------------------------------------------------------

def amount_probes(tx: DataFrame, rejects: int = PROBE_REJECTS, max_span=PROBE_SPAN,
                  per_day: bool = True, reject_label: str = REJECT, success_label: str = SUCCESS,
                  hot: DataFrame | str | None = sequence.FIND, hot_rows: int | None = None) -> DataFrame:
    """Successful operations preceded by ``rejects`` rejected ones of non-increasing amount.

    Positions are adjacent rows of the card ordered by (time, id); the span
    from the first reject to the success is at most ``max_span`` (inclusive);
    equal amounts are allowed, and amounts compare in their own type.
    ``per_day`` bounds the sequence to one day (the reference reads one day's
    file); otherwise sequences cross days. ``hot`` are the cards whose windows
    are cut, by default looked for. Returns trans_id, card_num, trans_day,
    trans_date of the success row.
    """
    span_us = to_micros(max_span)
    part, order = ["card_num", "trans_day"] if per_day else ["card_num"], ["trans_date", "trans_id"]

    rows = tx.select("trans_id", "card_num", "trans_day", "trans_date", "oper_result", "amt")
    rows = sequence.chunked(rows, sequence.resolve(hot, tx, "card_num", "trans_date", hot_rows), "card_num", "trans_date")
    prev = sequence.with_previous(rows, part, order, ["oper_result", "amt", "trans_date"], rejects)
    cond = F.col("oper_result") == F.lit(success_label)
    last_amt = F.col("amt")
    for k in range(1, rejects + 1):
        cond = cond & (F.col(f"prev{k}_oper_result") == F.lit(reject_label))
        cond = cond & (F.col(f"prev{k}_amt") >= last_amt)
        last_amt = F.col(f"prev{k}_amt")
    cond = cond & (micros_between(f"prev{rejects}_trans_date", "trans_date") <= F.lit(span_us))
    return prev.filter(cond).select("trans_id", "card_num", "trans_day", "trans_date")


def fraud_amount_probe(tx: DataFrame, chain: DataFrame, rejects: int = PROBE_REJECTS,
                       max_span=PROBE_SPAN, per_day: bool = True, report_day=None,
                       hot: DataFrame | str | None = sequence.FIND, hot_rows: int | None = None) -> DataFrame:
    """Rule 4: amount probing; one row per matching success operation."""
    hits = amount_probes(tx, rejects, max_span, per_day, hot=hot, hot_rows=hot_rows)
    j = hits.join(chain.select("card_num", "passport_num", "fio", "phone"), "card_num")
    return _report(j, EVENT_AMOUNT_PROBE, "trans_date", _report_day(report_day))


# --- report ------------------------------------------------------------------

def chain_with_flags(chain: DataFrame, blacklist: DataFrame, max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                     blacklist_rows: int | None = None, check_entry_date: bool = False) -> DataFrame:
    """The chain with ``_listed`` and ``_listed_from``: the blacklist is joined per card, not per operation.

    A listed passport counts from ever, or with ``check_entry_date`` from its first entry date.
    """
    since = F.min("entry_dt") if check_entry_date else F.first(F.lit("0001-01-01").cast("date"))
    bl = blacklist.groupBy("passport_num").agg(since.alias("_listed_from"))
    bl = broadcast_if_small(bl, max_broadcast_rows, known_rows=blacklist_rows)
    return chain.join(bl, "passport_num", "left").withColumn("_listed", F.col("_listed_from").isNotNull())


def may_hit_rules_1_2(through_day: Column) -> Column:
    """Superset of the cards rules 1 and 2 can report on any day up to ``through_day``.

    Rule 1 needs a listed passport or ``passport_valid_to <= day``; rule 2 (either
    semantics) needs ``valid_to <= day``. Checked on ``chain_with_flags`` rows.
    """
    return (F.col("_listed") | (F.col("passport_valid_to") <= through_day)
            | (F.col("valid_to") <= through_day))


def fraud_report(tx: DataFrame, chain: DataFrame, blacklist: DataFrame, terminals: DataFrame,
                 semantics: str = REFERENCE, report_day=None, probe_tx: DataFrame | None = None,
                 city_gap=CITY_HOP_GAP, probe_span=PROBE_SPAN,
                 hot: DataFrame | str | None = sequence.FIND, hot_rows: int | None = None,
                 max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                 terminal_rows: int | None = None, blacklist_rows: int | None = None,
                 flagged: DataFrame | None = None, flagged_rows: int | None = None,
                 chain_flags: DataFrame | None = None, chain_rows: int | None = None,
                 check_entry_date: bool = False) -> DataFrame:
    """All four rules as one bag union (a transaction may appear under several rules).

    Equal to the union of the four rule functions, planned for size:

    * the blacklist is joined to the chain (one row per card), not to operations;
    * rules 1 and 2 join the day's operations only with the cards that can hit
      them by the report day (listed, or passport / contract expired --
      normally a small part of the chain, so usually a broadcast and no shuffle
      of the operations); the exact conditions are applied after the join;
    * rules 3 and 4 join their per-card hits with the chain.

    ``chain_flags`` / ``flagged`` may be given already built (the daily run
    writes them once, counting rows); ``*_rows`` are row bounds known from
    such writes. ``probe_tx`` is the input of rule 4 where it is not ``tx``: the
    file's rows in the reference, the operations with those shortly before the
    report day in strict, where sequences cross midnight.
    """
    _check_semantics(semantics)
    rd = _report_day(report_day)
    if chain_flags is None:
        chain_flags = chain_with_flags(chain, blacklist, max_broadcast_rows, blacklist_rows, check_entry_date)
    if flagged is None:
        through = F.lit(report_day).cast("date") if report_day is not None else \
            tx.agg(F.max("trans_day")).scalar()
        flagged = chain_flags.filter(may_hit_rules_1_2(through))
    cols = ["card_num", "valid_to", "passport_num", "passport_valid_to", "fio", "phone", "_listed_from"]

    # rules 1 and 2: operations x cards that can hit them
    ops = tx.select("card_num", F.col("trans_date").alias("event_ts"), "trans_day")
    j12 = ops.join(broadcast_if_small(flagged.select(*cols), max_broadcast_rows, known_rows=flagged_rows),
                   "card_num")
    if semantics == REFERENCE:
        r2 = F.col("valid_to").cast("timestamp_ntz") < F.col("event_ts")
    else:
        r2 = F.col("valid_to") < F.col("trans_day")
    et = F.explode(F.array(F.when(_rule_1(), F.lit(EVENT_PASSPORT)), F.when(r2, F.lit(EVENT_CONTRACT)))).alias("_et")
    rows12 = j12.select("*", et).filter(F.col("_et").isNotNull())

    # rules 3 and 4: per-card hits x chain
    hot = sequence.resolve(hot, tx, "card_num", "trans_date", hot_rows)   # once for both
    hops = city_hops(tx, terminals, city_gap, semantics, hot, hot_rows, max_broadcast_rows, terminal_rows) \
        .select("card_num", "event_ts", "trans_day", F.lit(EVENT_CITY_HOP).alias("_et"))
    probes = amount_probes(probe_tx if probe_tx is not None else tx, max_span=probe_span,
                           per_day=(semantics == REFERENCE), hot=hot)
    if report_day is not None and semantics == STRICT:
        probes = probes.filter(F.col("trans_day") == F.lit(report_day).cast("date"))
    probes = probes.select("card_num", F.col("trans_date").alias("event_ts"), "trans_day",
                           F.lit(EVENT_AMOUNT_PROBE).alias("_et"))
    j34 = hops.unionByName(probes).join(
        broadcast_if_small(chain_flags.select(*cols), max_broadcast_rows, known_rows=chain_rows), "card_num")

    rows = rows12.unionByName(j34.select(*rows12.columns))
    return rows.select(
        time_of_day("event_ts").alias("event_dt"),
        F.col("passport_num").alias("passport"), "fio", "phone",
        F.col("_et").cast("int").alias("event_type"),
        F.when(F.col("_et") == EVENT_PASSPORT, F.col("trans_day")).otherwise(rd).alias("report_dt"),
        "event_ts")
