"""FIXTURES §2.3-2.5: rule boundaries in both semantics, split and unsplit windows."""

import datetime as dt

import pytest

from tallyhawk.operators import fraud
from tallyhawk.schemas import REFERENCE, STRICT
from conftest import cut_every

DAY = dt.date(2021, 3, 1)
SPLITS = [None, "1 hour", "7 minutes"]


def _ts(hm, day=DAY):
    h, m = hm.split(":")[:2]
    s = int(hm.split(":")[2]) if hm.count(":") == 2 else 0
    return dt.datetime(day.year, day.month, day.day, int(h), int(m), s)


def _terminals(spark):
    rows = [("M", "ATM", "Moscow", "a", DAY, dt.date(2999, 1, 1), False),
            ("S", "ATM", "SPB", "b", DAY, dt.date(2999, 1, 1), False),
            ("X", "ATM", "Omsk", "c", DAY, dt.date(2021, 2, 1), True)]
    return spark.createDataFrame(rows, "terminal_id string, terminal_type string, terminal_city string, "
                                       "terminal_address string, effective_from date, effective_to date, "
                                       "deleted_flg boolean")


def _tx(spark, rows):
    """rows: (card, 'HH:MM[:SS]', terminal, result, amount[, day])"""
    out = []
    for i, r in enumerate(rows):
        day = r[5] if len(r) > 5 else DAY
        ts = _ts(r[1], day) if isinstance(r[1], str) else r[1]
        out.append((str(i).zfill(4), ts, ts.date(), r[4], r[0], r[3], r[2]))
    return spark.createDataFrame(out, "trans_id string, trans_date timestamp_ntz, trans_day date, amt double, "
                                      "card_num string, oper_result string, terminal string")


HOPS = {
    "a": [("a", "10:00", "M"), ("a", "10:30", "S")],
    "b": [("b", "10:00", "M"), ("b", "10:30", "M"), ("b", "20:00", "S"), ("b", "20:30", "S")],
    "c": [("c", "10:00", "M"), ("c", "10:30", "S"), ("c", "10:50", "S")],
    "d": [("d", "10:00", "M"), ("d", "11:00", "S"), ("d", "11:10", "S")],
    # deleted terminal between two others is ignored before LEAD
    "e": [("e", "10:00", "M"), ("e", "10:10", "X"), ("e", "10:20", "S"), ("e", "10:30", "S")],
    # 23:50 and 00:10 next day never pair
    "f": [("f", "23:50", "M"), ("f", dt.datetime(2021, 3, 2, 0, 10), "S")],
}
EXPECT = {
    REFERENCE: {"a": None, "b": "10:00:00", "c": "10:00:00", "d": None, "e": "10:00:00", "f": None},
    STRICT: {"a": "10:30:00", "b": None, "c": "10:30:00", "d": None, "e": "10:20:00", "f": None},
}


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("semantics", [REFERENCE, STRICT])
def test_city_hop(spark, semantics, split):
    rows = [(c, t, term, "SUCCESS", 1.0) for seq in HOPS.values() for (c, t, term) in seq]
    tx = _tx(spark, rows)
    hits = fraud.city_hops(tx, _terminals(spark), semantics=semantics, hot=cut_every(tx, split))
    got = {r.card_num: r.event_ts.strftime("%H:%M:%S") for r in hits.collect()}
    want = {k: v for k, v in EXPECT[semantics].items() if v is not None}
    assert got == want


PROBES = {
    "basic": ([("R", 100, "00:00"), ("R", 90, "00:05"), ("R", 80, "00:10"), ("S", 70, "00:15")], ["00:15:00"]),
    "equal": ([("R", 100, "00:00"), ("R", 100, "00:01"), ("R", 100, "00:02"), ("S", 100, "00:03")], ["00:03:00"]),
    "boundary": ([("R", 9, "00:00"), ("R", 8, "00:01"), ("R", 7, "00:02"), ("S", 6, "00:20:00")], ["00:20:00"]),
    "over": ([("R", 9, "00:00"), ("R", 8, "00:01"), ("R", 7, "00:02"), ("S", 6, "00:20:01")], []),
    "rising": ([("R", 70, "00:00"), ("R", 80, "00:01"), ("R", 90, "00:02"), ("S", 100, "00:03")], []),
    "broken": ([("R", 9, "00:00"), ("S", 8, "00:01"), ("R", 7, "00:02"), ("R", 6, "00:03"), ("S", 5, "00:04")], []),
    "long": ([("R", 9, "00:00"), ("R", 8, "00:01"), ("R", 7, "00:02"), ("R", 6, "00:03"), ("S", 5, "00:04")],
             ["00:04:00"]),
    "short": ([("R", 9, "00:00"), ("R", 8, "00:01"), ("S", 7, "00:02")], []),
}
LABEL = {"R": "REJECT", "S": "SUCCESS"}


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("case", sorted(PROBES))
def test_amount_probe(spark, case, split):
    seq, want = PROBES[case]
    # start at 10:50 so 20-minute sequences cross hour and 7-minute chunk boundaries
    base = dt.datetime(2021, 3, 1, 10, 50)
    rows = []
    for res, amt, t in seq:
        parts = [int(x) for x in t.split(":")]
        off = dt.timedelta(minutes=parts[0] * 60 + parts[1], seconds=parts[2] if len(parts) == 3 else 0)
        rows.append((case, base + off, "M", LABEL[res], float(amt)))
    tx = _tx(spark, rows)
    hits = fraud.amount_probes(tx, hot=cut_every(tx, split))
    got = sorted(((r.trans_date - base).seconds for r in hits.collect()))
    want_s = sorted(int(w.split(":")[0]) * 3600 + int(w.split(":")[1]) * 60 + int(w.split(":")[2]) for w in want)
    assert got == want_s


def _chain(spark, valid_to, pvt):
    return spark.createDataFrame(
        [("c1", "acc", valid_to, "cl", "Fio", "P1", pvt, "+7")],
        "card_num string, account_num string, valid_to date, client_id string, fio string, "
        "passport_num string, passport_valid_to date, phone string")


CONTRACT_CASES = [
    # (valid_to offset days, time, listed, rule1, rule2 ref, rule2 strict)
    (0, "00:00:01", False, True, True, False),
    (0, "00:00:00", False, True, False, False),
    (-1, "12:00:00", False, True, True, True),
    (None, "12:00:00", False, False, False, False),
    (5, "12:00:00", True, True, False, False),
]


@pytest.mark.parametrize("case", CONTRACT_CASES)
def test_passport_and_contract(spark, case):
    off, t, listed, r1, r2, r2s = case
    vt = None if off is None else DAY + dt.timedelta(days=off)
    tx = _tx(spark, [("c1", t, "M", "SUCCESS", 1.0)])
    chain = _chain(spark, vt, vt)
    bl = spark.createDataFrame([("P1" if listed else "P9", DAY)], "passport_num string, entry_dt date")
    assert (fraud.fraud_expired_passport(tx, chain, bl).count() == 1) == r1
    assert (fraud.fraud_expired_contract(tx, chain, REFERENCE).count() == 1) == r2
    assert (fraud.fraud_expired_contract(tx, chain, STRICT).count() == 1) == r2s


def test_closed_card_is_not_reported(spark):
    from tallyhawk.operators.chain import dim_chain
    cards = spark.createDataFrame([("c1", "acc", DAY, DAY, True)],
                                  "card_num string, account_num string, effective_from date, effective_to date, "
                                  "deleted_flg boolean")
    accounts = spark.createDataFrame([("acc", DAY, "cl", DAY, dt.date(2999, 1, 1), False)],
                                     "account_num string, valid_to date, client string, effective_from date, "
                                     "effective_to date, deleted_flg boolean")
    clients = spark.createDataFrame([("cl", "Fio", DAY, "P1", DAY, "+7", DAY, dt.date(2999, 1, 1), False)],
                                    "client_id string, fio string, date_of_birth date, passport_num string, "
                                    "passport_valid_to date, phone string, effective_from date, effective_to date, "
                                    "deleted_flg boolean")
    chain = dim_chain(cards, accounts, clients)
    tx = _tx(spark, [("c1", "12:00", "M", "SUCCESS", 1.0)])
    bl = spark.createDataFrame([("P1", DAY)], "passport_num string, entry_dt date")
    assert fraud.fraud_expired_passport(tx, chain, bl).count() == 0
    assert fraud.fraud_expired_contract(tx, chain).count() == 0


def test_passport_rule_entry_date_option(spark):
    """Q13: the blacklist's entry date is ignored by default; optionally it must precede the operation."""
    tx = _tx(spark, [("c1", "12:00", "M", "SUCCESS", 1.0)])
    chain = _chain(spark, DAY + dt.timedelta(days=5), DAY + dt.timedelta(days=5))
    bl = spark.createDataFrame([("P1", DAY + dt.timedelta(days=1))], "passport_num string, entry_dt date")
    assert fraud.fraud_expired_passport(tx, chain, bl).count() == 1
    assert fraud.fraud_expired_passport(tx, chain, bl, check_entry_date=True).count() == 0
    early = spark.createDataFrame([("P1", DAY)], "passport_num string, entry_dt date")
    assert fraud.fraud_expired_passport(tx, chain, early, check_entry_date=True).count() == 1
