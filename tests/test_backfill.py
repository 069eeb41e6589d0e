"""Days loaded at once equal the strict fold day by day, in a number of jobs that does not grow with the days."""

import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import daygen
from tallyhawk.operators import asof, report_asof, scd2
from tallyhawk.operators.chain import dim_chain
from tallyhawk.plans import asof_catalog
from tallyhawk.plans import fixtures as fx
from tallyhawk.plans.backfill import backfill
from tallyhawk.plans.daily import Sources, reset, run_days
from tallyhawk.plans.state import FACTS, REJECTS, Warehouse
from tallyhawk.schemas import DIMENSIONS, STRICT
from conftest import SF_SMALL


def _rows(df):
    return sorted(map(repr, df.collect()))


def _by_day(spark):
    """The relational sources as snapshots of all days, told apart by a day column."""
    of = daygen.sources(spark)
    frames = [[getattr(of(d), n).withColumn("day", F.lit(d)) for d in daygen.DAYS] for n in ("cards", "accounts", "clients")]
    return Sources(*[reduce(DataFrame.unionByName, f) for f in frames])


def _write(path, days, **more):
    for i in range(days):
        daygen.write_day(str(path), i, **more)
    return str(path)


def test_backfill_equals_the_strict_fold(spark, tmp_path):
    bad = [("x1", "2021-03-01 10:00:00", "12", "C1", "P", "SUCCESS", "T1", "more")]
    for folder in ("a", "b"):
        daygen.write_day(str(tmp_path / folder), 0, extra_rows=bad)
        for i in (1, 2):
            daygen.write_day(str(tmp_path / folder), i)
    fold, whole = Warehouse(spark, str(tmp_path / "fold")), Warehouse(spark, str(tmp_path / "whole"))
    run_days(spark, fold, str(tmp_path / "a"), str(tmp_path / "arc_a"), daygen.sources(spark), semantics=STRICT)
    done = backfill(spark, whole, str(tmp_path / "b"), str(tmp_path / "arc_b"), _by_day(spark))
    assert done["days"] == daygen.DAYS and done["rejects"] == 1
    for name in DIMENSIONS:
        assert _rows(whole.read_history(name)) == _rows(fold.read_history(name)), name
        assert whole.watermark(name) == fold.watermark(name), name
    report = _rows(whole.read_report())
    assert report == _rows(fold.read_report()) and len(report) > 10
    for day in daygen.DAYS:
        assert _rows(whole.read_facts(day)) == _rows(fold.read_facts(day))
    assert _rows(whole.read_days(REJECTS)) == _rows(fold.read_days(REJECTS))
    assert _rows(whole.read_table("blacklist")) == _rows(fold.read_table("blacklist"))
    assert len(done["archived"]) == 9 and whole.state()["day"] == daygen.DAYS[-1]
    # a day in the middle has no state of its own to go back to; a whole reset works
    with pytest.raises(ValueError, match="at once"):
        reset(spark, whole, str(tmp_path / "b"), str(tmp_path / "arc_b"), daygen.DAYS[1])
    with pytest.raises(ValueError, match="empty"):
        daygen.write_day(str(tmp_path / "b"), 2)
        backfill(spark, whole, str(tmp_path / "b"), str(tmp_path / "arc_b"), _by_day(spark))


def test_constant_sources_and_next_day(spark, tmp_path):
    """Sources without a day column are the same every day; days go on from a backfill."""
    of = daygen.sources(spark)
    for folder in ("a", "b"):
        _write(tmp_path / folder, 2)
    fold, whole = Warehouse(spark, str(tmp_path / "fold")), Warehouse(spark, str(tmp_path / "whole"))
    run_days(spark, fold, str(tmp_path / "a"), str(tmp_path / "arc"), of(daygen.DAYS[0]), semantics=STRICT)
    backfill(spark, whole, str(tmp_path / "b"), str(tmp_path / "arc"), of(daygen.DAYS[0]))
    for wh, folder in ((fold, "a"), (whole, "b")):
        daygen.write_day(str(tmp_path / folder), 2)
        run_days(spark, wh, str(tmp_path / folder), str(tmp_path / "arc"), of(daygen.DAYS[2]), semantics=STRICT)
    for name in DIMENSIONS:
        assert _rows(whole.read_history(name)) == _rows(fold.read_history(name)), name
    assert _rows(whole.read_report()) == _rows(fold.read_report())
    assert whole.read_days(FACTS).count() == fold.read_days(FACTS).count() == 27


def test_jobs_do_not_grow_with_days(spark, tmp_path):
    def jobs(days):
        _write(tmp_path / f"in{days}", days)
        tracker = spark.sparkContext.statusTracker()
        before = set(tracker.getJobIdsForGroup(None))
        wh = Warehouse(spark, str(tmp_path / f"wh{days}"))
        backfill(spark, wh, str(tmp_path / f"in{days}"), str(tmp_path / "arc"), _by_day(spark))
        return len(set(tracker.getJobIdsForGroup(None)) - before)
    one, three = jobs(1), jobs(3)
    assert three <= one + 3   # a shuffle of a few rows more may start a stage of its own; a fold would take three times as many


def test_chain_of_a_day_is_the_chain_of_that_days_snapshots(spark):
    snaps = asof_catalog.snapshots(spark, SF_SMALL)
    h = asof_catalog.histories(spark, SF_SMALL)
    chain = asof.temporal_chain(h["cards"], h["accounts"], h["clients"]).cache()
    doubled = chain.alias("a").join(chain.alias("b"), F.expr(
        "a.card_num = b.card_num and a.effective_from < b.effective_from and b.effective_from <= a.effective_to"))
    assert doubled.count() == 0     # versions of a card do not overlap
    current = {n: lambda df: df.withColumn("deleted_flg", F.lit(False)).withColumn("effective_to", F.lit(dt.date(2999, 1, 1)))
               for n in ("cards", "accounts", "clients")}
    for n in (0, 7, 15, 29):
        day = fx.BASE_DAY + dt.timedelta(days=n)
        of = {k: f(snaps[k].filter(F.col("day") == F.lit(day))) for k, f in current.items()}
        want = dim_chain(of["cards"], of["accounts"], of["clients"].withColumn("date_of_birth", F.lit(None)))
        assert _rows(scd2.as_of(chain, day).select(*want.columns)) == _rows(want)
    chain.unpersist()


def test_asof_report_differs_from_current_rows(spark):
    """A passport listed on the operation's day and taken off since is a hit; one listed since is not."""
    open_end, d = dt.date(2999, 1, 1), dt.date
    tx = spark.createDataFrame([(1, dt.datetime(2024, 1, n, 9), d(2024, 1, n), 1.0, "c", "SUCCESS", "t") for n in (1, 5, 9)],
                               "trans_id long, trans_date timestamp_ntz, trans_day date, amt double, card_num string, oper_result string, terminal string")
    hist = lambda rows, cols: spark.createDataFrame(rows, cols + ", effective_from date, effective_to date, deleted_flg boolean")
    start = d(2024, 1, 1)
    cards = hist([("c", "a1", start, d(2024, 1, 4), False), ("c", "a2", d(2024, 1, 5), open_end, False)], "card_num string, account_num string")
    accounts = hist([("a1", d(2030, 1, 1), "k1", start, open_end, False), ("a2", d(2030, 1, 1), "k2", start, d(2024, 1, 8), True),
                     ("a2", d(2024, 1, 3), "k2", d(2024, 1, 9), open_end, False)], "account_num string, valid_to date, client string")
    clients = hist([(f"k{i}", f"f{i}", f"p{i}", d(2030, 1, 1), "+7", start, open_end, False) for i in (1, 2)],
                   "client_id string, fio string, passport_num string, passport_valid_to date, phone string")
    terminals = hist([("t", "x", start, open_end, False)], "terminal_id string, terminal_city string")
    listed = hist([("p1", start, d(2024, 1, 3), True), ("p1", d(2024, 1, 8), open_end, False), ("p2", d(2024, 1, 6), d(2024, 1, 8), True)],
                  "passport_num string")
    got = report_asof.fraud_report_asof(tx, cards, accounts, clients, terminals, listed)
    assert sorted((r.report_dt.day, r.event_type, r.passport) for r in got.collect()) == [(1, 1, "p1"), (9, 2, "p2")]
