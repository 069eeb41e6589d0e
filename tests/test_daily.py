"""Daily runs over generated files: report, history, archive, reruns, replay, file order."""

import datetime as dt
import os

import pytest

import daygen
from tallyhawk.plans.daily import IncompleteDayError, compact, reset, run_day, run_days
from tallyhawk.plans.state import Warehouse
from tallyhawk.schemas import REFERENCE, STRICT
from tallyhawk.sources import files


@pytest.fixture
def dirs(tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    for i in range(3):
        daygen.write_day(d["input"], i)
    return d


def _report(wh):
    return sorted((r.report_dt.day, r.event_type, r.passport, r.event_dt) for r in wh.read_report().collect())


def test_three_days(spark, dirs):
    wh = Warehouse(spark, dirs["wh"])
    done = run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark))
    assert [r["day"] for r in done] == daygen.DAYS
    assert os.listdir(dirs["input"]) == []
    assert len(os.listdir(dirs["archive"])) == 9
    assert all(n.endswith(".backup") for n in os.listdir(dirs["archive"]))
    rep = _report(wh)
    # rule 1: K1's passport expires on day 2 (inclusive); K2 is blacklisted every day;
    # K3 (NULL patronymic -> NULL fio) becomes blacklisted on day 3
    r1 = [r for r in rep if r[1] == 1]
    assert (2, 1, "1111 000001", "09:00:00") in r1 and (3, 1, "1111 000001", "09:00:00") in r1
    assert (1, 1, "1111 000001", "09:00:00") not in r1
    # C2 daily, plus C4's three operations once C4 moves to K2's account on day 2
    assert sum(1 for r in r1 if r[2] == "1111 000002") == 1 + 4 + 4
    assert sum(1 for r in r1 if r[2] == "1111 000003") == 4   # day 3: four C3 operations
    # rule 2: account A3 valid_to day 2 -> expired from day 2 00:00:01 (reference promotion)
    r2 = [r for r in rep if r[1] == 2]
    assert {r[0] for r in r2} == {2, 3} and all(r[2] == "1111 000003" for r in r2)
    # rule 4: one probe per day for card C3
    assert [r for r in rep if r[1] == 4] == [(d, 4, "1111 000003", "12:06:00") for d in (1, 2, 3)]
    # rule 3 (reference: first leg of the last compared hop; the last pair is never compared):
    # day 1 Kazan->SPB->Kazan, day 2 Kazan->Omsk->Kazan (T4 new), day 3 again SPB;
    # C4 belongs to K4 on day 1, to K2 from day 2 (card moved to account A2)
    r3 = [r for r in rep if r[1] == 3]
    # day 3: T2 came back unchanged and stays closed in reference mode (Q5), so the
    # operation there is dropped before the window (Q11) and no hop is left
    assert r3 == [(1, 3, "1111 000004", "15:00:00"), (2, 3, "1111 000002", "15:00:00")]
    # terminals history: T2 deleted on day 2, lost for good on return (reference Q5)
    term = {(r.terminal_id, r.terminal_city, r.effective_from.day, r.deleted_flg)
            for r in wh.read_history("terminals").collect()}
    assert ("T2", "SPB", 1, True) in term and ("T1", "Tver", 2, False) in term
    assert wh.watermark("terminals") == daygen.DAYS[2] or wh.watermark("terminals") == daygen.DAYS[1]
    assert wh.watermark("cards") == daygen.DAYS[2]   # NULL update_dt: staged every day
    # fio is NULL when a name part is NULL
    k3 = wh.read_history("clients").filter("client_id = 'K3'")
    assert k3.select("fio").first()[0] is None


@pytest.mark.parametrize("operations,factor", [(STRICT, 1), (REFERENCE, 2)])
def test_rerun_day(spark, dirs, operations, factor):
    wh = Warehouse(spark, dirs["wh"])
    run_day(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), operations=operations)
    n1 = wh.read_facts(daygen.DAYS[0]).count()
    files.restore_files(spark, dirs["archive"], dirs["input"])
    run_day(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), operations=operations)
    assert wh.read_facts(daygen.DAYS[0]).count() == factor * n1


def test_replay_equals_first_run(spark, dirs):
    wh = Warehouse(spark, dirs["wh"])
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), operations=STRICT)
    def tables():
        out = {t: sorted(map(tuple, wh.read_history(t).collect()), key=repr)
               for t in ("terminals", "cards", "accounts", "clients")}
        out["blacklist"] = sorted(map(tuple, wh.read_table("blacklist").collect()), key=repr)
        return out
    first = tables()
    rep1 = _report(wh)
    reset(spark, wh, dirs["input"], dirs["archive"])
    assert wh.state()["tables"] == {}
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), operations=STRICT)
    again = tables()
    assert again == first
    assert _report(wh) == rep1


def test_pick_files_month_boundary(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    for day in ("01042021", "02032021"):
        for kind, ext in (("transactions", "txt"), ("terminals", "xlsx"), ("passport_blacklist", "xlsx")):
            (d / f"{kind}_{day}.{ext}").write_text("x")
    ref = files.pick_files(spark, str(d), REFERENCE)
    strict = files.pick_files(spark, str(d), STRICT)
    assert ref["day"] == dt.date(2021, 4, 1) and ref["transactions"][0].endswith("transactions_01042021.txt")
    assert strict["day"] == dt.date(2021, 3, 2) and strict["transactions"][0].endswith("transactions_02032021.txt")


def test_pick_files_requires_all_kinds(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "transactions_01032021.txt").write_text("x")
    (d / "terminals_01032021.xlsx").write_text("x")
    picked = files.pick_files(spark, str(d), STRICT)
    assert "passport_blacklist" not in picked and picked["day"] == dt.date(2021, 3, 1)
    with pytest.raises(IncompleteDayError, match="passport_blacklist"):
        run_day(spark, Warehouse(spark, str(tmp_path / "wh")), str(d), str(tmp_path / "arc"), None)


def test_decimal_comma_and_rejects(spark, tmp_path):
    p = tmp_path / "transactions_01032021.txt"
    p.write_text("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
                 "1;2021-03-01 10:00:00;1234,56;C;P;SUCCESS;T\n"
                 "2;2021-03-01 10:00:01;7;C;P;SUCCESS;T\n"
                 "3;2021-03-01 10:00:02;;C;P;SUCCESS;T\n"
                 "4;2021-03-01 10:00:03;abc;C;P;SUCCESS;T\n")
    good, bad = files.scan_transactions(spark, str(p))
    assert sorted((r.trans_id, float(r.amt)) for r in good.collect()) == [("1", 1234.56), ("2", 7.0)]
    assert sorted(r.trans_id for r in bad.collect()) == ["3", "4"]
    with pytest.raises(files.BadRowsError):
        files.scan_transactions(spark, str(p), on_bad="fail")


def test_day_from_name(spark):
    df = spark.createDataFrame([("in/terminals_01032021.xlsx",), ("transactions_15122021.txt",), ("junk.txt",)],
                               "name string")
    got = [r[0] for r in df.select(files.day_from_name("name")).collect()]
    assert got == [dt.date(2021, 3, 1), dt.date(2021, 12, 15), None]


def test_xlsx_reader_dates_and_numbers(spark, tmp_path):
    from tallyhawk.sources.excel import read_xlsx, write_xlsx
    from tallyhawk.schemas import BLACKLIST_FILE
    p = tmp_path / "passport_blacklist_01032021.xlsx"
    write_xlsx(str(p), ["date", "passport"], [[dt.date(2021, 2, 1), "4000 123456"], [dt.date(2021, 2, 3), 123]])
    rows = sorted(tuple(r) for r in read_xlsx(spark, str(p), BLACKLIST_FILE).collect())
    assert rows == [("2021-02-01", "4000 123456"), ("2021-02-03", "123")]
    bl = files.read_blacklist(spark, str(p)).collect()
    assert sorted((r.passport_num, r.entry_dt) for r in bl) == [("123", dt.date(2021, 2, 3)),
                                                               ("4000 123456", dt.date(2021, 2, 1))]


def test_duplicate_key_fails_day_unpublished(spark, tmp_path):
    from tallyhawk.sources.excel import write_xlsx
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    daygen.write_day(d["input"], 0)
    write_xlsx(os.path.join(d["input"], "terminals_01032021.xlsx"),
               ["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
               [["T1", "POS", "Moscow", "a"], ["T1", "POS", "Tver", "b"]])
    wh = Warehouse(spark, d["wh"])
    with pytest.raises(Exception, match="duplicate key terminal_id=T1"):
        run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert wh.state()["seq"] == 0                      # nothing published
    assert len(os.listdir(d["input"])) == 3            # nothing archived


def test_overlong_value_fails_day(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    daygen.write_day(d["input"], 0, extra_rows=[("x" * 25, "2021-03-01 10:00:00", "1,00", "C9", "P", "SUCCESS",
                                                   "T1")])
    wh = Warehouse(spark, d["wh"])
    with pytest.raises(Exception, match="value too long in transactions.trans_id"):
        run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert wh.state()["seq"] == 0


def test_rejects_are_counted_and_kept(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    daygen.write_day(d["input"], 0, extra_rows=[("777", "2021-03-01 10:00:00", "abc", "C9", "P", "SUCCESS", "T1")])
    wh = Warehouse(spark, d["wh"])
    r = run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert r["rejects"] == 1
    assert [x.trans_id for x in wh.read_days("rejects").collect()] == ["777"]
    with pytest.raises(Exception, match="bad transaction row"):
        files.restore_files(spark, d["archive"], d["input"])
        run_day(spark, Warehouse(spark, str(tmp_path / "wh2")), d["input"], d["archive"],
                daygen.sources(spark), operations=REFERENCE)


def test_strict_days_merge_only_open_rows(spark, dirs):
    """Strict: each day adds one closed partition; compaction gathers them without changing a row."""
    wh = Warehouse(spark, dirs["wh"])
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), semantics=STRICT)
    assert wh.closed_versions("terminals") == [1, 2, 3]
    before = sorted(map(tuple, wh.read_history("terminals").collect()), key=repr)
    compact(wh)
    assert wh.closed_versions("terminals") == [4] and wh.state()["day"] == daygen.DAYS[2]
    assert sorted(map(tuple, wh.read_history("terminals").collect()), key=repr) == before


@pytest.mark.parametrize("semantics,kept_terminal_versions", [(REFERENCE, ["v=3"]), (STRICT, ["v=1", "v=2", "v=3"])])
def test_vacuum_keeps_what_recent_commits_read(spark, dirs, semantics, kept_terminal_versions):
    wh = Warehouse(spark, dirs["wh"])
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), semantics=semantics)
    before = sorted(map(tuple, wh.read_history("terminals").collect()), key=repr)
    report = _report(wh)
    deleted = wh.vacuum(keep_commits=1)
    assert deleted
    left = sorted(os.listdir(os.path.join(dirs["wh"], "epoch=0", "dims", "terminals")))
    assert left == kept_terminal_versions
    assert sorted(os.listdir(os.path.join(dirs["wh"], "epoch=0", "chain"))) == ["v=3"]
    assert sorted(map(tuple, wh.read_history("terminals").collect()), key=repr) == before
    assert _report(wh) == report


def test_vacuum_drops_epochs_before_a_reset(spark, dirs):
    wh = Warehouse(spark, dirs["wh"])
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), max_days=1)
    reset(spark, wh, dirs["input"], dirs["archive"])
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark), max_days=1)
    assert sorted(n for n in os.listdir(dirs["wh"]) if n.startswith("epoch=")) == ["epoch=0", "epoch=1"]
    wh.vacuum(keep_commits=1)
    assert sorted(n for n in os.listdir(dirs["wh"]) if n.startswith("epoch=")) == ["epoch=1"]
    assert wh.read_report().count() > 0


def test_reference_picking_pairs_days_like_the_reference(spark, tmp_path):
    """Q8/Q18: lexical picking may pair files of different days; dimensions take the terminals day,
    the report takes the transactions day. Strict picking refuses the incomplete day."""
    from tallyhawk.sources.excel import write_xlsx
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    daygen.write_day(d["input"], 0)
    os.remove(os.path.join(d["input"], "terminals_01032021.xlsx"))
    os.remove(os.path.join(d["input"], "passport_blacklist_01032021.xlsx"))
    write_xlsx(os.path.join(d["input"], "terminals_02032021.xlsx"),
               ["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
               [list(r) for r in daygen.TERMINALS[0]])
    write_xlsx(os.path.join(d["input"], "passport_blacklist_02032021.xlsx"), ["date", "passport"],
               [list(r) for r in daygen.BLACKLIST[0]])
    with pytest.raises(IncompleteDayError):
        run_day(spark, Warehouse(spark, d["wh"]), d["input"], d["archive"], daygen.sources(spark))
    wh = Warehouse(spark, d["wh"])
    r = run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark), operations=REFERENCE)
    assert r["day"] == dt.date(2021, 3, 2)
    assert {x.effective_from for x in wh.read_history("terminals").collect()} == {dt.date(2021, 3, 2)}
    days = {(x.event_type, x.report_dt) for x in wh.read_report().collect()}
    assert {rd for _, rd in days} == {dt.date(2021, 3, 1)}


def test_rerun_after_failed_day_publishes_cleanly(spark, tmp_path):
    from tallyhawk.sources.excel import write_xlsx
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    daygen.write_day(d["input"], 0)
    terminals = os.path.join(d["input"], "terminals_01032021.xlsx")
    header = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]
    write_xlsx(terminals, header, [["T1", "POS", "Moscow", "a"], ["T1", "POS", "Tver", "b"]])
    wh = Warehouse(spark, d["wh"])
    with pytest.raises(Exception):
        run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    write_xlsx(terminals, header, [list(r) for r in daygen.TERMINALS[0]])      # the fixed file
    r = run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert r["version"] == 1 and wh.state()["seq"] == 1
    assert sorted(x.terminal_id for x in wh.read_history("terminals").collect()) == ["T1", "T2", "T3"]
    assert wh.read_report().count() > 0


def _history(wh):
    return {t: sorted(map(tuple, wh.read_history(t).collect()), key=repr) for t in ("terminals", "cards", "accounts", "clients")}


def test_straggler_keeps_the_facts_of_its_day(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    daygen.write_day(d["input"], 0)
    daygen.write_day(d["input"], 1, extra_rows=[("late", "2021-03-01 23:59:59", "1,00", "C1", "P", "SUCCESS", "T3")])
    wh = Warehouse(spark, d["wh"])
    run_days(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert wh.read_facts(daygen.DAYS[0]).count() == 10 and wh.read_facts(daygen.DAYS[1]).count() == 9


@pytest.mark.parametrize("semantics", [REFERENCE, STRICT])
def test_repeated_day_equals_one_load(spark, dirs, semantics):
    """The last day comes again, corrected: histories, facts and report are those of the corrected day alone."""
    import shutil
    once, twice = Warehouse(spark, dirs["wh"] + "_once"), Warehouse(spark, dirs["wh"])
    shutil.copytree(dirs["input"], dirs["input"] + "_once")
    run_days(spark, once, dirs["input"] + "_once", dirs["archive"] + "_once", daygen.sources(spark), semantics, max_days=2)
    run_days(spark, twice, dirs["input"], dirs["archive"], daygen.sources(spark), semantics, max_days=1)
    # day 2 first without its fraud and with another terminal list
    daygen.write_day(dirs["input"], 1, rows=daygen.transactions(1)[:2], terminals=daygen.TERMINALS[0])
    run_day(spark, twice, dirs["input"], dirs["archive"], daygen.sources(spark), semantics)
    daygen.write_day(dirs["input"], 1)
    run_day(spark, twice, dirs["input"], dirs["archive"], daygen.sources(spark), semantics)
    assert _history(twice) == _history(once)
    assert _report(twice) == _report(once)
    assert twice.read_facts().count() == once.read_facts().count() == 18
    daygen.write_day(dirs["input"], 0)
    with pytest.raises(ValueError, match="earlier"):
        run_day(spark, twice, dirs["input"], dirs["archive"], daygen.sources(spark), semantics)


def test_corrected_day_without_hits_clears_its_report(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    wh = Warehouse(spark, d["wh"])
    daygen.write_day(d["input"], 0)
    run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert wh.read_report().count() > 0
    daygen.write_day(d["input"], 0, rows=[("1", "2021-03-01 10:00:00", "1,00", "C1", "P", "SUCCESS", "T3")])
    run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert wh.read_report().count() == 0 and wh.read_facts().count() == 1


def test_a_stop_before_or_while_publishing_leaves_the_state(spark, dirs):
    wh = Warehouse(spark, dirs["wh"])
    run_day(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark))
    before = (wh.read_facts().count(), _report(wh), _history(wh))
    stopped = Warehouse(spark, dirs["wh"])
    stopped.commit = lambda *a, **k: (_ for _ in ()).throw(InterruptedError)
    with pytest.raises(InterruptedError):
        run_day(spark, stopped, dirs["input"], dirs["archive"], daygen.sources(spark))
    with open(os.path.join(dirs["wh"], "log", "c000000002.json"), "w") as f:
        f.write('{"seq": 2, "epoch": 0, "kind": "run", "day": "2021-03-02", "table_name": "cards", "version": 2, "rows": 7}\n{"se')
    fresh = Warehouse(spark, dirs["wh"])
    assert (fresh.read_facts().count(), _report(fresh), _history(fresh)) == before
    assert fresh.next_version() == 3
    assert run_day(spark, fresh, dirs["input"], dirs["archive"], daygen.sources(spark))["version"] == 3
    assert fresh.state()["day"] == daygen.DAYS[1]


def test_second_writer_of_a_number_fails(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.commit(daygen.DAYS[0], {}, seq=1)
    with pytest.raises(FileExistsError):
        Warehouse(spark, str(tmp_path / "wh")).commit(daygen.DAYS[0], {}, seq=1)


def test_reset_to_a_day(spark, dirs):
    wh = Warehouse(spark, dirs["wh"])
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark))
    whole = (_history(wh), _report(wh), wh.read_facts().count())
    reset(spark, wh, dirs["input"], dirs["archive"], daygen.DAYS[1])
    assert wh.state()["day"] == daygen.DAYS[0] and wh.read_facts().count() == 9 and len(os.listdir(dirs["input"])) == 6
    run_days(spark, wh, dirs["input"], dirs["archive"], daygen.sources(spark))
    assert (_history(wh), _report(wh), wh.read_facts().count()) == whole


def test_all_transactions_files_of_a_day_are_loaded(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    daygen.write_day(d["input"], 0)
    daygen.write_day(d["input"], 0, ext="csv", rows=[("x", "2021-03-01 20:00:00", "1,00", "C1", "P", "SUCCESS", "T3")])
    wh = Warehouse(spark, d["wh"])
    run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))
    assert wh.read_facts().count() == 10 and os.listdir(d["input"]) == []


def test_strict_rule_4_crosses_midnight(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    early = [(f"a{m}", f"2021-03-01 23:{m}:00", "900,00", "C3", "W", "REJECT", "T3") for m in (50, 55)]
    late = [("b1", "2021-03-02 00:01:00", "700,00", "C3", "W", "REJECT", "T3"),
            ("b2", "2021-03-02 00:05:00", "600,00", "C3", "W", "SUCCESS", "T3")]
    daygen.write_day(d["input"], 0, rows=early)
    daygen.write_day(d["input"], 1, rows=late)
    wh = Warehouse(spark, d["wh"])
    run_days(spark, wh, d["input"], d["archive"], daygen.sources(spark), semantics=STRICT)
    assert [r for r in _report(wh) if r[1] == 4] == [(2, 4, "1111 000003", "00:05:00")]


def test_rows_of_another_field_count_are_rejected(spark, tmp_path):
    d = {k: str(tmp_path / k) for k in ("input", "archive", "wh")}
    row = ("7", "2021-03-01 10:00:00", "1,00", "C9", "P", "SUCCESS", "T1")
    daygen.write_day(d["input"], 0, extra_rows=[(*row, "more"), row[:5]])
    wh = Warehouse(spark, d["wh"])
    assert run_day(spark, wh, d["input"], d["archive"], daygen.sources(spark))["rejects"] == 2
    assert {r["_reject"] for r in wh.read_days("rejects").collect()} == {"wrong number of fields"}
    assert wh.read_facts().count() == 9


def test_undeclared_columns_and_long_report_values_fail(spark):
    from tallyhawk.operators import checks
    df = spark.createDataFrame([("1" * 17,)], "phone string")
    with pytest.raises(checks.ConstraintError, match="missing"):
        checks.enforce_lengths(df, {"phone": 16, "fio": 100})
    with pytest.raises(Exception, match="value too long in report.phone"):
        checks.enforce_lengths(df, {"phone": 16}, "report").collect()
    two = spark.createDataFrame([("P", 1), ("P", 2)], "passport_num string, x int")
    with pytest.raises(Exception, match="duplicate key in blacklist"):
        checks.enforce_unique_key(two, "passport_num", "blacklist").collect()
