"""Streaming rule 4: state carries a sequence across files; equals the batch rule."""

import datetime as dt

from tallyhawk.operators import fraud
from tallyhawk.sources import files
from tallyhawk.streaming.amount_probe import read_hits, run_probe_stream, settle

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def _write(path, rows):
    with open(path, "w") as f:
        f.write(HEADER)
        for r in rows:
            f.write(";".join(r) + "\n")


def test_sequence_across_files(spark, tmp_path):
    inp = tmp_path / "in"
    inp.mkdir()
    a = [("1", "2021-03-01 23:50:00", "900,00", "C", "W", "REJECT", "T"),
         ("2", "2021-03-01 23:55:00", "800,00", "C", "W", "REJECT", "T"),
         ("9", "2021-03-01 10:00:00", "5,00", "D", "W", "SUCCESS", "T")]
    b = [("3", "2021-03-02 00:01:00", "700,00", "C", "W", "REJECT", "T"),
         ("4", "2021-03-02 00:05:00", "600,00", "C", "W", "SUCCESS", "T"),
         ("5", "2021-03-02 12:00:00", "9,00", "D", "W", "REJECT", "T")]
    _write(inp / "transactions_01032021.txt", a)
    q = run_probe_stream(spark, str(inp / "transactions_*.txt"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    _write(inp / "transactions_02032021.txt", b)
    q = run_probe_stream(spark, str(inp / "transactions_*.txt"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    settle(spark, str(tmp_path / "out"), str(tmp_path / "ck"), q.lastProgress["batchId"])
    got = read_hits(spark, str(tmp_path / "out")).collect()
    assert [(r.trans_id, r.card_num, r.trans_date) for r in got] == [("4", "C", dt.datetime(2021, 3, 2, 0, 5))]
    # the batch rule across days agrees; per day (the reference) it cannot see the sequence
    tx, _ = files.scan_transactions(spark, str(inp / "transactions_*.txt"))
    assert [r.trans_id for r in fraud.amount_probes(tx, per_day=False).collect()] == ["4"]
    assert fraud.amount_probes(tx, per_day=True).count() == 0


def test_ingest_on_arrival(spark, tmp_path):
    import daygen
    from tallyhawk.plans.state import Warehouse
    from tallyhawk.streaming.ingest import ingest_on_arrival
    inp, arc, ck = str(tmp_path / "in"), str(tmp_path / "arc"), str(tmp_path / "ck")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    daygen.write_day(inp, 1)          # out of order: day 2 arrives first, then day 1
    daygen.write_day(inp, 0)
    ingest_on_arrival(spark, wh, inp, arc, daygen.sources(spark), ck).awaitTermination()
    assert wh.state()["day"] == daygen.DAYS[1] and wh.state()["seq"] == 2
    daygen.write_day(inp, 2)
    ingest_on_arrival(spark, wh, inp, arc, daygen.sources(spark), ck).awaitTermination()
    assert wh.state()["day"] == daygen.DAYS[2] and wh.state()["seq"] == 3
    assert sorted(r.report_dt for r in wh.read_report().select("report_dt").distinct().collect()) == daygen.DAYS


def test_unsorted_parts_equal_batch(spark, tmp_path):
    """Ten-day files of four unsorted parts, a part a batch: the stream equals the batch rule."""
    from pyspark.sql import functions as F
    from conftest import SF_SMALL
    from tallyhawk.plans import catalog
    from tallyhawk.plans import fixtures as fx
    tx = fx.tx(spark, SF_SMALL)
    for lo, hi in ((1, 10), (11, 20), (21, 31)):
        catalog.write_transactions_file(tx.filter(F.dayofmonth("trans_day").between(lo, hi)).repartition(4, "trans_id"),
                                        str(tmp_path / f"in/transactions_{lo:02d}012024.txt"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q = run_probe_stream(spark, str(tmp_path / "in/transactions_*/part-*.csv"), out, ck, max_span="1 day", delay="31 days",
                         max_files_per_trigger=1)
    q.awaitTermination()
    settle(spark, out, ck, q.lastProgress["batchId"], max_span="1 day")
    got = sorted(r.trans_id for r in read_hits(spark, out).collect())
    scanned, _ = files.scan_transactions(spark, str(tmp_path / "in/transactions_*"))
    want = sorted(r.trans_id for r in fraud.amount_probes(scanned, max_span="1 day", per_day=False, hot=None).collect())
    assert got == want and len(want) > 0


def test_hits_come_out_as_the_watermark_passes_and_late_rows_apart(spark, tmp_path):
    inp, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    inp.mkdir()
    op = lambda i, t, a, r: (str(i), f"2021-03-01 {t}:00", f"{a},00", "C", "W", r, "T")
    batches = [[op(3, "10:04", 700, "REJECT"), op(1, "10:00", 900, "REJECT")],
               [op(4, "10:06", 600, "SUCCESS"), op(2, "10:02", 800, "REJECT")],     # before the watermark: in order
               [op(5, "12:00", 5, "SUCCESS")],                                      # the watermark passes 10:06
               [op(6, "10:05", 1, "SUCCESS")]]                                      # too late
    for n, rows in enumerate(batches):
        _write(inp / f"transactions_0{n}032021.txt", rows)
        q = run_probe_stream(spark, str(inp / "transactions_*.txt"), out, ck, delay="1 hour")
        q.awaitTermination()
        found = [r.trans_id for r in read_hits(spark, out).collect()] if (tmp_path / "out").exists() else []
        assert found == ([] if n < 2 else ["4"])
    assert [r.trans_id for r in spark.read.parquet(out + "_late").select("trans_id").collect()] == ["6"]
