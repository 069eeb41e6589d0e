"""Many days loaded at once: the sequential backfill's result from a fixed number of jobs.

``run_days`` folds the days one by one, as each merge needs the state the day before left. In strict semantics the
state of any day follows from the snapshots themselves, so a warehouse can be filled set-wise: each dimension's
history is made from all its snapshots in one job (:func:`tallyhawk.operators.asof.scd2_from_snapshots`), the facts of
all days are parsed and written in one job, and the report judges every operation by the rows valid on its day
(:func:`tallyhawk.operators.report_asof.fraud_report_asof`). The days are published in one commit.

The result is the strict fold's, with two differences where the fold depends on the order of arrival: an operation that
arrives in a later day's file is judged with its own day, and a source row counts as changed by its values, whether or
not its ``update_dt`` says so.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhawk.functions.scalars import day_from_name
from tallyhawk.operators import checks, facts, report_asof, sequence
from tallyhawk.operators.asof import scd2_from_snapshots
from tallyhawk.plans.daily import IncompleteDayError, Sources, _source_frames, _typed
from tallyhawk.plans.state import FACTS, REJECTS, REPORTS, Warehouse
from tallyhawk.schemas import DIMENSIONS, KIND_BLACKLIST, KIND_TERMINALS, KIND_TRANSACTIONS, MAX_LENGTHS, PROBE_SPAN, STRICT
from tallyhawk.sources import files

_KINDS = (KIND_TRANSACTIONS, KIND_TERMINALS, KIND_BLACKLIST)


def _inputs(spark: SparkSession, input_dir: str) -> dict[_dt.date, dict]:
    """Per day the paths of each kind; every day must be complete, with one file of each snapshot."""
    days: dict[_dt.date, dict] = {}
    for r in files.list_inputs(spark, input_dir).filter("kind is not null").orderBy("name").collect():   # file names
        days.setdefault(r["day"], {}).setdefault(r["kind"], []).append(r["path"])
    for day, kinds in days.items():
        if missing := [k for k in _KINDS if k not in kinds]:
            raise IncompleteDayError(f"{day}: no file of {', '.join(missing)}")
        if two := [k for k in _KINDS[1:] if len(kinds[k]) > 1]:
            raise ValueError(f"two {two[0]} files for {day}: {', '.join(kinds[two[0]])}")
    return dict(sorted(days.items()))


def _by_day(spark: SparkSession, days: dict[_dt.date, dict], kind: str, read) -> DataFrame:
    return reduce(DataFrame.unionByName, [read(spark, f[kind][0]).withColumn("day", F.lit(d)) for d, f in days.items()])


def backfill(spark: SparkSession, wh: Warehouse, input_dir: str, archive_dir: str, sources: Sources,
             archive: bool = True, probe_span=PROBE_SPAN) -> dict | None:
    """Load every day found in ``input_dir`` into an empty warehouse; returns a summary, None without input.

    A frame of ``sources`` with a ``day`` column holds one snapshot a day (each day loaded must have one); one
    without is the same on every day.
    """
    days = _inputs(spark, input_dir)
    if not days:
        return None
    if wh.state()["day"] is not None:
        raise ValueError(f"the warehouse holds days up to {wh.state()['day']}; a backfill fills an empty one")
    version, first, last = wh.next_version(), min(days), max(days)
    calendar = spark.createDataFrame([(d,) for d in days], "day date")

    def load_facts():
        paths = [p for f in days.values() for p in f[KIND_TRANSACTIONS]]
        raw = files.read_transactions_raw(spark, paths).withColumn("load_day", day_from_name(F.regexp_extract(
            "_metadata.file_path", rf"({KIND_TRANSACTIONS}[^/]*)", 1)))
        parsed = files.parse_transactions(raw, "load_day")
        obs = Observation("transactions")
        seen = parsed.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(F.col("_reject")).alias("rejects"),
                              sequence.frequent("card_num").alias("cards"))
        good = seen.filter(F.col("_reject").isNull()).drop("_reject", "_amount_text")
        good = checks.enforce_lengths(good, MAX_LENGTHS["fact_transactions"], "transactions")
        wh.write_load_days(FACTS, good, version, "trans_day")
        counts = obs.get
        if counts.get("rejects", 0):
            wh.write_load_days(REJECTS, parsed.filter(F.col("_reject").isNotNull()), version)
        return sequence.hot_values(counts.get("cards"), counts.get("rows", 0)), counts.get("rejects", 0)

    def load_dimension(name, snaps, constant):
        key, attrs, _ = DIMENSIONS[name]
        snaps = _typed(snaps, name)
        known = calendar.filter(F.col("day") == F.lit(first)) if constant else calendar
        hist = scd2_from_snapshots(snaps, key, attrs, days=known)
        rows = wh.write_history(name, version, checks.enforce_lengths(hist, MAX_LENGTHS[name], name))
        changes = snaps if "update_dt" in snaps.columns else wh.read_history(name, version=version, closed=[version]) \
            .withColumnRenamed("effective_from", "update_dt")
        mark = changes.agg(F.max("update_dt")).first()[0]
        return (version, mark if mark is not None else wh.watermark(name), [version], rows)

    def load_blacklist():
        lists = _by_day(spark, days, KIND_BLACKLIST, files.read_blacklist)
        lists = checks.enforce_lengths(lists, MAX_LENGTHS["blacklist"], "blacklist")
        path = f"{wh.epoch_root()}/blacklist_history/v={version}"
        facts.refresh_snapshot(scd2_from_snapshots(lists, "passport_num", ["entry_dt"], days=calendar), path)
        listed = spark.read.parquet(path)
        obs = Observation("blacklist_rows")
        latest = listed.filter(F.lit(last).between(F.col("effective_from"), F.col("effective_to"))).select("passport_num", "entry_dt")
        facts.refresh_snapshot(latest.observe(obs, F.count(F.lit(1)).alias("rows")), wh.table_path("blacklist", version))
        return (version, None, None, int(obs.get.get("rows", 0))), listed

    with ThreadPoolExecutor(max_workers=6, thread_name_prefix="backfill") as pool:   # independent jobs, submitted together
        loads = {"terminals": pool.submit(load_dimension, "terminals", _by_day(spark, days, KIND_TERMINALS, files.read_terminals), False)}
        for name, frame in _source_frames(sources).items():
            constant = "day" not in frame.columns
            snaps = frame.withColumn("day", F.lit(first)) if constant else frame.join(calendar, "day", "left_semi")
            loads[name] = pool.submit(load_dimension, name, snaps, constant)
        loading_facts, loading_list = pool.submit(load_facts), pool.submit(load_blacklist)
        tables = {name: f.result() for name, f in loads.items()}
        (hot_cards, n_rejects), (tables["blacklist"], listed) = loading_facts.result(), loading_list.result()

    live = {t: wh.written_days(t, list(days), version) for t in (FACTS, REJECTS)}
    tx = wh.read_days(FACTS, pending=live[FACTS]).filter(F.col("trans_day").isin(list(days)))
    dims = {name: wh.read_history(name, version=version, closed=[version]) for name in DIMENSIONS}
    report = report_asof.fraud_report_asof(tx, dims["cards"], dims["accounts"], dims["clients"], dims["terminals"], listed,
                                           STRICT, probe_span=probe_span,
                                           hot=sequence.borders(tx, "card_num", "trans_date", hot_cards))
    report = checks.enforce_lengths(report, MAX_LENGTHS["report"], "report").withColumn("load_day", F.col("report_dt"))
    wh.write_load_days(REPORTS, report, version)
    live[REPORTS] = wh.written_days(REPORTS, list(days), version)

    wh.commit(last, tables, kind="backfill", days=live, seq=version)
    moved = files.archive_files(spark, [p for f in days.values() for k in f.values() for p in k], archive_dir) if archive else []
    return {"days": list(days), "version": version, "rejects": n_rejects, "archived": moved}
