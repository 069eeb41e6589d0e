"""The daily run and the sequential backfill.

``run_day`` loads one business day: facts, the terminals snapshot, the
passport blacklist, cards / accounts / clients from relational sources, the
four-rule report, then commits the day and archives its files. Every step
is a Spark job over DataFrames; the driver holds only file names, the day,
version numbers and four watermarks.

Two switches:

* ``semantics`` (``reference`` | ``strict``) decides results: SCD2 quirks,
  rule variants (SURVEY §2.11, Q1-Q16).
* ``operations`` (``strict`` | ``reference``) decides operational behaviour:
  file picking (Q18), fact/report rerun (Q17, Q23), bad amounts (Q21).
"""

from __future__ import annotations

import datetime as _dt
import logging
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhawk.functions.intervals import to_micros
from tallyhawk.functions.scalars import full_name
from tallyhawk.operators import checks, facts, fraud, scd2, sequence
from tallyhawk.operators.chain import dim_chain
from tallyhawk.plans.state import FACTS, REJECTS, REPORTS, Warehouse
from tallyhawk.schemas import (
    BLACKLIST,
    DIMENSIONS,
    KIND_BLACKLIST,
    KIND_TERMINALS,
    KIND_TRANSACTIONS,
    MAX_LENGTHS,
    PROBE_SPAN,
    REFERENCE,
    STRICT,
)
from tallyhawk.sources import files


@dataclass
class Sources:
    """The relational sources of one day.

    cards: card_num, account, update_dt
    accounts: account, valid_to, client, update_dt
    clients: client_id, last_name, first_name, patronymic, date_of_birth,
             passport_num, passport_valid_to, phone, update_dt
    """
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame


def _source_frames(src: Sources) -> dict[str, DataFrame]:
    return {
        "cards": src.cards.withColumnRenamed("account", "account_num"),
        "accounts": src.accounts.withColumnRenamed("account", "account_num"),
        "clients": src.clients.withColumn("fio", full_name("last_name", "first_name", "patronymic")),
    }


def _empty_hist(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], DIMENSIONS[name][2])


def _typed(df: DataFrame, name: str) -> DataFrame:
    """Bind a staged/source frame to the dimension's declared column types."""
    schema = DIMENSIONS[name][2]
    key, attrs, _ = DIMENSIONS[name]
    return df.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in [key, *attrs]],
                     *[c for c in df.columns if c not in (key, *attrs)])


log = logging.getLogger("tallyhawk")


class IncompleteDayError(ValueError):
    """The earliest day in the input folder lacks a file of some kind."""


def merge_dimension(spark: SparkSession, wh: Warehouse, base: Warehouse, name: str, day: _dt.date, staged: DataFrame,
                    source_keys: DataFrame | None, version: int, semantics: str) -> tuple:
    """Merge one dimension of ``base`` into a new version in one job; returns (version, watermark, closed versions, open rows).

    Without ``source_keys`` the rows are a whole snapshot, staged within the merge.

    strict: closed versions never change, so only the open rows take part in
    the merge; the day's newly closed rows become one more closed partition.
    reference: changes compare with every version and deletions re-stamp
    closed rows (Q1, Q4), so the whole history is merged and rewritten.
    Duplicate keys and over-long values fail the job (nothing is published);
    the watermark is observed while the version is written.
    """
    key, attrs, _ = DIMENSIONS[name]
    incremental = semantics == STRICT
    hist = base.read_history(name, open_only=incremental)
    if hist is None:
        hist = _empty_hist(spark, name)
    obs = Observation(f"{name}_watermark")
    merged = scd2.scd2_merge(hist, staged, source_keys, day, key, attrs, semantics, observation=obs,
                             since=base.watermark(name))
    merged = checks.enforce_lengths(merged, MAX_LENGTHS[name], name)
    open_rows = wh.write_history(name, version, merged)
    latest = obs.get.get("max_update_dt")
    return (version, latest if latest is not None else base.watermark(name),
            [*base.closed_versions(name), version] if incremental else [version], open_rows)


def compact(wh: Warehouse) -> int:
    """Rewrite every dimension's history into one version; the rows stay the same.

    Strict days add one closed partition each; run this now and then, between
    days, so that reading a whole history lists few folders.
    """
    version, state = wh.next_version(), wh.state()
    tables = dict(state["tables"])
    for name in DIMENSIONS:
        if name in tables:
            open_rows = wh.write_history(name, version, wh.read_history(name))
            tables[name] = (version, wh.watermark(name), [version], open_rows)
    return wh.commit(state["day"], tables, kind="compact", seq=version)


def _next_inputs(spark: SparkSession, wh: Warehouse, input_dir: str, operations: str) -> dict | None:
    """The files of the next day to load, or None when none are left; refuses what would corrupt the history."""
    picked = files.pick_files(spark, input_dir, operations)
    kinds = (KIND_TRANSACTIONS, KIND_TERMINALS, KIND_BLACKLIST)
    missing = [k for k in kinds if k not in picked]
    if len(missing) == len(kinds) or (missing and operations == REFERENCE):
        return None
    if missing:
        raise IncompleteDayError(f"{picked['day']}: no file of {', '.join(missing)}; later days wait for it")
    if picked["day"] is None:
        raise ValueError(f"no day in file name {picked[KIND_TERMINALS]}")
    last = wh.state()["day"]
    if operations == STRICT and last is not None and picked["day"] < last:
        raise ValueError(f"{picked['day']} is earlier than {last}, the last day loaded; reset to load it")
    return picked


def run_day(spark: SparkSession, wh: Warehouse, input_dir: str, archive_dir: str,
            sources: Sources | Callable[[_dt.date], Sources], semantics: str = REFERENCE,
            operations: str = STRICT, archive: bool = True, check_entry_date: bool = False) -> dict | None:
    """Load the next day found in ``input_dir``; returns a summary or None when no input is left.

    Under strict operations days are loaded in order, the earliest must be
    complete, and the last day loaded may come again (corrected, or after a
    crash between commit and archive): it is merged from the state before it
    and replaces what it wrote.
    """
    picked = _next_inputs(spark, wh, input_dir, operations)
    if picked is None:
        return None
    day = picked["day"]
    src = sources(day) if callable(sources) else sources
    version = wh.next_version()
    strict = operations == STRICT
    base = wh.before(day) if strict and wh.state()["day"] == day else wh
    mode = facts.OVERWRITE_DAY if strict else facts.APPEND
    report_day = picked["days"].get(KIND_TRANSACTIONS) or day
    live = {t: facts.live_versions(wh.state()["days"][t].get(day, []), version, mode) for t in (FACTS, REPORTS, REJECTS)}

    log.info("run_day %s on Spark %s", day, spark.version)

    def load_facts():
        # one pass parses, checks lengths, counts rejects and writes the day
        parsed = files.parse_transactions(files.read_transactions_raw(spark, picked[KIND_TRANSACTIONS]))
        obs = Observation("transactions")
        parsed = parsed.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(F.col("_reject")).alias("rejects"),
                                sequence.frequent("card_num").alias("cards"))
        keep = F.col("_reject").isNull()
        if not strict:   # a bad row fails the load, as in the reference
            keep = F.when(~keep, F.raise_error(F.concat(F.lit("bad transaction row: "), F.col("_reject")))) \
                .otherwise(F.lit(True))
        tx_file = parsed.filter(keep).drop("_reject", "_amount_text")
        tx_file = checks.enforce_lengths(tx_file, MAX_LENGTHS["fact_transactions"], "transactions")
        facts.write_day(tx_file, wh.day_path(FACTS, day, version), "trans_day")
        seen = obs.get
        n_rejects = seen.get("rejects", 0)
        if n_rejects:   # a second pass only when something was rejected
            _, rejects = files.scan_transactions(spark, picked[KIND_TRANSACTIONS])
            facts.write_day(rejects, wh.day_path(REJECTS, day, version))
        return n_rejects, sequence.hot_values(seen.get("cards"), seen.get("rows", 0))

    def load_terminals():
        snap = files.read_terminals(spark, picked[KIND_TERMINALS])   # duplicate ids fail the merge job
        return merge_dimension(spark, wh, base, "terminals", day, snap, None, version, semantics)

    def load_blacklist():   # full refresh; a second row of a passport fails the job that writes it
        bl = files.read_blacklist(spark, picked[KIND_BLACKLIST])
        bl = checks.enforce_lengths(checks.enforce_unique_key(bl, "passport_num", "blacklist file"),
                                    MAX_LENGTHS["blacklist"], "blacklist")
        obs = Observation("blacklist_rows")
        facts.refresh_snapshot(bl.observe(obs, F.count(F.lit(1)).alias("rows")),
                               wh.table_path("blacklist", version))
        return (version, None, None, int(obs.get.get("rows", 0)))

    def load_source(name, frame):   # cards, accounts, clients from the relational sources
        key, attrs, _ = DIMENSIONS[name]
        frame = _typed(frame, name)
        staged = scd2.stage_incremental(frame, key, attrs, base.watermark(name), day, semantics=semantics)
        return merge_dimension(spark, wh, base, name, day, staged, frame.select(key), version, semantics)

    # The six loads are independent: their jobs are submitted together from
    # driver threads and share the cluster. Nothing is published unless all
    # of them succeed (the report and the commit come after).
    with ThreadPoolExecutor(max_workers=6, thread_name_prefix="load") as pool:
        futures = {"facts": pool.submit(load_facts), "terminals": pool.submit(load_terminals),
                   "blacklist": pool.submit(load_blacklist)}
        for name, frame in _source_frames(src).items():
            futures[name] = pool.submit(load_source, name, frame)
        done = {k: f.result() for k, f in futures.items()}
    n_rejects, hot_cards = done.pop("facts")
    if not n_rejects:
        live[REJECTS] = live[REJECTS][:-1]
    tables: dict[str, tuple] = done

    # 5. report over the versions just written (read back: the lineage stops here);
    # rules use current rows only, so only the open partitions are read
    def read(name):
        return wh.read_history(name, open_only=True, version=version)

    blacklist = spark.read.schema(BLACKLIST).parquet(wh.table_path("blacklist", version))
    # the chain is built and flagged once (blacklist per card; cards that can hit
    # rules 1-2 by the report day) and written with its row counts, so the report
    # reads it back and every broadcast decision has a measured bound
    chain = dim_chain(*(read(name) for name in ("cards", "accounts", "clients")),
                      known_rows=tuple(tables[name][3] for name in ("cards", "accounts", "clients")))
    flags = fraud.chain_with_flags(chain, blacklist, blacklist_rows=tables["blacklist"][3], check_entry_date=check_entry_date)
    flags = flags.withColumn("may_hit", fraud.may_hit_rules_1_2(F.lit(report_day).cast("date")))
    chain_path = f"{wh.epoch_root()}/chain/v={version}"
    obs = Observation("chain_rows")
    (flags.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("may_hit"), 1)).alias("may_hit"))
          .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("may_hit").parquet(chain_path))
    counts = obs.get
    chain_flags = spark.read.schema(flags.schema).parquet(chain_path)
    flagged = chain_flags.filter(F.col("may_hit"))
    tx_day = wh.read_facts(report_day, pending=(day, live[FACTS]))
    if semantics == STRICT:
        # sequences may begin before midnight: the operations of the span before the day are read as context
        before = report_day - _dt.timedelta(days=-(-to_micros(PROBE_SPAN) // to_micros("1 day")))
        probe = wh.read_facts(pending=(day, live[FACTS])).filter(
            F.col("trans_day").between(F.lit(before), F.lit(report_day)))
    else:   # the reference reads the day's file
        probe = wh.read_days(FACTS, [day], pending=(day, [version]))
    # the load named the hot cards while it wrote the facts: looking for them reads nothing again
    hot = sequence.borders(tx_day, "card_num", "trans_date", hot_cards)
    report = fraud.fraud_report(tx_day, chain_flags, blacklist, read("terminals"), semantics,
                                report_day=report_day, probe_tx=probe, hot=hot,
                                terminal_rows=tables["terminals"][3], blacklist_rows=tables["blacklist"][3],
                                flagged=flagged, flagged_rows=int(counts.get("may_hit", 0)),
                                chain_flags=chain_flags, chain_rows=int(counts.get("rows", 0)))
    report = checks.enforce_lengths(report, MAX_LENGTHS["report"], "report")
    facts.write_day(report, wh.day_path(REPORTS, day, version))

    # 6. publish, then archive
    wh.commit(day, tables, days=live, seq=version)
    moved = []
    if archive:
        moved = files.archive_files(spark, [picked[KIND_BLACKLIST], picked[KIND_TERMINALS], *picked[KIND_TRANSACTIONS]],
                                    archive_dir)
    return {"day": day, "version": version, "rejects": n_rejects, "archived": moved}


def run_days(spark: SparkSession, wh: Warehouse, input_dir: str, archive_dir: str,
             sources: Sources | Callable[[_dt.date], Sources], semantics: str = REFERENCE,
             operations: str = STRICT, max_days: int | None = None) -> list[dict]:
    """Sequential backfill: one ``run_day`` per available day, in order."""
    done = []
    while max_days is None or len(done) < max_days:
        r = run_day(spark, wh, input_dir, archive_dir, sources, semantics, operations)
        if r is None:
            break
        done.append(r)
    return done


def reset(spark: SparkSession, wh: Warehouse, input_dir: str, archive_dir: str, day: _dt.date | None = None) -> list[str]:
    """Restore archived files to the input folder; without ``day`` start an empty warehouse epoch.

    The equivalent of dropping every table: nothing is deleted; the next runs
    write under a new epoch and the old one stays readable. With ``day`` the
    warehouse goes back to its state before that day and only the files of that
    day and later ones come back, to be loaded again from there.
    """
    if day is None:
        restored = files.restore_files(spark, archive_dir, input_dir)
        wh.commit(None, {}, kind="reset", epoch=wh.state()["epoch"] + 1)
        return restored
    old = wh.before(day).state()
    restored = files.restore_files(spark, archive_dir, input_dir, since=day)
    dropped = {d for ds in wh.state()["days"].values() for d in ds if d >= day}
    wh.rewind(old, dropped)
    return restored
