"""Type-2 history: staging, classification, merge, watermark.

A merge is a pure function ``(history, staged rows, source keys, day) -> history``.
History rows carry ``effective_from``, ``effective_to`` (2999-01-01 while open)
and ``deleted_flg``; a version is valid on the closed day interval.

Two semantics (SURVEY §2.11):

``reference`` reproduces the daily load statement by statement:
  * a staged key absent from *all* history is inserted;
  * a staged key whose attributes differ from *any* of its versions is
    "changed": its open version is closed at ``day - 1`` and a new one opened
    (so a key that ever changed re-versions whenever it is staged again);
  * every version of a key missing from the source is closed at ``day - 1``
    and flagged deleted, again on every later run.
``strict`` compares with the open version only, opens a new version for a
key that returns after deletion, and closes/flags only the open version once.

Physical shape: staged rows and source keys are aggregated to one row per
key (partially, map-side), unioned with the history and classified with
window aggregates over ``key`` -- one exchange of the history per day, no
self-join. Window groups are one key's versions (bounded by the number of
runs) plus one row, so even a key copied into a third of a source's rows
cannot make a hot group.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.functions.scalars import open_end
from tallyhawk.schemas import INITIAL_WATERMARK, REFERENCE, STRICT

VERSION_COLS = ["effective_from", "effective_to", "deleted_flg"]


def _day(day) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def _wm(watermark) -> Column:
    if watermark is None:
        return F.lit(INITIAL_WATERMARK)
    return watermark if isinstance(watermark, Column) else F.lit(watermark).cast("date")


def _check(semantics: str) -> None:
    if semantics not in (REFERENCE, STRICT):
        raise ValueError(f"semantics must be {REFERENCE!r} or {STRICT!r}, got {semantics!r}")


def empty_history(spark, key_type: T.DataType, attr_types: dict[str, T.DataType], key: str) -> DataFrame:
    fields = [T.StructField(key, key_type)] + [T.StructField(a, t) for a, t in attr_types.items()] + [
        T.StructField("effective_from", T.DateType()), T.StructField("effective_to", T.DateType()),
        T.StructField("deleted_flg", T.BooleanType())]
    return spark.createDataFrame([], T.StructType(fields))


def _differs(attrs: list[str], staged_struct: str) -> Column:
    parts = [~F.col(a).eqNullSafe(F.col(staged_struct)[a]) for a in attrs]
    return reduce(lambda x, y: x | y, parts) if parts else F.lit(False)


def _is_open(col_prefix: str = "") -> Column:
    return (F.col(col_prefix + "effective_to") == open_end()) & (F.col(col_prefix + "deleted_flg") == F.lit(False))


# --- staging ---------------------------------------------------------------------

def stage_incremental(src: DataFrame, key: str, attrs: list[str], watermark, day,
                      update_col: str = "update_dt", semantics: str = REFERENCE) -> DataFrame:
    """Rows changed since the watermark: ``update_dt > watermark or update_dt is null``.

    reference: the staged ``update_dt`` is the run day (so the watermark
    advances to the run day). strict: the source ``update_dt`` is kept, so the
    watermark becomes the newest source change actually seen.
    """
    _check(semantics)
    u = F.col(update_col)
    staged = src.filter((u > _wm(watermark)) | u.isNull())
    stamp = _day(day) if semantics == REFERENCE else u
    return staged.select(key, *attrs, stamp.cast("date").alias("update_dt"))


def stage_all(src: DataFrame, key: str, attrs: list[str], day) -> DataFrame:
    """Every source row staged (a source whose ``update_dt`` is always NULL)."""
    return src.select(key, *attrs, _day(day).alias("update_dt"))


def stage_snapshot(snapshot: DataFrame, hist: DataFrame, key: str, attrs: list[str], watermark, day) -> DataFrame:
    """Snapshot rows that are new or changed against the open versions.

    Each snapshot row is matched (null-safe, on key and all attributes) with
    the open, not deleted version; ``update_dt`` is that version's start, or
    the run day when nothing matches. Rows with ``update_dt > watermark`` are
    staged -- in steady state exactly the new and changed rows.
    """
    cols = [key, *attrs]
    cur = hist.filter(_is_open()).select(*[F.col(c).alias(f"__h_{c}") for c in cols],
                                         F.col("effective_from").alias("__h_from"))
    cond = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__h_{c}")) for c in cols])
    j = snapshot.select(*cols).join(cur, cond, "left")
    upd = F.coalesce(F.col("__h_from"), _day(day))
    return j.select(*cols, upd.alias("update_dt")).filter(F.col("update_dt") > _wm(watermark))


def watermark_advance(staged: DataFrame, old) -> Column:
    """``coalesce(max(staged.update_dt), old)`` as a scalar-subquery column."""
    return F.coalesce(staged.select(F.max("update_dt")).scalar(), _wm(old))


# --- classification ------------------------------------------------------------

def classify(hist: DataFrame, staged: DataFrame, source_keys: DataFrame | None, key: str, attrs: list[str],
             semantics: str = REFERENCE, since=None, day=None) -> DataFrame:
    """History plus one row per source key, with per-key flags.

    Staged rows and source keys are first aggregated to one row per key
    (role ``sk``: the staged attributes, ``__upd``, and the counts ``__ns`` /
    ``__nk``). The aggregation is partial map-side, so a key that a broken
    source repeats in a third of its rows collapses to counts before any
    shuffle, and the window below never sees more than one key's versions
    plus one row. Columns: key, attrs, version columns, ``__role`` (h / sk),
    ``__in_hist`` (key has any version), ``__has_open`` (key has an open
    version), ``__present`` (key is in the source), ``__changed``,
    ``__staged`` and ``__dups`` (most staged or source rows of the key).

    With ``source_keys=None`` the rows are a whole snapshot, which also lists the
    source's keys, and the window decides what :func:`stage_snapshot` would stage
    (``since`` its watermark, on ``day``): a row that equals the open version has
    that version's start for ``update_dt``, any other the day. The history is
    moved once, where staging before the merge moves its open versions twice.
    """
    _check(semantics)
    whole = source_keys is None
    attr_struct = T.StructType([T.StructField(a, hist.schema[a].dataType) for a in attrs])
    upd = F.col("update_dt").cast("date") if "update_dt" in staged.columns else F.lit(None).cast("date")
    s = staged.select(key, F.struct(*[F.col(a) for a in attrs]).cast(attr_struct).alias("__sv"),
                      upd.alias("__upd"), F.lit(1).alias("__ns"), F.lit(1 if whole else 0).alias("__nk"))
    if not whole:
        s = s.unionByName(source_keys.select(
            key, F.lit(None).cast(attr_struct).alias("__sv"), F.lit(None).cast("date").alias("__upd"),
            F.lit(0).alias("__ns"), F.lit(1).alias("__nk")))
    sk = s.groupBy(key).agg(
        F.max("__sv").alias("__sv"), F.max("__upd").alias("__upd"),
        F.sum("__ns").alias("__ns"), F.sum("__nk").alias("__nk"))
    sk = sk.select(key, *[F.col("__sv")[a].alias(a) for a in attrs],
                   *[F.lit(None).cast(t).alias(c) for c, t in (("effective_from", "date"),
                                                               ("effective_to", "date"),
                                                               ("deleted_flg", "boolean"))],
                   F.lit("sk").alias("__role"), "__sv", "__upd", "__ns", "__nk")
    h = hist.select(key, *attrs, *VERSION_COLS, F.lit("h").alias("__role"),
                    F.lit(None).cast(attr_struct).alias("__sv"), F.lit(None).cast("date").alias("__upd"),
                    F.lit(0).cast("long").alias("__ns"), F.lit(0).cast("long").alias("__nk"))
    u = h.unionByName(sk)

    w = Window.partitionBy(key)
    role = F.col("__role")
    is_h = role == "h"
    u = (u.withColumn("__s", F.max("__sv").over(w))
          .withColumn("__in_hist", F.max(is_h).over(w))
          .withColumn("__has_open", F.max(is_h & _is_open()).over(w))
          .withColumn("__present", F.max(role == "sk").over(w))
          .withColumn("__staged", F.col("__ns") > 0)
          .withColumn("__dups", F.greatest("__ns", "__nk")))
    if whole:
        same = is_h & _is_open() & F.col("__s").isNotNull() & ~_differs(attrs, "__s")
        u = u.withColumn("__since", F.coalesce(F.max(F.when(same, F.col("effective_from"))).over(w), _day(day)))
        new = F.col("__since") > _wm(since)
        u = (u.withColumn("__s", F.when(new, F.col("__s")))
              .withColumn("__staged", F.col("__staged") & new)
              .withColumn("__upd", F.when(F.col("__staged"), F.col("__since"))).drop("__since"))
    compared = is_h if semantics == REFERENCE else (is_h & _is_open())
    diff = compared & F.col("__s").isNotNull() & _differs(attrs, "__s")
    return u.withColumn("__changed", F.max(diff).over(w))


def scd2_merge(hist: DataFrame, staged: DataFrame, source_keys: DataFrame | None, day, key: str,
               attrs: list[str], semantics: str = REFERENCE, observation=None, since=None) -> DataFrame:
    """One day's type-2 merge; returns the complete new history.

    ``staged`` with ``source_keys`` are a day's staged rows and the source's keys; ``staged`` with
    ``source_keys=None`` is a whole snapshot, staged within the merge against the watermark ``since``.

    A key staged or listed twice fails the job that evaluates the result (the
    reference's primary keys), inside the same pass. With ``observation`` (a
    ``pyspark.sql.Observation``) the new watermark ``max_update_dt`` of the
    staged rows is collected while the result is written.
    """
    c = classify(hist, staged, source_keys, key, attrs, semantics, since, day)
    if observation is not None:
        c = c.observe(observation, F.max("__upd").alias("max_update_dt"))
    d = _day(day)
    prev = F.date_sub(d, 1)
    role = F.col("__role")
    changed, present = F.col("__changed"), F.col("__present")
    to, flag = F.col("effective_to"), F.col("deleted_flg")

    if semantics == REFERENCE:
        new_to = (F.when(~present, prev)
                   .when(changed & (to == open_end()), prev)
                   .otherwise(to))
        new_flag = F.when(~present, F.lit(True)).otherwise(flag)
        insert = ~F.col("__in_hist") | changed
    else:
        live = _is_open()
        new_to = F.when(live & (~present | changed), prev).otherwise(to)
        new_flag = F.when(live & ~present, F.lit(True)).otherwise(flag)
        insert = ~F.col("__has_open") | changed

    # one projection emits both the rewritten versions (h rows) and the new ones
    # (staged sk rows): a second branch would re-run the exchange and windows
    is_h = role == "h"
    dup = F.col("__dups") > 1
    checked_key = F.when(dup, F.raise_error(F.concat(F.lit(f"duplicate key {key}="), F.col(key).cast("string"))))\
        .otherwise(F.col(key))
    out = c.filter(is_h | ((role == "sk") & F.col("__staged") & insert) | dup).select(
        checked_key.alias(key), *attrs,
        F.when(is_h, F.col("effective_from")).otherwise(d).alias("effective_from"),
        F.when(is_h, new_to).otherwise(open_end()).alias("effective_to"),
        F.when(is_h, new_flag).otherwise(F.lit(False)).alias("deleted_flg"))
    return out


# --- the four steps as separate operators (for inspection and tests) ------------------

def scd2_new(hist: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Staged rows whose key has no version at all (anti join)."""
    return staged.join(hist.select(key), key, "left_anti")


def scd2_changed(hist: DataFrame, staged: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Distinct staged rows differing from some version of their key (reference Q1)."""
    s, h = staged.alias("s"), hist.alias("h")
    cond = (F.col(f"s.{key}") == F.col(f"h.{key}")) & reduce(
        lambda x, y: x | y, [~F.col(f"s.{a}").eqNullSafe(F.col(f"h.{a}")) for a in attrs])
    return s.join(h, cond, "left_semi").select(key, *attrs).distinct()


def scd2_close(hist: DataFrame, changed_keys: DataFrame, day, key: str) -> DataFrame:
    """Close (``day - 1``) the open versions of the changed keys."""
    flags = changed_keys.select(key).distinct().withColumn("__chg", F.lit(True))
    j = hist.join(flags, key, "left")
    to = F.col("effective_to")
    new_to = F.when(F.col("__chg").isNotNull() & (to == open_end()), F.date_sub(_day(day), 1)).otherwise(to)
    return j.withColumn("effective_to", new_to).drop("__chg").select(*hist.columns)


def scd2_deleted(hist: DataFrame, source_keys: DataFrame, day, key: str) -> DataFrame:
    """Close and flag every version of keys missing from the source (reference Q4)."""
    flags = source_keys.select(key).distinct().withColumn("__src", F.lit(True))
    j = hist.join(flags, key, "left")
    missing = F.col("__src").isNull()
    return (j.withColumn("effective_to", F.when(missing, F.date_sub(_day(day), 1)).otherwise(F.col("effective_to")))
             .withColumn("deleted_flg", F.when(missing, F.lit(True)).otherwise(F.col("deleted_flg")))
             .drop("__src").select(*hist.columns))


def history_stats(hist: DataFrame) -> DataFrame:
    """rows / open / deleted counts of a history."""
    return hist.agg(F.count(F.lit(1)).alias("rows"),
                    F.count(F.when(_is_open(), 1)).alias("open"),
                    F.count(F.when(F.col("deleted_flg"), 1)).alias("deleted"))


def as_of(hist: DataFrame, day: _dt.date | Column) -> DataFrame:
    """Versions valid on ``day`` (closed interval), ignoring the deletion flag."""
    d = _day(day)
    return hist.filter((F.col("effective_from") <= d) & (d <= F.col("effective_to")))
