"""Domain views over the driver's generated tables.

The driver tables (events, customer, orders, ...) are reshaped into the
warehouse's shapes so every operator runs on data that grows with the scale
factor. ``oracle.py`` holds the same definitions in DuckDB SQL.

Fixed values of the views:
  oper_result: click, view, error -> REJECT; purchase -> SUCCESS; other -> OTHER
  terminal: integer k of events.props; city CITY_<id mod 5>; deleted when id mod 23 = 0
  card = c_custkey, account = c_custkey + 1000000, client = c_custkey + 2000000
  card deleted when c_custkey mod 19 = 0
  contract valid_to = 2024-01-01 + (c_custkey * 11) mod 45 days
  passport P<c_custkey>, valid_to NULL when c_custkey mod 29 = 3,
    else 2024-01-01 + (c_custkey * 7) mod 60 days
  blacklisted when c_custkey mod 13 = 0
  versions of fixture dimensions start 2023-01-01; deleted ones end 2023-12-31
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.schemas import FACT_TRANSACTIONS, OPEN_END

FIXTURE_FROM = _dt.date(2023, 1, 1)
FIXTURE_CLOSED_TO = _dt.date(2023, 12, 31)
BASE_DAY = _dt.date(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days_after(base: _dt.date, n: Column) -> Column:
    return F.date_add(F.lit(base), n.cast("int"))


def _versioned(df: DataFrame, deleted: Column) -> DataFrame:
    return df.select(
        "*",
        F.lit(FIXTURE_FROM).alias("effective_from"),
        F.when(deleted, F.lit(FIXTURE_CLOSED_TO)).otherwise(F.lit(OPEN_END)).alias("effective_to"),
        deleted.alias("deleted_flg"),
    )


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("trans_id"),
        F.col("ts").alias("trans_date"),
        F.to_date("ts").alias("trans_day"),
        F.col("value").alias("amt"),
        F.col("user_id").alias("card_num"),
        et.alias("oper_type"),
        F.when(et.isin("click", "view", "error"), F.lit("REJECT"))
         .when(et == "purchase", F.lit("SUCCESS"))
         .otherwise(F.lit("OTHER")).alias("oper_result"),
        F.get_json_object("props", "$.k").cast("int").alias("terminal"),
    )


def tx_as_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operations with the fact table's types."""
    return tx(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_TRANSACTIONS])


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = tx(spark, sf_dir).select(F.col("terminal").alias("terminal_id")).distinct()
    i = F.col("terminal_id")
    base = ids.select(
        i,
        F.when(i % 3 == 0, F.lit("ATM")).otherwise(F.lit("POS")).alias("terminal_type"),
        F.concat(F.lit("CITY_"), (i % 5).cast("string")).alias("terminal_city"),
        F.concat(F.lit("ADDR_"), i.cast("string")).alias("terminal_address"),
    )
    return _versioned(base, i % 23 == 0)


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer").select(
        k.alias("card_num"), (k + 1000000).alias("account_num"))
    return _versioned(base, F.col("card_num") % 19 == 0)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer").select(
        (k + 1000000).alias("account_num"),
        _days_after(BASE_DAY, (k * 11) % 45).alias("valid_to"),
        (k + 2000000).alias("client"),
    )
    return _versioned(base, F.lit(False))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer").select(
        (k + 2000000).alias("client_id"),
        F.col("c_name").alias("fio"),
        _days_after(_dt.date(1960, 1, 1), k % 15000).alias("date_of_birth"),
        F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
        F.when(k % 29 == 3, F.lit(None).cast("date"))
         .otherwise(_days_after(BASE_DAY, (k * 7) % 60)).alias("passport_valid_to"),
        F.concat(F.lit("+7"), F.lpad(k.cast("string"), 10, "0")).alias("phone"),
    )
    return _versioned(base, F.lit(False))


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter(k % 13 == 0).select(
        F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
        F.lit(BASE_DAY).alias("entry_dt"),
    )


# --- SCD2 inputs -------------------------------------------------------------
# Three daily snapshots of (k, s) with new, changed, to-NULL, reverted, deleted
# and returning keys (fixed definitions of the driver views S1, S2, S3).

SCD2_DAYS = (_dt.date(2024, 3, 1), _dt.date(2024, 3, 2), _dt.date(2024, 3, 3))


def snapshot(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    if n == 1:
        return c.filter(k % 10 != 0).select(k.alias("k"), seg.alias("s"))
    if n == 2:
        s = F.when(k % 5 == 1, F.lit("CHANGED")).when(k % 11 == 2, F.lit(None)).otherwise(seg)
        return c.filter(k % 7 != 3).select(k.alias("k"), s.alias("s"))
    if n == 3:
        s = (F.when((k % 5 == 1) & (k % 2 == 0), F.lit("CHANGED"))
              .when(k % 11 == 2, F.lit(None)).otherwise(seg))
        return c.filter(k % 9 != 4).select(k.alias("k"), s.alias("s"))
    raise ValueError(n)


def snapshot_as(kind: str, snap: DataFrame) -> DataFrame:
    """Shape a (k, s) snapshot as one of the four dimensions' sources.

    s carries the changing attribute; the others are fixed per key.
    """
    k, s = F.col("k"), F.col("s")
    if kind == "terminals":
        return snap.select(k.alias("terminal_id"), s.alias("terminal_type"),
                           F.concat(F.lit("CITY_"), (k % 5).cast("string")).alias("terminal_city"),
                           F.concat(F.lit("ADDR_"), k.cast("string")).alias("terminal_address"))
    if kind == "cards":
        return snap.select(k.alias("card_num"), s.alias("account_num"))
    if kind == "accounts":
        return snap.select(k.alias("account_num"), _days_after(BASE_DAY, (k * 11) % 45).alias("valid_to"),
                           s.alias("client"))
    if kind == "clients":
        return snap.select(k.alias("client_id"), s.alias("fio"),
                           _days_after(_dt.date(1960, 1, 1), k % 15000).alias("date_of_birth"),
                           F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
                           _days_after(BASE_DAY, (k * 7) % 60).alias("passport_valid_to"),
                           F.lit(None).cast("string").alias("phone"))
    raise ValueError(kind)


# Source tables with an update_dt: NULL when c_custkey mod 4 = 0, else
# 2024-01-01 + (c_custkey mod 10) days. Staged against watermark 2024-01-05.
STAGE_WATERMARK = _dt.date(2024, 1, 5)
STAGE_DAY = _dt.date(2024, 1, 10)


def _update_dt(k: Column) -> Column:
    return F.when(k % 4 == 0, F.lit(None).cast("date")).otherwise(_days_after(BASE_DAY, k % 10))


def source_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("card_num"), (k + 1000000).alias("account"), _update_dt(k).alias("update_dt"))


def source_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (k + 1000000).alias("account"), _days_after(BASE_DAY, (k * 11) % 45).alias("valid_to"),
        (k + 2000000).alias("client"), _update_dt(k).alias("update_dt"))


def source_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name parts come from c_name ``Customer#000000042``; patronymic is NULL when k mod 6 = 0."""
    k = F.col("c_custkey")
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        (k + 2000000).alias("client_id"),
        F.split_part(name, F.lit("#"), F.lit(1)).alias("last_name"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("first_name"),
        F.when(k % 6 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("N"), (k % 7).cast("string"))).alias("patronymic"),
        _days_after(_dt.date(1960, 1, 1), k % 15000).alias("date_of_birth"),
        F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
        F.when(k % 29 == 3, F.lit(None).cast("date"))
         .otherwise(_days_after(BASE_DAY, (k * 7) % 60)).alias("passport_valid_to"),
        F.concat(F.lit("+7"), F.lpad(k.cast("string"), 10, "0")).alias("phone"),
        _update_dt(k).alias("update_dt"))
