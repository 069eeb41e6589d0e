"""Many days in one job: history from all snapshots at once, and the as-of join.

``scd2_from_snapshots`` builds the strict type-2 history of a sequence of
full snapshots without folding day by day (gaps and islands): per key,
consecutive snapshot days with equal attributes form one version; a version
ends the day before the key changes (open again) or disappears (closed and
flagged deleted). The rows are moved by key and sorted once, without an
aggregate before: a key has one row per snapshot day (a second one fails the
job), so the windows' groups are bounded by the number of days and a task
holds the rows of its partition once.

``temporal_chain`` intersects the card, account and client histories into the
versions of the whole chain: equi joins on the keys with overlapping
validity, so a card has one row for each stretch of days on which nothing of
it changed. ``asof_join`` attaches to each fact row the version valid on its day: an
equi join on the key with the validity interval as a residual condition
(never a cross join). The deletion flag is ignored: it is set after the fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.functions.scalars import open_end


#: Snapshot rows of one task, where their number is known.
ROWS_PER_TASK = 500_000


def tasks_for(rows: int) -> int:
    """Partitions in which ``rows`` rows are at most about :data:`ROWS_PER_TASK` each."""
    return max(1, -(-rows // ROWS_PER_TASK))


def scd2_from_snapshots(snapshots: DataFrame, key: str, attrs: list[str], day_col: str = "day",
                        days: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Strict history from ``snapshots`` (key, attrs..., day), one full snapshot per day.

    ``days`` lists every snapshot day (defaults to the days present in
    ``snapshots``); a key missing on a listed day is deleted on that day.
    ``rows``, where the caller knows a bound of the snapshots' rows, sets the number
    of tasks; without it AQE sizes them by the bytes it measures.
    """
    cal = (days if days is not None else snapshots.select(day_col).distinct()).select(F.col(day_col).alias("day"))
    cal = cal.withColumn("idx", F.row_number().over(Window.orderBy("day")))   # one row per day
    last_idx = cal.agg(F.max("idx")).scalar()
    s = snapshots.select(key, *attrs, F.col(day_col).alias("day")).filter(F.col("day").isNotNull())
    # moved by key once and sorted by (key, day) once: all windows below share both
    s = s.repartition(key) if rows is None else s.repartition(tasks_for(rows), key)
    by_day = Window.partitionBy(key).orderBy("day")
    # a key listed twice in a snapshot fails the job
    checked = F.when(F.lag("day").over(by_day) == F.col("day"), F.raise_error(F.concat(
        F.lit(f"duplicate key {key}="), F.col(key).cast("string")))).otherwise(F.lit(True))
    s = s.withColumn("_checked", checked).filter("_checked").join(F.broadcast(cal), "day").select(key, *attrs, "day", "idx")

    s = s.withColumn("_prev_idx", F.lag("idx").over(by_day)) \
        .withColumn("_prev", F.lag(F.struct(*[F.col(a) for a in attrs])).over(by_day)) \
        .withColumn("_key_last", F.max("idx").over(Window.partitionBy(key)))
    changed = reduce(lambda x, y: x | y, [~F.col(a).eqNullSafe(F.col("_prev")[a]) for a in attrs])
    new_island = F.col("_prev_idx").isNull() | (F.col("_prev_idx") != F.col("idx") - 1) | changed

    # an island is its first row; it ends with the row before the next one's first
    isl = s.filter(new_island).drop("_prev") \
        .withColumn("_next_first", F.lead("idx").over(by_day)) \
        .withColumn("_last", F.coalesce(F.lead("_prev_idx").over(by_day), "_key_last"))
    ends = cal.select(F.col("idx").alias("_end_idx"), F.date_sub("day", 1).alias("_end_day"))
    isl = isl.join(F.broadcast(ends), F.col("_end_idx") == F.col("_last") + 1, "left")
    is_open = F.col("_last") == last_idx
    deleted = ~is_open & (F.col("_next_first").isNull() | (F.col("_next_first") != F.col("_last") + 1))
    return isl.select(
        key, *attrs, F.col("day").alias("effective_from"),
        F.when(is_open, open_end()).otherwise(F.col("_end_day")).alias("effective_to"),
        deleted.alias("deleted_flg"))


def asof_join(facts: DataFrame, hist: DataFrame, fact_key: str, hist_key: str, day_col: str,
              cols: list[str], how: str = "inner") -> DataFrame:
    """Each fact row with the columns of the version valid on ``day_col`` (closed interval)."""
    h = hist.select(F.col(hist_key).alias("__k"), F.col("effective_from").alias("__from"),
                    F.col("effective_to").alias("__to"), *cols)
    cond = ((F.col(fact_key) == F.col("__k")) & (F.col("__from") <= F.col(day_col))
            & (F.col(day_col) <= F.col("__to")))
    return facts.join(h, cond, how).drop("__k", "__from", "__to")


def _overlap(a: str, b: str) -> Column:
    return (F.col(f"{a}.effective_from") <= F.col(f"{b}.effective_to")) & (F.col(f"{b}.effective_from") <= F.col(f"{a}.effective_to"))


def _common(a: str, b: str) -> list[Column]:
    return [F.greatest(f"{a}.effective_from", f"{b}.effective_from").alias("effective_from"),
            F.least(f"{a}.effective_to", f"{b}.effective_to").alias("effective_to")]


def temporal_chain(cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """card -> account -> client with the days (closed interval) on which that was the chain.

    The histories are strict ones: versions of a key do not overlap, so neither
    do the chain's of a card, and there are at most as many as versions of its
    parts. The deletion flag is ignored: it is set after the fact. On any day
    the rows valid then are :func:`tallyhawk.operators.chain.dim_chain` of the
    dimensions as they were on that day.
    """
    valid = ["effective_from", "effective_to"]
    c = cards.select("card_num", "account_num", *valid).alias("c")
    a = accounts.select(F.col("account_num"), "valid_to", F.col("client").alias("client_id"), *valid).alias("a")
    k = clients.select("client_id", "fio", "passport_num", "passport_valid_to", "phone", *valid).alias("k")
    ca = c.join(a, (F.col("c.account_num") == F.col("a.account_num")) & _overlap("c", "a")).select(
        "card_num", "c.account_num", "valid_to", "client_id", *_common("c", "a")).alias("ca")
    return ca.join(k, (F.col("ca.client_id") == F.col("k.client_id")) & _overlap("ca", "k")).select(
        "card_num", "account_num", "valid_to", "ca.client_id", "fio", "passport_num", "passport_valid_to", "phone",
        *_common("ca", "k"))
