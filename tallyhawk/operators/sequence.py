"""Next / previous row within an ordered partition, safe for hot partitions.

A plain ``Window.partitionBy(card, day)`` puts every operation of one card
and day into one task; AQE cannot split a window partition. If one card
carries a third of all operations that task is the whole job.

:func:`find_hot` names such cards with a frequent-items sketch of the key
column alone (a partial aggregate: no shuffle, no other column read), and cuts
the time of each into stretches of equally many rows. Where there are none,
which is the usual case, the rules are plain windows over one read of their
input. Otherwise :func:`chunked` marks the rows of hot cards with their
stretch, and the windows below run inside (partition, stretch):

* :func:`with_next` computes ``lead`` inside each stretch, then stitches the
  last row of a stretch to the first row of the next one of the same
  partition. The first rows come from a grouped ``min_by`` (partially
  aggregated map-side); the ``lead`` over them runs over one row per stretch.
* :func:`with_previous` likewise hands each stretch the last k rows before it.

Rows of other cards have no stretch: they take the same exchange as the plain
window. Neighbours are counted in rows, not in time: no row is copied, the
borders may lie anywhere, and the results are exactly those of plain windows,
whatever cards are taken for hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Look for hot keys when the rule is built.
FIND = "find"
#: A key is hot with more rows than this and than one in HOT_SHARE of all rows (so there are fewer than HOT_SHARE).
HOT_ROWS = 100_000
HOT_SHARE = 1_000
#: Items a sketch keeps: ten times the keys it is asked for, so their counts are close. Each task of a load sends its sketch to the driver.
TRACKED = 10 * HOT_SHARE
#: Stretches of one hot key at most, which bounds the table of borders.
MAX_STRETCHES = 256

_CHUNK = "__chunk"


def frequent(key: str):
    """Aggregate: the most frequent values of ``key`` with their (estimated) counts, from a sketch of bounded size."""
    return F.expr(f"approx_top_k({key}, {HOT_SHARE}, {TRACKED})")


def hot_values(found, total: int, hot_rows: int = HOT_ROWS) -> list:
    """The values of a :func:`frequent` aggregate over ``total`` rows that are hot."""
    return [r["item"] for r in found or [] if r["item"] is not None and r["count"] > hot_rows and r["count"] > total / HOT_SHARE]


def find_hot(df: DataFrame, key: str, ts: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The hot values of ``key`` in ``df`` with the borders of their stretches of time; None where no key is hot."""
    r = df.agg(F.count(F.lit(1)).alias("n"), frequent(key).alias("found")).first()
    return borders(df, key, ts, hot_values(r["found"], r["n"], hot_rows), hot_rows)


def borders(df: DataFrame, key: str, ts: str, hot: list, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """(``key``, borders): times that cut the rows of each of the ``hot`` keys into stretches of about ``hot_rows`` rows."""
    if not hot:
        return None
    spark, kind = df.sparkSession, df.schema[key]
    rows = df.select(key, ts).join(F.broadcast(spark.createDataFrame([(v,) for v in hot], f"`{key}` {kind.dataType.simpleString()}")), key)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    stretches = max(2, min(MAX_STRETCHES, -(-counts // max(1, hot_rows))))
    at = F.percentile_approx(ts, [i / stretches for i in range(1, stretches)], 100 * stretches)
    found = rows.groupBy(key).agg(F.array_distinct(at).alias("borders")).collect()   # fewer than HOT_SHARE keys
    return spark.createDataFrame(found, f"`{key}` {kind.dataType.simpleString()}, borders array<{df.schema[ts].dataType.simpleString()}>")


def resolve(hot: DataFrame | str | None, df: DataFrame, key: str, ts: str, hot_rows: int | None = None) -> DataFrame | None:
    """``hot`` as it is, or looked for in ``df`` where it is :data:`FIND`."""
    return find_hot(df, key, ts, HOT_ROWS if hot_rows is None else hot_rows) if isinstance(hot, str) else hot


def chunked(df: DataFrame, hot: DataFrame | None, key: str, ts: str) -> DataFrame:
    """``df`` with the stretch of each row of a hot key, NULL for others; unchanged where ``hot`` is None.

    ``hot`` is broadcast: fewer than ``HOT_SHARE`` rows of at most ``MAX_STRETCHES`` times.
    """
    if hot is None:
        return df
    at = F.size(F.filter("borders", lambda b: b <= F.col(ts)))
    return df.join(F.broadcast(hot), key, "left").withColumn(_CHUNK, F.when(F.col("borders").isNotNull(), at)).drop("borders")


def with_next(df: DataFrame, part: list[str], order: list[str], cols: list[str], prefix: str = "next_") -> DataFrame:
    """Add ``next_<c>`` = value of ``c`` in the following row (NULL for the last row).

    Rows that :func:`chunked` marked are windowed by stretch; ``order[0]`` is the time it was marked by.
    """
    if _CHUNK not in df.columns:
        w = Window.partitionBy(*part).orderBy(*order)
        for c in cols:
            df = df.withColumn(prefix + c, F.lead(c).over(w))
        return df

    keys = [*part, _CHUNK]
    w = Window.partitionBy(*keys).orderBy(*order)
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    rows = df.withColumn("__nxt", F.lead(payload).over(w))

    # first row of every stretch, then the first row of the following one that has rows
    heads = df.filter(F.col(_CHUNK).isNotNull()).groupBy(*keys).agg(
        F.min_by(payload, F.struct(*[F.col(c) for c in order])).alias("__head"))
    wc = Window.partitionBy(*part).orderBy(_CHUNK)
    follow = heads.select(*keys, F.lead("__head").over(wc).alias("__follow"))

    # rows are already clustered and sorted by (part, stretch): the join only moves `follow`; NULL stretches meet nothing
    out = rows.join(follow, keys, "left")
    nxt = F.coalesce(F.col("__nxt"), F.col("__follow"))
    return out.select(*df.columns, *[nxt[c].alias(prefix + c) for c in cols])


def with_previous(df: DataFrame, part: list[str], order: list[str], cols: list[str], k: int,
                  prefix: str = "prev") -> DataFrame:
    """Add ``prev<i>_<c>`` for i = 1..k, the value ``i`` rows earlier."""
    names = [(i, c) for i in range(1, k + 1) for c in cols]
    if _CHUNK not in df.columns:
        w = Window.partitionBy(*part).orderBy(*order)
        return df.select("*", *[F.lag(c, i).over(w).alias(f"{prefix}{i}_{c}") for i, c in names])

    keys = [*part, _CHUNK]
    w = Window.partitionBy(*keys).orderBy(*order)
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    rows = df.select("*", F.row_number().over(w).alias("__at"),
                     *[F.lag(payload, i).over(w).alias(f"__lag{i}") for i in range(1, k + 1)])
    # each stretch's last k rows, latest first; then the k rows before each stretch
    last = df.filter(F.col(_CHUNK).isNotNull()).select(
        *keys, payload.alias("row"), F.row_number().over(w).alias("__at"), F.lead(F.lit(1), k).over(w).isNull().alias("__last"))
    tails = last.filter("__last").groupBy(*keys).agg(F.reverse(F.array_sort(F.collect_list(
        F.struct("__at", "row")))).alias("__tail"))       # k rows at most
    wc = Window.partitionBy(*part).orderBy(_CHUNK)
    earlier = F.concat(*[F.coalesce(F.lag("__tail", i).over(wc), F.slice("__tail", 1, 0)) for i in range(1, k + 1)])
    follow = tails.select(*keys, F.slice(earlier, 1, k).alias("__earlier"))
    # rows are already clustered and sorted by (part, stretch): the join only moves the few rows of `follow`
    out = rows.join(follow, keys, "left")

    def value(i: int):
        return F.coalesce(F.col(f"__lag{i}"), F.get(F.col("__earlier"), F.lit(i) - F.col("__at"))["row"])
    return out.select(*df.columns, *[value(i)[c].alias(f"{prefix}{i}_{c}") for i, c in names])
