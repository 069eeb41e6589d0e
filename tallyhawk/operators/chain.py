"""Current dimension rows, the card -> account -> client chain, and size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.functions.scalars import open_end

# Upper bound of rows for a dimension we broadcast. A chain row is ~120 bytes,
# so a broadcast stays near 6 MB: a day has about ten of them and each passes
# through the driver. Beyond it we shuffle-join.
BROADCAST_MAX_ROWS = 50_000


def current(hist: DataFrame) -> DataFrame:
    """Open, not deleted versions (``deleted_flg is false and effective_to = open``).

    A NULL flag does not pass, as with ``is false`` / ``= false``.
    """
    return hist.filter((F.col("deleted_flg") == F.lit(False)) & (F.col("effective_to") == open_end()))


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` where its row count, measured when it was written, is within the bound; shuffle it beyond.

    Spark would broadcast a table by the size of its files, which says little
    about its rows once they are read. Without a count the join is left as it
    is: AQE measures both sides and broadcasts one below its own size limit.
    No job runs to find out.
    """
    if known_rows is None:
        return df
    return F.broadcast(df) if known_rows <= max_rows else df.hint("merge")


def dim_chain(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
              known_rows: tuple[int | None, int | None, int | None] = (None, None, None)) -> DataFrame:
    """card -> account -> client over current rows.

    Written as inner joins: the reference's LEFT joins are null-rejected by
    the filters on the right side. Keys are unique among current rows, so
    the chain has at most one row per card. ``known_rows``: the current rows
    of each, where they were counted.
    """
    c = current(cards).select("card_num", "account_num")
    a = current(accounts).select("account_num", "valid_to", F.col("client").alias("client_id"))
    k = current(clients).select("client_id", "fio", "passport_num", "passport_valid_to", "phone")
    c, a, k = (broadcast_if_small(df, known_rows=n) for df, n in zip((c, a, k), known_rows))
    return c.join(a, "account_num").join(k, "client_id").select(
        "card_num", "account_num", "valid_to", "client_id", "fio",
        "passport_num", "passport_valid_to", "phone")
