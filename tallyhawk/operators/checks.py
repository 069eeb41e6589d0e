"""Key uniqueness and declared text lengths, checked before a day is published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    pass


def check_unique_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys occurring more than once, with their counts (partially aggregated map-side)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique_key(df: DataFrame, key: str | list[str], what: str = "table") -> None:
    bad = check_unique_key(df, key).limit(3).collect()
    if bad:
        raise ConstraintError(f"duplicate key in {what}: {[tuple(r) for r in bad]}")


def enforce_unique_key(df: DataFrame, key: str, what: str = "table") -> DataFrame:
    """``df`` with one row a key; a second row of a key fails the job that evaluates it. The rows are grouped once."""
    rest = [c for c in df.columns if c != key]
    one = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    message = F.concat(F.lit(f"duplicate key in {what}: "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col(key))
    return one.select(checked.alias(key), "_row.*").select(*df.columns)


def _all_there(df: DataFrame, max_lengths: dict[str, int]) -> None:
    if missing := sorted(set(max_lengths) - set(df.columns)):
        raise ConstraintError(f"declared columns are missing: {missing}")


def check_lengths(df: DataFrame, max_lengths: dict[str, int]) -> DataFrame:
    """Rows whose text columns exceed the declared lengths; every declared column must be there."""
    _all_there(df, max_lengths)
    if not max_lengths:
        return df.limit(0)
    cond = reduce(lambda a, b: a | b, [F.length(F.col(c)) > F.lit(n) for c, n in max_lengths.items()])
    return df.filter(cond)


def assert_lengths(df: DataFrame, max_lengths: dict[str, int], what: str = "table") -> None:
    bad = check_lengths(df, max_lengths).limit(3).collect()
    if bad:
        raise ConstraintError(f"value too long in {what}: {[r.asDict() for r in bad]}")


def enforce_lengths(df: DataFrame, max_lengths: dict[str, int], what: str = "table") -> DataFrame:
    """``df`` unchanged, but any value longer than declared fails the job that evaluates it.

    The check rides inside whatever job writes ``df``: no extra pass over the data.
    """
    _all_there(df, max_lengths)
    out = df
    for c, n in max_lengths.items():
        too_long = F.length(F.col(c)) > F.lit(n)
        msg = F.concat(F.lit(f"value too long in {what}.{c} (max {n}): "), F.col(c).cast("string"))
        out = out.withColumn(c, F.when(too_long, F.raise_error(msg)).otherwise(F.col(c)))
    return out
