"""Sinks: the day's facts and report, the full-refresh snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

APPEND = "append"          # the reference: a rerun adds the rows again
OVERWRITE_DAY = "overwrite_day"  # idempotent: a rerun replaces what the input day wrote before


def live_versions(before: list[int], version: int, mode: str = OVERWRITE_DAY) -> list[int]:
    """The versions of an input day's rows to read once ``version`` is written."""
    if mode not in (APPEND, OVERWRITE_DAY):
        raise ValueError(f"unknown mode {mode!r}")
    return [*before, version] if mode == APPEND else [version]


def write_day(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Write one version of an input day's rows; an empty frame is a version without rows."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(partition_col) if partition_col else w).parquet(path)


def refresh_snapshot(df: DataFrame, path: str) -> None:
    """Full refresh (delete all + insert): the new snapshot replaces the table at ``path``.

    ``path`` must not be an input of ``df``; the warehouse writes each refresh
    to a fresh version path.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
