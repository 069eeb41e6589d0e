"""Folding daily snapshots into a type-2 history inside one Spark application.

Each day's history is written as parquet under the cluster's shared
``spark.checkpoint.dir`` and read back, so the plan does not grow with the
number of days and a lost executor only recomputes part of one day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from tallyhawk.operators import scd2
from tallyhawk.schemas import INITIAL_WATERMARK, REFERENCE
from tallyhawk.session import ensure_checkpoint_dir, materialize

SNAPSHOT = "snapshot"      # full snapshot file, staged against open versions (terminals)
RESTAGE_ALL = "restage"    # relational source whose update_dt is NULL: every row staged each day


def empty_like(spark: SparkSession, src: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    types = {a: src.schema[a].dataType for a in attrs}
    return scd2.empty_history(spark, src.schema[key].dataType, types, key)


def fold_days(spark: SparkSession, days: Sequence, sources: Sequence[DataFrame], key: str,
              attrs: list[str], staging: str = SNAPSHOT, semantics: str = REFERENCE,
              hist: DataFrame | None = None, watermark=INITIAL_WATERMARK,
              checkpoint: bool = True) -> DataFrame:
    """Apply one merge per (day, source) in order; returns the final history."""
    ensure_checkpoint_dir(spark)
    if hist is None:
        hist = empty_like(spark, sources[0], key, attrs)
    for day, src in zip(days, sources):
        src = src.select(key, *attrs)
        if staging == RESTAGE_ALL:
            hist = scd2.scd2_merge(hist, scd2.stage_all(src, key, attrs, day), src.select(key), day, key, attrs, semantics)
            hist = materialize(hist, "history") if checkpoint else hist
        elif staging == SNAPSHOT:  # only snapshot staging filters on the watermark, observed while the day is written
            seen = Observation("watermark")
            hist = materialize(scd2.scd2_merge(hist, src, None, day, key, attrs, semantics, seen, watermark), "history")
            watermark = seen.get.get("max_update_dt") or watermark
        else:
            raise ValueError(f"unknown staging {staging!r}")
    return hist
