"""Daily loads triggered by arriving files (``foreachBatch``).

A file stream over the input folder notices new files; each
micro-batch runs :func:`tallyhawk.plans.daily.run_days`, which picks every
complete day present (all three kinds, earliest parsed day first), loads it,
commits and archives it. The batch rows are only a signal: nothing reads the
files through the stream, so archiving them is safe. The stream's checkpoint
records which arrivals were handled; the warehouse commit log records which
days were loaded, so a restarted stream neither skips nor repeats a day.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyhawk.plans import daily
from tallyhawk.plans.state import Warehouse
from tallyhawk.schemas import REFERENCE, STRICT


def ingest_on_arrival(spark: SparkSession, wh: Warehouse, input_dir: str, archive_dir: str,
                      sources: daily.Sources | Callable[[_dt.date], daily.Sources],
                      checkpoint_path: str, semantics: str = REFERENCE,
                      available_now: bool = True, every: str = "5 minutes") -> StreamingQuery:
    """Start the stream; every trigger with new input files loads all complete days."""
    arrivals = spark.readStream.format("text").option("recursiveFileLookup", "true").load(input_dir)

    def load(batch: DataFrame, batch_id: int) -> None:
        # strict operations: days by parsed date, all kinds required, idempotent reruns
        daily.run_days(spark, wh, input_dir, archive_dir, sources, semantics, operations=STRICT)

    w = arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
