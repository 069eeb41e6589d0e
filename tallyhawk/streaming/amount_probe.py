"""Rule 4 on a stream of transaction files, in event order whatever the order of arrival.

Each micro-batch is a batch job over the rows not settled yet and the new
ones. The watermark is the latest operation seen less ``delay``: up to it
the sequence of every card is known, so the shipped batch rule
(:func:`tallyhawk.operators.fraud.amount_probes`, across days) reports the hits between
the old watermark and the new one. Kept for the next batch are the rows after
the new watermark and, as context, those within the rule's span before it: a
match lies within the span. A row that is not after the old watermark comes
too late to be placed and goes to the late output.

The kept rows, the watermark, the hits and the late rows of batch n are
written to folders named after n, overwriting what a failed attempt left, so
a restarted stream repeats a batch to the same result. :func:`settle` reports
the hits after the last watermark once no more rows can come.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhawk.functions.intervals import to_micros
from tallyhawk.operators import fraud
from tallyhawk.schemas import FACT_TRANSACTIONS, PROBE_SPAN
from tallyhawk.sources.files import RAW_OPTIONS, RAW_TRANSACTIONS, parse_transactions

HIT_SCHEMA = "trans_id string, card_num string, trans_day date, trans_date timestamp_ntz"
MARK_SCHEMA = "mark timestamp_ntz"


def transactions_stream(spark: SparkSession, input_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Good rows of ``;``-separated transaction files as they arrive."""
    raw = (spark.readStream.schema(RAW_TRANSACTIONS).option("sep", ";").option("header", True)
           .options(**RAW_OPTIONS))
    if max_files_per_trigger:
        raw = raw.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_transactions(raw.csv(input_glob)).filter(F.col("_reject").isNull()).drop("_reject", "_amount_text")


def _held(spark: SparkSession, checkpoint_path: str, batch_id: int) -> tuple[DataFrame, _dt.datetime | None]:
    """Rows kept by a batch and its watermark; nothing before the first."""
    if batch_id < 0:
        return spark.createDataFrame([], FACT_TRANSACTIONS), None
    mark = spark.read.schema(MARK_SCHEMA).parquet(f"{checkpoint_path}/rule4/mark/v={batch_id}").first()[0]
    return spark.read.schema(FACT_TRANSACTIONS).parquet(f"{checkpoint_path}/rule4/rows/v={batch_id}"), mark


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def run_probe_stream(spark: SparkSession, input_glob: str, output_path: str, checkpoint_path: str,
                     max_span=PROBE_SPAN, delay="1 day",
                     max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream; hits go to ``output_path``/batch=<n>, late rows to ``output_path``_late/batch=<n>."""
    delay_by = _dt.timedelta(microseconds=to_micros(delay))
    span = _dt.timedelta(microseconds=to_micros(max_span))

    def step(batch: DataFrame, batch_id: int) -> None:
        held, old = _held(spark, checkpoint_path, batch_id - 1)
        new = batch.select(*FACT_TRANSACTIONS.fieldNames())
        if old is not None:
            _write(new.filter(F.col("trans_date") <= F.lit(old)), f"{output_path}_late/batch={batch_id}")
            new = new.filter(F.col("trans_date") > F.lit(old))
        rows = held.unionByName(new)
        latest = rows.agg(F.max("trans_date")).first()[0]
        mark = max((m for m in (old, latest and latest - delay_by) if m is not None), default=None)
        if mark is not None and (old is None or mark > old):
            hits = fraud.amount_probes(rows, max_span=max_span, per_day=False).filter(
                F.col("trans_date") <= F.lit(mark))
            if old is not None:
                hits = hits.filter(F.col("trans_date") > F.lit(old))
            _write(hits, f"{output_path}/batch={batch_id}")
            rows = rows.filter(F.col("trans_date") >= F.lit(mark - span))
        _write(rows, f"{checkpoint_path}/rule4/rows/v={batch_id}")
        _write(spark.createDataFrame([(mark,)], MARK_SCHEMA), f"{checkpoint_path}/rule4/mark/v={batch_id}")

    w = transactions_stream(spark, input_glob, max_files_per_trigger).writeStream.foreachBatch(step) \
        .option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def settle(spark: SparkSession, output_path: str, checkpoint_path: str, last_batch: int, max_span=PROBE_SPAN) -> None:
    """Report the hits after the watermark of ``last_batch``; to be called when the stream has ended."""
    rows, mark = _held(spark, checkpoint_path, last_batch)
    hits = fraud.amount_probes(rows, max_span=max_span, per_day=False)
    if mark is not None:
        hits = hits.filter(F.col("trans_date") > F.lit(mark))
    _write(hits, f"{output_path}/batch={last_batch + 1}")


def read_hits(spark: SparkSession, output_path: str) -> DataFrame:
    """All reported hits."""
    return spark.read.schema(HIT_SCHEMA + ", batch long").parquet(output_path).drop("batch")
