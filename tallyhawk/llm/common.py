"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.session import ensure_checkpoint_dir, materialize, ship_package

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library: its allocator is left alone
    _libc = None

#: What a Python worker keeps from task to task of one operator; workers serve all operators in turn.
kept: dict = {}
#: Rows of an Arrow batch, at most: of whole texts Spark's default of 10,000 holds tens of MB, several times over.
BATCH_ROWS = 2000
#: Largest key filter: 2^28 bits, 32 MB, whatever the number of keys.
MAX_FILTER_BITS = 28


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder known, package importable by the Python workers, batches of texts bounded."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:  # none, or more
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written in the cluster's shared folder; survives lost executors."""
    return materialize(df, "llm")


def release(*tables: DataFrame) -> None:
    """Remove tables made by :func:`cut` that nothing reads any more, before the application ends."""
    for df in tables:
        session = df.sparkSession
        for name in df.inputFiles()[:1]:
            folder = session._jvm.org.apache.hadoop.fs.Path(name).getParent()
            if folder.getName().startswith("llm-"):
                folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)


def sweep(spark: SparkSession) -> None:
    """Let the driver drop what nothing refers to any more: Spark removes the shuffle files of ended jobs only then."""
    gc.collect()
    give_back()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Hand freed memory back to the system: Python workers live on after their tasks, next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def tidied(run: Callable) -> Callable:
    """``run`` over the batches of a task, which lets go of ``kept`` first and hands freed memory back after each batch."""
    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b
            del b
            give_back()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.clear()
        yield from run(trimmed(batches))

    return task


def key_filter(keys: DataFrame, column: str, count: int) -> tuple[np.ndarray, int]:
    """A bitmap of the low bits of evenly spread 64-bit ``keys``: no false negatives, size bounded.

    16 to 32 bits a key, at most ``MAX_FILTER_BITS``. It only spares rows a shuffle; what passes by chance
    is settled by the exact join or group behind it.
    """
    return key_filters(keys.select(F.lit(0).alias("of"), column), column, "of", {0: count})[0]


def key_filters(keys: DataFrame, column: str, by: str, counts: dict[int, int]) -> dict[int, tuple[np.ndarray, int]]:
    """A :func:`key_filter` for each value of ``by`` that ``counts`` names, in one job."""
    size = {k: min(MAX_FILTER_BITS, max(18, int(16 * max(n, 1)).bit_length())) for k, n in counts.items()}
    out = {k: (np.zeros(1 << (bits - 3), dtype=np.uint8), bits) for k, bits in size.items()}
    mask = F.create_map(*(F.lit(x) for k, bits in size.items() for x in (k, (1 << bits) - 1)))
    low = F.col(column).bitwiseAND(mask[F.col(by)].cast("long")) + 1
    found = keys.filter(F.col(by).isin(list(counts))).groupBy(by, F.bitmap_bucket_number(low).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(low)).alias("m")).collect()
    for r in found:
        bitmap = out[r[by]][0]
        part = np.frombuffer(r["m"], dtype=np.uint8)
        at = (r["b"] - 1) * 4096
        bitmap[at:at + 4096] = part[:len(bitmap) - at]
    return out


def combined(tables: Iterable[pa.Table], keys: list[str], sums: list[str], held: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Partial sums of ``sums`` by ``keys`` over the tables of a task, of which about ``held`` rows are kept at a time."""
    parts, rows = [], 0

    def merged() -> pa.Table:
        done = pa.concat_tables(parts).group_by(keys).aggregate([(c, "sum") for c in sums])
        return done.rename_columns({f"{c}_sum": c for c in sums}).select([*keys, *sums]).combine_chunks()

    for t in tables:
        parts.append(t)
        rows += len(t)
        if rows > held:
            parts = [merged()]
            rows = len(parts[0])
            if rows > held // 2:
                yield from parts[0].to_batches()
                parts, rows = [], 0
                give_back()
    if parts:
        yield from merged().to_batches()
    give_back()


def in_filter(bitmap: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit ``keys`` may be in the filter."""
    low = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bitmap[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Smallest vertex reachable from each vertex of ``edges`` (longs): columns ``node``, ``out``.

    Rounds of large-star and small-star: each vertex's neighbours are linked to the smallest of
    them, so paths shorten by a constant factor and hot vertices only ever send minima, which are
    combined before the shuffle. A round is a few shuffles of the edges, checkpointed; the driver
    sees two numbers a round.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    now = cut(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        around = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                            F.col("m").alias("v"))
        before, now = now, cut(small.filter("u <> v").distinct())
        release(before, large)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    members = now.select(F.col("u").alias("node"), F.col("v").alias(out))
    return members.union(members.select(F.col(out).alias("node"), F.col(out)).distinct())
