"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows uniformly into memory-sized buckets by a seeded hash; pass 2 permutes each
bucket with a seeded Fisher-Yates shuffle. The buckets, in order, are one random permutation of the
table; cut into ``shards`` runs whose lengths differ by one at most, it gives each row its shard and
slot. Every number depends on the seed and the rows alone, so a lost task is recomputed to the same
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import prepare

BUCKET_BYTES = 16 << 20
_NAMES = {"_bucket": "long", "_size": "long", "_crc": "long", "_from": "long", "_rows": "long"}


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A seeded uniform permutation of range(n): swap each place with one drawn from those left."""
    order = np.arange(n)
    draws = np.random.default_rng([seed, bucket]).integers(np.arange(n, 0, -1))
    for i, d in enumerate(draws.tolist()):
        order[i], order[i + d] = order[i + d], order[i]
    return order


def two_pass_shuffle(docs: DataFrame, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with size, text_crc32, shard and slot.

    ``size`` is the UTF-8 length of the text plus 16 and ``text_crc32`` its CRC-32; a null text counts as
    empty but stays null. Shards hold row counts at most one apart; slots run from 0 without gaps. With
    fewer rows than shards the last shards are empty. A column of the input that has one of the four
    new names is replaced. Rows equal in doc_id and text meet in one bucket, in any order.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("size", "text_crc32", "shard", "slot", *_NAMES)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = docs.withColumns({"_size": (F.octet_length(text) + 16).cast("long"), "_crc": F.crc32(text)})
    total = docs.agg(F.sum("_size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    docs = docs.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_crc", "_size"), F.lit(buckets)))
    counts = docs.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"),
                           F.sum("_n").over(Window.partitionBy()).alias("_rows"))
    dealt = docs.join(counts, "_bucket")
    keep = [c for c in docs.columns if c not in _NAMES]
    fields = ", ".join(f"`{c.replace('`', '``')}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def permute(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.compute.sort_indices(rows, [("doc_id", "ascending"), ("_crc", "ascending"), ("_size", "ascending")]))
        rows = rows.take(pa.array(fisher_yates(len(rows), seed, rows["_bucket"][0].as_py())))
        place = rows["_from"][0].as_py() + np.arange(len(rows))
        least, longer = divmod(rows["_rows"][0].as_py(), shards)
        edge = longer * (least + 1)
        late = place >= edge
        shard = np.where(late, longer + (place - edge) // max(least, 1), place // (least + 1))
        slot = np.where(late, (place - edge) % max(least, 1), place % (least + 1))
        made = {"size": rows["_size"], "text_crc32": rows["_crc"], "shard": pa.array(shard.astype(np.int32)),
                "slot": pa.array(slot)}
        out = rows.select(keep)
        for name, values in made.items():
            out = out.append_column(name, values)
        return out

    return dealt.groupBy("_bucket").applyInArrow(permute, f"{fields}, size long, text_crc32 long, shard int, slot long")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write the shards as Parquet folders shard=0, 1, ...; each file's rows are in slot order."""
    shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
