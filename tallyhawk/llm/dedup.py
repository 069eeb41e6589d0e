"""Exact dedup by progressive refinement.

Texts are equal when identical after lower-casing A-Z. Pass 1 reads every text once and keeps its
length and a hash of its first bytes; a length, then a (length, prefix) group of one is unique and
leaves. Pass 2 reads the full content of the surviving groups only and hashes it with SHA-256;
equal (length, digest) is equality. Only three numbers a row are shuffled, pre-aggregated, so a
group of copies of any size is a row per task. The survivors' test in pass 2 is a bitmap of bounded
size; what passes it by chance is hashed in vain, nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, in_filter, key_filter, prepare, tidied
from tallyhawk.llm.text import mix, signed

PREFIX_BYTES = 64


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return pc.cast(pc.fill_null(batch.column("text"), ""), pa.binary()).to_pylist()


def _keys(texts: list[bytes]) -> np.ndarray:
    """One evenly spread 64-bit key for (length, hash of the normalised prefix)."""
    prefix = b"".join(hashlib.blake2b(t[:PREFIX_BYTES].lower(), digest_size=8).digest() for t in texts)
    length = np.fromiter(map(len, texts), np.uint64, len(texts))
    return mix(mix(length) ^ np.frombuffer(prefix, np.uint64)) if texts else np.zeros(0, np.uint64)


def exact_dedup(docs: DataFrame, digests: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, text_key.

    Of equal texts the row with the largest doc_id is kept. ``text_sha256`` is set where the full
    content was read: for the surviving groups, or for all rows with ``digests``; ``text_key`` is a hash
    of the text as it is, which with doc_id names the row. A null text counts as empty; a null doc_id is
    smaller than any other, so it is kept only where a group has no other; rows that repeat both doc_id
    and text count in ``group_size`` and share the verdict, as do rows without doc_id; texts of any length
    are read whole; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b)
            yield pa.RecordBatch.from_arrays([pa.array(map(len, texts), pa.int64()), pa.array(signed(_keys(texts)))],
                                             ["n", "k"])

    first = docs.select("text").mapInArrow(tidied(narrow), "n long, k long")
    prefixes = first.groupBy("n", "k").agg(F.count("*").alias("c"))
    lengths = prefixes.groupBy("n").agg(F.sum("c").alias("same")).filter("same > 1")
    survivors = cut(prefixes.filter("c > 1").join(lengths, "n", "left_semi").select("k"))
    bitmap, bits = key_filter(survivors, "k", survivors.count())
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b)
            in_group = in_filter(held.value, bits, _keys(texts))
            sha = [hashlib.sha256(t.lower()).hexdigest() if digests or g else None
                   for t, g in zip(texts, in_group, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(map(len, texts), pa.int64()),
                                              pa.array(sha, pa.string()), pa.array(in_group)],
                                             ["doc_id", "text_key", "n", "sha", "in_group"])

    rows = docs.mapInArrow(tidied(full), "doc_id long, text_key long, n long, sha string, in_group boolean")
    # written, so that both sides of the join below are plain exchanges and a hot group's rows can be split
    groups = cut(rows.filter("in_group").groupBy("n", F.unhex("sha").alias("sha_bytes")).agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"))
    joined = rows.withColumn("sha_bytes", F.when(F.col("in_group"), F.unhex("sha"))).join(
        groups, ["n", "sha_bytes"], "left")
    keep = F.coalesce("keep_id", "doc_id")
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.col("sha").alias("text_sha256"), "text_key")
