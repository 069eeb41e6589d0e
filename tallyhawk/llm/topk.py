"""Exact top-k inner products over a bit-sliced index.

Components are quantised to integers floor(scale * x). The index keeps, for each block of rows and each
component, one bitmap over the rows for each bit (two's complement). A query's score is the sum over
components of its integer times theirs: for every set bit of the query's integer and every slice of the
component one bitmap of a known weight. Bitmaps of equal weight are added with carry-save adders, three
into a sum and a carry of twice the weight, until each weight has one bitmap: the score's bit slices.
The top rows are selected from the most significant slice downward; rows tied at the boundary are
resolved by vec_id. All scores are exact integers.

Rows are dealt into blocks of ``BLOCK_ROWS`` at most and queries into parts of about ``QUERY_ROWS``; each
block meets each part, which is the stated query set against all rows. A pair returns k rows a query at
most, and a window over these gives the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, prepare

BLOCK_ROWS = 32_768
QUERY_ROWS = 512


def add_slices(groups: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Bit slices (least significant first) of the sum of bitmaps, given as stacks by the power of two they weigh."""
    out, power = [], 0
    while power <= max(groups, default=-1):
        stack = groups.pop(power, [])
        rows = np.concatenate(stack) if stack else None
        if rows is None:
            out.append(None)
            power += 1
            continue
        while len(rows) > 1:
            n = len(rows) // 3
            if n == 0:  # two left: a half adder
                groups.setdefault(power + 1, []).append((rows[0] & rows[1])[None])
                rows = (rows[0] ^ rows[1])[None]
                break
            a, b, c = rows[:n], rows[n:2 * n], rows[2 * n:3 * n]
            half = a ^ b
            groups.setdefault(power + 1, []).append((a & b) | (half & c))
            rows = np.concatenate((half ^ c, rows[3 * n:]))
        out.append(rows[0])
        power += 1
    return out


class Block:
    """The bit-sliced index of one block of integer vectors."""

    def __init__(self, vectors: np.ndarray):
        self.rows, self.width = vectors.shape
        self.words = -(-self.rows // 64)
        self.offset = int(vectors.min(initial=0))  # slices hold non-negative numbers
        shifted = vectors - self.offset
        self.bits = int(shifted.max(initial=0)).bit_length()
        planes = (shifted[None] >> np.arange(self.bits)[:, None, None]) & 1  # bit, row, component
        packed = np.packbits(planes.astype(np.uint8).transpose(0, 2, 1), axis=2, bitorder="little")
        full = np.zeros((self.bits, self.width, self.words * 8), dtype=np.uint8)
        full[:, :, :packed.shape[2]] = packed
        self.slices = full.view(np.uint64)
        everyone = np.zeros(self.words * 64, dtype=np.uint8)
        everyone[:self.rows] = 1
        self.everyone = np.packbits(everyone, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bit slices of (score - base) for all rows, and the base, for one integer query."""
        groups: dict[int, list[np.ndarray]] = {}
        base = int(query.sum()) * self.offset
        size = np.abs(query)
        negative = query < 0
        most = (1 << self.bits) - 1
        for j in range(int(size.max(initial=0)).bit_length()):
            used = (size >> j) & 1 == 1
            for sign in (False, True):
                at = np.flatnonzero(used & (negative == sign))
                if not len(at):
                    continue
                for b in range(self.bits):
                    rows = self.slices[b, at]
                    groups.setdefault(j + b, []).append(rows ^ self.everyone if sign else rows)
                if sign:  # -x = (most - x) - most
                    base -= len(at) * (most << j)
        return [s if s is not None else np.zeros(self.words, np.uint64) for s in add_slices(groups)], base

    def top(self, query: np.ndarray, ids: np.ndarray, k: int, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores of the k best rows (ties to smaller ids), leaving out the rows of id ``without``."""
        slices, base = self.scores(query)
        maybe = self.everyone.copy()
        if without is not None:
            own = np.flatnonzero(ids == without)
            np.bitwise_and.at(maybe, own >> 6, ~(np.uint64(1) << (own & 63).astype(np.uint64)))
        sure, have = np.zeros_like(maybe), 0
        for s in reversed(slices):
            ones = maybe & s
            n = int(np.bitwise_count(ones).sum())
            if have + n > k:
                maybe = ones
            else:
                sure, maybe, have = sure | ones, maybe & ~s, have + n
        rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        tied = np.flatnonzero(np.unpackbits(maybe.view(np.uint8), bitorder="little"))
        if have < k and len(tied):  # all of one score: the boundary
            tied = tied[np.argsort(ids[tied], kind="stable")[:k - have]]
            rows = np.concatenate((rows, tied))
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        score = sum((((s[word] >> bit) & np.uint64(1)).astype(np.int64) << p for p, s in enumerate(slices)),
                    np.zeros(len(rows), np.int64))
        return rows, score + base


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and v (array of long) of the rows whose vector is complete and finite."""
    x = F.col("embedding")
    fit = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")) \
        .filter(F.col("vec_id").isNotNull() & x.isNotNull() & fit & (F.size(x) > 0)) \
        .select("vec_id", F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))


def _blocks(rows: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Rows packed as they are read, by length of vector and ``BLOCK_ROWS`` at most: width and the two names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(width: int) -> pa.RecordBatch:
            ids, vectors = zip(*held.pop(width), strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([width]), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(vectors, np.int64).tobytes()], pa.binary())], ["width", *names])

        for b in batches:
            for i, v in zip(b.column("vec_id").to_pylist(), b.column("v")):
                v = v.values.to_numpy()
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == BLOCK_ROWS:
                    yield out(len(v))
        for width in list(held):
            yield out(width)

    return rows.mapInArrow(run, f"width long, {names[0]} binary, {names[1]} binary")


def top_k(vectors: DataFrame, every: int, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query row.

    Queries are the rows of ``vectors`` (vec_id, embedding) whose vec_id is divisible by ``every``, candidates
    all rows of another vec_id with as many components. Ties go to the smaller vec_id. Vectors that are null,
    empty or hold a null or non-finite component take no part. Rows that repeat a vec_id are a candidate each;
    of those that are queries the one with the smallest vector asks. Fewer candidates give fewer rows.
    """
    prepare(vectors.sparkSession)
    rows = cut(quantised(vectors, scale))
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_rows, n_queries = rows.count(), queries.count()
    parts = max(1, -(-n_queries // QUERY_ROWS))
    blocks = cut(_blocks(rows.repartition(max(1, -(-n_rows // BLOCK_ROWS)), "vec_id"), ("ids", "vectors"))
                 .withColumn("block", F.xxhash64("ids", "vectors")))
    asked = _blocks(queries.repartition(parts, "vec_id"), ("q_ids", "q_vectors")).withColumn("part", F.xxhash64("q_ids"))
    asked = cut(asked)
    pairs = blocks.select("width", "block").join(asked.select("width", "part"), "width")  # names only
    left = blocks.join(pairs.select("block", "part"), "block")
    right = asked.join(pairs.select("block", "part"), "part").select(
        F.col("block").alias("with_block"), F.col("part").alias("of_part"), "q_ids", "q_vectors")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        for ids, vectors in zip(left["ids"], left["vectors"]):
            ids = np.frombuffer(ids, np.int64)
            block = Block(np.frombuffer(vectors, np.int64).reshape(len(ids), -1))
            for q_ids, q_vectors in zip(right["q_ids"], right["q_vectors"]):
                q_ids = np.frombuffer(q_ids, np.int64)
                for i, v in zip(q_ids.tolist(), np.frombuffer(q_vectors, np.int64).reshape(len(q_ids), -1)):
                    at, score = block.top(v, ids, k, i)
                    out.append(pd.DataFrame({"query_id": i, "vec_id": ids[at], "score": score}))
        return pd.concat(out)

    found = left.groupBy("block", "part").cogroup(right.groupBy("with_block", "of_part")).applyInPandas(
        search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
