"""Language-model scores: a probabilistic suffix tree over words, and its add-one baseline.

Tokens are a text's words, A-Z lower-cased, and one end.

Root: P(w) = (c - D) / N for a token seen c times of N, and D V / N for an unknown word, with the
absolute discount D = n1 / (n1 + 2 n2) from the numbers of words seen once and twice.

Tree: contexts are up to ``DEPTH`` preceding tokens of the whole vocabulary, with one end before a text's first
word. A context is a candidate where it occurs ``MIN_COUNT`` times, however large the corpus. It is retained where
its next-token distribution diverges from that of its longest retained suffix: count times Kullback-Leibler
divergence of at least ``MIN_GAIN`` nats and one for each cell, next tokens seen less than ``MIN_CELL`` times being
one cell. There P(s) = (c - D) / T + left * P'(s), with P' the suffix's distribution and ``left`` what the discounts
and the last cell leave. A token is scored in the longest retained suffix state.

A context and a context with its next token are named by a 64-bit polynomial of their words' hashes, so both are
rows of tables: counted, tested and kept by Spark, level by level, without a limit. The tree that tasks are sent holds
the states and cells of the highest counts (``HEAD_STATES``, ``HEAD_CELLS`` at most) and two bitmaps of all;
a chunk of texts asks the tables for the different names that these do not settle, and for its words beyond the ``HEAD``
most frequent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import MAX_FILTER_BITS, cut, give_back, in_filter, prepare, release, sweep
from tallyhawk.llm.text import SMALL_SLICE, SPACE, U, Words, signed, slices

DEPTH = 3
#: Words that have a symbol in the tree that is sent.
ALPHABET = 1 << 17
MIN_COUNT = 10
MIN_CELL = 2
MIN_GAIN = 20.0
HEAD = 1 << 17
HEAD_STATES = 1 << 16
HEAD_CELLS = 1 << 19
#: The hash of the end.
END = U(0xA5B35705F39D2C17)
_STEP = 0x9E6C63D0876A9F4B
_BACK = U(pow(_STEP, -1, 1 << 64))
#: Names that a task holds at a time.
HELD = 1 << 21
#: A round's shuffle files are removed before the next.
ROUNDS = 2
#: Tokens and bytes of text scored together, at most (a longer document is alone).
CHUNK = 3 << 19
CHUNK_BYTES = 1 << 25


@dataclass
class Tree:
    """The head of the model; state 0 is the root.

    ``words`` are the hashes of the most frequent words, sorted, with ``counts`` and ``symbol`` (of those in the
    alphabet, else ``rare``). State i + 1 is the context named ``keys[i]``, sorted. ``told`` has all states and
    cells, as :func:`_told` makes it, ``state_hint`` and ``cell_hint`` are their bitmaps. ``entry`` has the head's cells by
    state and symbol, ``grams`` by name; tasks are sent the latter.
    """

    words: np.ndarray
    counts: np.ndarray
    symbol: np.ndarray
    tokens: int
    distinct: int
    documents: int
    discount: float
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    suffix: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # of each state
    left: np.ndarray = field(default_factory=lambda: np.zeros(1))  # its log10
    entry: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # sorted codes (state, symbol)
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))  # their log10 probability
    root: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log10 by symbol
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, U))  # sorted names
    chance: np.ndarray = field(default_factory=lambda: np.zeros(0))  # their log10 probability
    state_hint: tuple[np.ndarray, int] | None = None
    cell_hint: tuple[np.ndarray, int] | None = None
    told: DataFrame | None = None

    def __getstate__(self):
        return self.__dict__ | {"told": None, "entry": None, "value": None}

    @property
    def rare(self) -> int:
        return len(self.root) - 2

    @property
    def end(self) -> int:
        return len(self.root) - 1

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in ``words``, and whether the word is there."""
        return _find(self.words, hashes)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        at, there = self.find(hashes)
        out = np.full(len(hashes), self.rare)
        out[there] = self.symbol[at[there]]
        out[hashes == END] = self.end
        return out


def names(text: np.ndarray, place: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: the names of the ``depth`` tokens before it and of these with it, and whether there are as many.

    ``place`` counts from each text's first token; one end stands before that.
    """
    before = np.concatenate((np.full(depth, END), text))
    context = np.zeros(len(text), dtype=U)
    for j in range(depth):
        context = context * U(_STEP) + before[j:j + len(text)]
    return context, context * U(_STEP) + text, place >= depth - 1


def sequence(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts of a slice, each text closed by the end; their place and text."""
    first = words.first + np.arange(words.rows + 1)
    text = np.full(first[-1], END, dtype=U)
    text[np.arange(len(words.hash)) + words.doc] = words.hash
    doc = np.repeat(np.arange(words.rows), np.diff(first))
    return text, np.arange(first[-1]) - first[doc], doc


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of 64-bit ``keys``, and the keys in it; several times faster than ``argsort``: values are sorted, not places."""
    n = len(keys)
    bits = U(max(1, n - 1).bit_length())
    low = (U(1) << bits) - U(1)
    packed = (keys & ~low) | np.arange(n, dtype=U)
    packed.sort()
    order = (packed & low).astype(np.int64)
    keys = keys[order]
    wrong = keys[1:][keys[1:] < keys[:-1]] >> bits
    if len(wrong):  # keys that differ in their low bits only
        high = keys >> bits
        for x in np.unique(wrong):
            a, b = np.searchsorted(high, x), np.searchsorted(high, x, "right")
            at = np.argsort(keys[a:b])
            order[a:b], keys[a:b] = order[a:b][at], keys[a:b][at]
    return order, keys


def starts(keys: np.ndarray) -> np.ndarray:
    """Where each value of the sorted ``keys`` begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1])))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and the place of each key among them."""
    order, keys = ordered(keys)
    first = starts(keys)
    at = np.empty(len(keys), dtype=np.int32)
    at[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(keys)))
    return keys[first], at


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their steps, byte by byte: Spark's compression takes the empty high bytes away."""
    return planes(np.diff(keys, prepend=U(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(numbers(data), dtype=U)


def planes(x: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes()


def numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(U).ravel()


def ranges(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the sorted keys: names are evenly spread, so buckets are equal stretches of all 64-bit numbers."""
    at = np.searchsorted(keys, np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=U))
    at = np.concatenate(([0], at, [len(keys)]))
    for b in np.flatnonzero(at[1:] > at[:-1]):
        yield int(b), int(at[b]), int(at[b + 1])


def _parts(spark: SparkSession, rows: int) -> int:
    """Tasks for about ``rows`` names: as many as the session asks for, or what keeps them in a worker's memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // HELD))


def _counts(texts: DataFrame, parts: int) -> DataFrame:
    """word, n: how often each word occurs in all texts; tasks send sorted arrays, one for each bucket of words."""
    def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order, key = ordered(key)
        first = starts(key)
        return key[first], np.add.reduceat(n[order], first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            key, n = summed(*(np.concatenate(c) for c in zip(*held)))
            rows = [(b, packed_keys(key[lo:hi]), planes(n[lo:hi])) for b, lo, hi in ranges(key, 4 * parts)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["bucket", "key", "n"])

        for b in batches:
            for _, _, data, offsets in slices(b.column("text"), SMALL_SLICE):
                found = Words(data, offsets, lower=True).hash
                found.sort()
                first = starts(found)
                held.append((found[first], np.diff(first, append=len(found))))
                size += len(first)
                if size > HELD:
                    held = [summed(*(np.concatenate(c) for c in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield out()
                        held, size = [], 0
        if size:
            yield out()
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n in _buckets(batches):
            key, n = summed(np.concatenate([*map(unpacked_keys, key)]), np.concatenate([*map(numbers, n)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(n)], ["word", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, key binary, n binary").repartition(parts, "bucket").mapInArrow(merge, "word long, n long")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The columns of each bucket that a task was sent."""
    sent: dict[int, list] = {}
    for b in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in b.columns)):
            sent.setdefault(bucket, []).append(row)
    while sent:
        yield tuple(zip(*sent.popitem()[1]))
    give_back()


def _grams(texts: DataFrame, depth: int, parts: int, contexts: tuple[np.ndarray, int], lesses: tuple[np.ndarray, int]) -> DataFrame:
    """key, less (without the oldest token), older, n of the (depth + 1)-grams seen ``MIN_CELL`` times whose context may be in
    ``contexts`` and which shortened may be in ``lesses``. ``older`` is what the context has more than that of the shortened.

    Most grams occur once. So tasks send theirs as sorted arrays, one for each bucket of names; only what the merged
    buckets keep become rows.
    """
    held, buckets = texts.sparkSession.sparkContext.broadcast((contexts, lesses)), 4 * parts
    oldest = U(pow(_STEP, depth, 1 << 64))

    def summed(key: np.ndarray, less: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order, key = ordered(key)
        first = starts(key)
        n = np.diff(first, append=len(key)) if n is None else np.add.reduceat(n[order], first)
        return key[first], less[order[first]], n

    def send(found: list[tuple]) -> pa.RecordBatch:
        key, less, n = summed(*(np.concatenate(c) for c in zip(*found)), None)
        rows = [(b, packed_keys(key[lo:hi]), less[lo:hi].tobytes(), planes(n[lo:hi])) for b, lo, hi in ranges(key, buckets)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 3)], ["bucket", "key", "less", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for b in batches:
            for _, _, data, offsets in slices(b.column("text"), SMALL_SLICE):
                text, place, _ = sequence(Words(data, offsets, lower=True))
                context, gram, valid = names(text, place, depth)
                at = np.flatnonzero(valid & in_filter(*held.value[0], context))
                gram = gram[at]
                less = gram - np.where(at >= depth, text[at - depth], END) * oldest
                may = in_filter(*held.value[1], less)
                found.append((gram[may], less[may]))
                size += len(found[-1][0])
                if size > HELD:
                    yield send(found)
                    found, size = [], 0
        if size:
            yield send(found)
        del found
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, less, n in _buckets(batches):
            key, less, n = summed(np.concatenate([*map(unpacked_keys, key)]), np.frombuffer(b"".join(less), U),
                                  np.concatenate([*map(numbers, n)]).view(np.int64))
            at = np.flatnonzero(n >= MIN_CELL)
            key, less = key[at], less[at]
            yield pa.RecordBatch.from_arrays([*(pa.array(signed(c)) for c in (key, less, (key - less) * _BACK)), pa.array(n[at])], ["key", "less", "older", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, key binary, less binary, n binary").repartition(parts, "bucket").mapInArrow(
        merge, "key long, less long, older long, n long")


def _filter(table: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """What :func:`common.key_filter` makes of the one column, of keys or of arrays of them; tasks send the sorted bits that they
    set, not bitmaps."""
    bits = min(MAX_FILTER_BITS, max(18, int(16 * max(count, 1)).bit_length()))
    part, parts = bits - 6, min(64, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            low = np.concatenate(held) & U((1 << bits) - 1)
            low.sort()
            low = low[starts(low)]
            at = np.searchsorted(low, np.arange(65, dtype=U) << U(part))
            rows = [(k, packed_keys(low[at[k]:at[k + 1]])) for k in range(64) if at[k + 1] > at[k]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary()))], ["part", "low"])

        for b in batches:
            keys = b.column(0)
            held += [keys.to_numpy().view(U)] if pa.types.is_int64(keys.type) else map(unpacked_keys, keys.to_pylist())
            size = sum(map(len, held))
            if size > HELD:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for b in batches:
            for k, low in zip(*(c.to_pylist() for c in b.columns)):
                on = np.zeros(1 << part, dtype=bool)
                on[unpacked_keys(low).astype(np.int64) - (k << part)] = True
                on = np.packbits(on, bitorder="little")
                made[k] = made[k] | on if k in made else on
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), pa.array([x.tobytes() for x in made.values()], pa.binary())], ["part", "bits"])

    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for r in table.mapInArrow(run, "part int, low binary").repartition(parts, "part").mapInArrow(merge, "part int, bits binary").collect():
        out[r["part"] << (part - 3):(r["part"] + 1) << (part - 3)] = np.frombuffer(r["bits"], np.uint8)
    return out, bits


def _plus(a: Column, b: Column) -> Column:
    """a + b of 64 bits, where a sum may be too large for a long."""
    low = F.lit(0xFFFFFFFF)
    right = a.bitwiseAND(low) + b.bitwiseAND(low)
    left = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32) + F.shiftrightunsigned(right, 32)
    return F.shiftleft(left, 32).bitwiseOR(right.bitwiseAND(low))


def _head(table: DataFrame, column: str, limit: int) -> DataFrame:
    """The rows of the highest ``column``, all of a value's neighbourhood or none, ``limit`` at most."""
    level = F.floor(F.log2(column) * 8)
    least, rows = None, 0
    for r in table.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        rows += r["count"]
        if rows > limit:
            break
        least = r["level"]
    return table.filter(level >= least) if least is not None else table.filter("false")


def fit(train: DataFrame) -> tuple[Tree, DataFrame]:
    """The model of ``train`` (text), and the table of all its words (word, n). A null text is empty."""
    spark = train.sparkSession
    prepare(spark)
    documents, size = train.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    table = cut(_counts(train, _parts(spark, (size or 0) // 8 + documents)))
    sums = table.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    once, twice = (sums[2], sums[3]) if sums[2] else (1, 0.5)
    head = table.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    order = np.argsort(head["word"].to_numpy().view(U))
    size = min(head.num_rows, ALPHABET)
    tree = Tree(head["word"].to_numpy().view(U)[order], head["n"].to_numpy()[order], np.minimum(order, size),
                (sums[0] or 0) + documents, sums[1] + (documents > 0), documents, min(0.95, once / (once + 2 * twice)))
    if not documents:
        tree.root = np.zeros(2)
        return tree, table
    counts = np.concatenate((head["n"].to_numpy()[:size].astype(np.float64), [0.0, documents]))
    probability = (counts - tree.discount) / tree.tokens
    probability[size] = 0
    probability[size] = 1 - probability.sum()  # all rarer words and the unknown symbol
    tree.root = np.log10(probability)

    # level d: the (d + 1)-grams of the candidate contexts of depth d, with their probability in the longest retained state
    d_, t, n = F.lit(tree.discount), F.col("total"), F.col("n")
    end = spark.range(1).select(F.lit(int(END.view(np.int64))).alias("word"), F.lit(documents).cast("long").alias("n"))
    level = table.select("word", "n").union(end).select(
        F.col("word").alias("key"), F.lit(0).cast("long").alias("ctx"), F.col("word").alias("less"), "n",
        ((n - d_) / tree.tokens).alias("p"))
    states, cells, levels, parts = [], [], [], _parts(spark, tree.tokens)
    for d in range(1, DEPTH + 1):
        candidates = level.filter(n >= MIN_COUNT)
        found = candidates.count()
        if not found:
            break
        parents = candidates.select(F.col("key").alias("ctx"), n.alias("total"), F.col("ctx").alias("ctx_ctx"), F.col("less").alias("ctx_less"))
        longer = level.filter(n >= MIN_CELL)
        joined = cut(_grams(train, d, parts, _filter(candidates.select("key"), found), _filter(longer.select("key"), longer.count())).join(
            longer.select(F.col("key").alias("less"), F.col("ctx").alias("less_ctx"), F.col("p").alias("old")), "less").select(
            "key", _plus(F.col("older"), F.col("less_ctx")).alias("ctx"), "less", "n", "old"))
        sweep(spark)
        sums = joined.groupBy("ctx").agg(F.count("*").alias("size"), F.sum("n").alias("n"), F.sum("old").alias("old"),
                                         F.sum(n * F.log(n / F.col("old"))).alias("gain")).join(parents, "ctx")
        rest = t - n
        gain = F.col("gain") - n * F.log(t) + F.when(rest > 0, rest * F.log(rest / t / F.greatest(F.lit(1e-12), 1 - F.col("old")))).otherwise(0.0)
        kept = cut(sums.filter(gain >= MIN_GAIN + F.col("size") + 1).select(
            F.col("ctx").alias("key"), "total", "ctx_ctx", "ctx_less", F.greatest(F.lit(1e-300), 1 - (n - d_ * F.col("size")) / t).alias("left"),
            F.lit(d).alias("depth")))
        level = cut(joined.join(kept.select(F.col("key").alias("ctx"), "total", "left"), "ctx", "left").select(
            "key", "ctx", F.when(n >= MIN_COUNT, F.col("less")).alias("less"), "n",  # of candidates
            F.coalesce((n - d_) / t + F.col("left") * F.col("old"), "old").alias("p"), F.col("left").isNotNull().alias("kept")))
        release(joined)
        sweep(spark)
        states.append(kept)
        levels.append(level)
        cells.append(level.filter("kept").select("key", "ctx", "n", "p"))
    if not states:
        return tree, table
    all_states, all_cells = reduce(DataFrame.union, states), reduce(DataFrame.union, cells)
    top = _head(all_states, "total", HEAD_STATES).toArrow()
    keys, context, less = (top[c].to_numpy().view(U) for c in ("key", "ctx_ctx", "ctx_less"))
    order = np.argsort(keys)
    tree.keys = keys[order]
    tree.left = np.concatenate(([0.0], np.log10(top["left"].to_numpy()[order])))
    depth = top["depth"].to_numpy()[order]
    tree.suffix = np.zeros(len(keys) + 1, dtype=np.int64)
    for wanted in (keys[order] - context[order] * U(_STEP), less[order]):  # the last token, then all but the oldest
        at, there = _find(tree.keys, wanted)
        there &= depth > 1
        tree.suffix[1:][there] = at[there] + 1
    top = _head(all_cells, "n", HEAD_CELLS).select("key", "ctx", "p").toArrow()
    key, context = (top[c].to_numpy().view(U) for c in ("key", "ctx"))
    at, there = _find(tree.keys, context)
    symbol = tree.symbols(key - context * U(_STEP))
    there &= symbol != tree.rare
    code, value = ((at + 1) * len(tree.root) + symbol)[there], np.log10(top["p"].to_numpy()[there])
    order = np.argsort(code)
    tree.entry, tree.value = code[order], value[order]
    order = np.argsort(key)
    tree.grams, tree.chance = key[order], np.log10(top["p"].to_numpy()[order])
    del top, key, context, at, there, symbol, code, value, order, keys, less, depth
    tree.told = cut(_told(all_states.select(F.lit(1).alias("kind"), "key", F.col("left").alias("value")).union(
        all_cells.select(F.lit(2), "key", "p")), 2 * parts))
    tree.state_hint, tree.cell_hint = (_filter(tree.told.filter(F.col("kind") == k).select("keys"), rows.count())
                                       for k, rows in ((1, all_states), (2, all_cells)))
    release(*states, *levels)
    sweep(spark)
    return tree, table


def tokens_of(blob: bytes) -> tuple[pa.ChunkedArray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Ids of the documents of a chunk; their tokens, with each one's place (up to ``DEPTH``) and document; the documents' number."""
    rows = pa.ipc.open_stream(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd")).read_all()
    made, count = [], 0
    for c in rows["text"].chunks:
        for _, _, data, offsets in slices(c, SMALL_SLICE):
            text, place, doc = sequence(w := Words(data, offsets, lower=True))
            made.append((text, np.minimum(place, DEPTH).astype(np.int8), (doc + count).astype(np.int32)))
            count += w.rows
    return rows["doc_id"], *(np.concatenate(x) for x in zip(*made)), count


def asked_names(tree: Tree, blob: bytes) -> list[np.ndarray]:
    """The sorted names of words, of states and of cells that a chunk may have and the head of the model does not settle."""
    _, text, place, _, _ = tokens_of(blob)

    def rest(found: list[np.ndarray], head: np.ndarray) -> np.ndarray:
        found = np.concatenate(found)
        found.sort()
        found = found[starts(found)]
        return found[~_find(head, found)[1]]

    words = np.sort(text)
    words = words[starts(words)]
    asks = [rest([words[words != END]], tree.words), *[np.zeros(0, U)] * 2]
    if tree.state_hint is not None:
        state, cell = [words[in_filter(*tree.state_hint, words)]], []
        for d in range(1, DEPTH + 1):
            context, gram, valid = names(text, place, d)
            may = valid & in_filter(*tree.state_hint, context)
            if d > 1:
                state.append(context[may])
            gram = gram[may]
            cell.append(gram[in_filter(*tree.cell_hint, gram)])
        asks[1:] = rest(state, tree.keys), rest(cell, tree.grams)
    return asks


class Chunk:
    """Texts that are scored together: their tokens, and the places of these among the names that are asked for."""

    def __init__(self, tree: Tree, blob: bytes):
        self.tree = tree
        self.ids, text, place, self.doc, self.count = tokens_of(blob)
        self.words, self.word = distinct(text)
        at, there = tree.find(self.words)
        self.end = self.words == END
        self.known = np.where(there & ~self.end, tree.counts[at] if len(tree.counts) else 0.0, np.nan)  # by word, how often it occurs
        self.rare = np.flatnonzero(~there & ~self.end)
        self.levels = []
        if tree.state_hint is None:
            return
        # positions that may have a state, of these the ones that may have a cell, and the names of both
        may = in_filter(*tree.state_hint, self.words)
        before = np.concatenate(([np.flatnonzero(self.end)[0]], self.word[:-1])).astype(np.int32)
        levels, state, cell = [], [self.words[may]], []
        for d in range(1, DEPTH + 1):
            context, gram, valid = names(text, place, d)
            at = np.flatnonzero(may[before] if d == 1 else valid & in_filter(*tree.state_hint, context)).astype(np.int32)
            if d > 1:
                state.append(context[at])
            gram = gram[at]
            maybe = in_filter(*tree.cell_hint, gram)
            cell.append(gram[maybe])
            levels.append((at, at[maybe]))
        del text, place, context, gram, valid, maybe
        self.left, at = self.looked_up(state, tree.keys, tree.left[1:])
        one = (np.cumsum(may) - 1)[before[levels[0][0]]]
        state = [at[0][one], *at[1:]]
        del before, one
        self.chance, cell = self.looked_up(cell, tree.grams, tree.chance)
        self.levels = [(at, s, cells, c) for (at, cells), s, c in zip(levels, state, cell)]

    def looked_up(self, found: list[np.ndarray], head: np.ndarray, worth: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], list[np.ndarray]]:
        """What the head tells of the different names, and which it does not know; the place among them of each of ``found``."""
        sizes = np.cumsum([len(x) for x in found])[:-1]
        names_, at = distinct(np.concatenate(found))
        found.clear()
        place, there = _find(head, names_)
        told = np.full(len(names_), np.nan)
        told[there] = worth[place[there]]
        return (told, np.flatnonzero(~there)), np.split(at, sizes)

    def scored(self, answers: list[np.ndarray]) -> pa.Table:
        """With what the tables tell of :func:`asked_names`, nan where they have none."""
        t = self.tree
        self.known[self.rare] = answers[0]
        divisor, tokens = float(t.tokens + t.distinct + 1), float(max(1, t.tokens))
        seen = np.nan_to_num(self.known)
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.where(np.isnan(self.known), math.log10(t.discount * t.distinct / tokens) if t.documents else 0.0,
                            np.log10(np.maximum(1e-300, (seen - t.discount) / tokens)))
        base = np.log10((seen + 1) / divisor)
        known = ~np.isnan(self.known)
        root[self.end], base[self.end], known[self.end] = t.root[t.end], math.log10((t.documents + 1) / divisor), t.documents > 0
        value = root[self.word]
        if self.levels:
            for (told, rest), answer in ((self.left, answers[1]), (self.chance, answers[2])):
                told[rest] = answer
        for at, state, cells, cell in self.levels:
            left, chance = self.left[0][state], self.chance[0][cell]
            value[at] += np.nan_to_num(left)
            is_cell = ~np.isnan(chance)
            value[cells[is_cell]] = chance[is_cell]

        first = np.searchsorted(self.doc, np.arange(self.count, dtype=np.int32))  # each has its end
        return pa.table({"doc_id": self.ids, "n_tokens": np.diff(first, append=len(self.doc)), "n_known": np.add.reduceat(known[self.word].astype(np.int64), first),
                         "train_tokens": np.full(self.count, t.tokens), "base_score": np.add.reduceat(base[self.word], first),
                         "score": np.add.reduceat(value, first)})


def _chunks(docs: DataFrame) -> DataFrame:
    """chunk, blob: the documents in chunks of about ``CHUNK`` tokens, each compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, tokens, chunk = [], 0, 0, TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as to:
                for part in held:
                    to.write_batch(part)
            data = sink.getvalue()
            blob = data.size.to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([blob], pa.binary())], ["chunk", "blob"])

        for b in batches:
            for lo, hi, data, _ in slices(b.column("text"), SMALL_SLICE):
                n = int(np.count_nonzero(SPACE[data])) + 2 * (hi - lo)
                if held and (size + len(data) > CHUNK_BYTES or tokens + n > CHUNK):
                    yield out()
                    held, size, tokens, chunk = [], 0, 0, chunk + 1
                held.append(b.slice(lo, hi - lo))
                size, tokens = size + len(data), tokens + n
        if held:
            yield out()
        held.clear()
        give_back()

    return docs.mapInArrow(run, "chunk long, blob binary")


def _told(rows: DataFrame, buckets: int) -> DataFrame:
    """bucket, kind, keys, told: sorted arrays of the values of ``rows`` (kind, key, value), of states and cells their log10.

    Kind 0 are words, 1 states and 2 cells.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            kind, key, value = (np.concatenate(c) for c in zip(*held))
            made = []
            for k in np.flatnonzero(np.bincount(kind)):
                order, keys = ordered(key[kind == k].view(U))
                told = value[kind == k][order]
                told = np.log10(told) if k else told
                made += [(b, int(k), packed_keys(keys[lo:hi]), told[lo:hi].tobytes()) for b, lo, hi in ranges(keys, buckets)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                              ["bucket", "kind", "keys", "told"])

        for b in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            size += len(b)
            if size > HELD:
                yield out()
                held, size = [], 0
        if size:
            yield out()
        give_back()

    return rows.mapInArrow(run, "bucket int, kind int, keys binary, told binary")


def score(docs: DataFrame, tree: Tree, table: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text).

    ``base_score`` adds up log10((c + 1) / (N + V + 1)) over the tokens, ``score`` the tree's log10 probability.
    A null text is empty: the end alone. Without training texts both are 0. Rows that repeat are scored each;
    other columns play no part.

    Documents are scored in ``ROUNDS``, and in chunks. The different names of a chunk that the head does not settle, and not its tokens, go to
    the buckets of the tables; the answers come back to the chunk.
    """
    spark = docs.sparkSession
    prepare(spark)
    held = spark.sparkContext.broadcast(tree)
    parts = _parts(spark, tree.tokens)  # as in fit
    buckets, kinds = 2 * parts, ("words", "states", "cells")

    def ask(rows: pa.Table) -> pa.Table:
        made = []
        for chunk, blob in zip(rows["chunk"].to_pylist(), rows["blob"].to_pylist()):
            found: dict[int, list] = {}
            for k, keys in enumerate(asked_names(held.value, blob)):
                for b, lo, hi in ranges(keys, buckets):
                    found.setdefault(b, [b, chunk, b"", b"", b""])[2 + k] = packed_keys(keys[lo:hi])
            made += found.values()
        give_back()
        return pa.table([pa.array(c, k) for c, k in zip(zip(*made) if made else [[]] * 5, [pa.int32(), pa.int64()] + [pa.binary()] * 3)],
                        names=["bucket", "chunk", *kinds])

    def tell(asked: pa.Table, told: pa.Table) -> pa.Table:
        known = []
        for k in range(3):
            here = [(a, b) for kind, a, b in zip(*(told[c].to_pylist() for c in ("kind", "keys", "told"))) if kind == k]
            order, keys = ordered(np.concatenate([unpacked_keys(a) for a, _ in here] or [np.zeros(0, U)]))
            known.append((keys, np.frombuffer(b"".join(b for _, b in here), np.float64)[order]))
        made = []
        for bucket, chunk, *names_ in zip(*(c.to_pylist() for c in asked.columns)):
            row = [chunk, bucket]
            for blob, (keys, value) in zip(names_, known):
                at, there = _find(keys, unpacked_keys(blob))
                answer = np.full(len(at), np.nan)
                answer[there] = value[at[there]]
                row.append(answer.tobytes())
            made.append(row)
        give_back()
        return pa.table([pa.array(c, k) for c, k in zip(zip(*made) if made else [[]] * 5, [pa.int64(), pa.int32()] + [pa.binary()] * 3)],
                        names=["chunk", "bucket", *kinds])

    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("bucket")
        (blob,) = rows["blob"].to_pylist()
        out = Chunk(held.value, blob).scored([np.frombuffer(b"".join(answers[k].to_pylist()), np.float64) for k in kinds])
        give_back()
        return out

    def scored(docs: DataFrame) -> DataFrame:
        binary = ", ".join(f"{k} binary" for k in kinds)
        chunks = _chunks(docs).repartition(parts, "chunk")  # once: both readers have this exchange
        asked = chunks.groupBy("chunk").applyInArrow(ask, f"bucket int, chunk long, {binary}").repartition(parts, "bucket")
        answers = asked.groupBy("bucket").cogroup(told.repartition(parts, "bucket").groupBy("bucket")).applyInArrow(tell, f"chunk long, bucket int, {binary}").repartition(parts, "chunk")
        return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")

    least = int(tree.counts.min()) if len(tree.counts) else 0
    rare = cut(_told(table.filter(F.col("n") <= least).select(F.lit(0).alias("kind"), F.col("word").alias("key"), F.col("n").cast("double").alias("value")), buckets))
    told = rare if tree.told is None else rare.union(tree.told)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made, rounds = [], ROUNDS if tree.tokens > HELD else 1
    for k in range(rounds):  # which a row is in, only the row decides
        made.append(cut(scored(docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == k))))
        sweep(spark)
    release(rare)
    return reduce(DataFrame.union, made)
