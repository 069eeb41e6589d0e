"""Suffix-array dedup: bytes inside a string of ``length`` bytes that also starts anywhere else are removed.

The difference-cover algorithm sorts the suffixes of a text by sorting the triples at two of three positions,
recursing on the names of the triples, and merging the remaining third. Sorting every suffix of a corpus as one
text would shuffle each byte many times over, so the corpus is first cut into texts that can be sorted apart:

1. Each window (``length`` bytes of one document) names its anchor, the leftmost gram with the smallest hash
   inside it. Equal windows have equal anchors, so suffixes that share ``length`` bytes share an anchor. A run is
   a stretch of consecutive windows with one anchor; runs are gathered as a few numbers each.
2. Runs with equal bytes are one string with a count, and anchors that occur once are done: nothing in them can
   repeat. A string that is alone in its anchor has its count for an answer.
3. The strings of the other anchors are dealt into shards by anchor; each shard is one text whose suffix array the
   difference-cover algorithm makes (:func:`suffix_array`), and neighbours in it that agree in ``length`` bytes
   are repeats. A shard holds about ``SHARD_BYTES``.
4. An anchor with more than ``ANCHOR_BYTES`` of strings is split: its windows are counted one by one, by
   partial aggregates, wherever they are.

Hashes have 64 bits; within one anchor (another 64 bits), equal hashes are taken for equal bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, give_back, in_filter, key_filter, prepare, release
from tallyhawk.llm.text import BYTE, U, buffers, mix, power, signed, slices

LENGTH = 200
#: Bytes of the gram that anchors a window; a short one makes longer runs, a long one is shared by chance less often.
GRAM = 64
#: Bytes of text one suffix array is made of, on average; and of the strings of one anchor that is still sorted in one.
SHARD_BYTES = 1 << 18
ANCHOR_BYTES = 1 << 19
#: A document is worked on in stretches of so many windows, so memory does not follow its length.
STRETCH = 1 << 20
#: Text of the documents worked on together.
SLICE = 1 << 20


def _names(order: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, int]:
    """Names from 0, in the order of ``key``; equal keys have one name. And how many names there are."""
    fresh = np.zeros(len(order), dtype=np.int64)
    k = key[order]
    np.cumsum(k[1:] != k[:-1], out=fresh[1:])
    names = np.empty(len(order), dtype=np.int64)
    names[order] = fresh
    return names, int(fresh[-1]) + 1


def _dense(*columns: np.ndarray) -> np.ndarray:
    """One number a row, in the order of the ``columns`` (integers from 0); it fits 62 bits."""
    key, top = columns[0], int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        size = int(c.max(initial=0)) + 1
        if top * size >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max(initial=0)) + 1
        key, top = key * size + c, top * size
    return key


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``symbols`` (integers from 0) in order, by the difference cover {1, 2} modulo 3."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), dtype=np.int64)
    s = np.zeros(n + 3, dtype=np.int64)  # a symbol below all others ends the text
    s[:n] = symbols
    s[:n] += 1
    # sort sampled triples: positions 1 and 2 modulo 3, and one beyond the end where that keeps the halves apart
    ones = np.arange(1, n + (n % 3 == 1), 3)
    sample = np.concatenate((ones, np.arange(2, n, 3)))
    triple = _dense(s[sample], s[sample + 1], s[sample + 2])
    order = np.argsort(triple)
    names, many = _names(order, triple)
    # recurse on the names, until they differ
    if many < len(sample):
        order = suffix_array(names)
    rank = np.zeros(n + 3, dtype=np.int64)  # of sampled suffixes, from 1; 0 beyond the end
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    if n % 3 == 1:
        order = order[sample[order] < n]
    sampled = sample[order]
    # the remaining suffixes: by their first symbol and the rank of the next suffix
    rest = np.arange(0, n, 3)
    key = s[rest] * (len(sample) + 1) + rank[rest + 1]
    at = np.argsort(key)
    rest, key = rest[at], key[at]
    # merge: against sampled ones at 1 modulo 3 the same key decides, against those at 2 modulo 3 one symbol more
    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    below = np.searchsorted(s[first] * (len(sample) + 1) + rank[first + 1], key)
    both = np.concatenate((second, rest))
    head = _dense(s[both], s[both + 1], rank[both + 2])
    below += np.searchsorted(head[:len(second)], head[len(second):])
    out = np.empty(n, dtype=np.int64)
    where = below + np.arange(len(rest))
    out[where] = rest
    free = np.ones(n, dtype=bool)
    free[where] = False
    out[free] = sampled
    return out


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which of its windows of ``length`` bytes start anywhere else in the texts too."""
    flat = np.frombuffer(b"".join(t + bytes(1) for t in texts) + bytes(length), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    symbols = flat[:ends[-1]].astype(np.int64) + 1
    symbols[ends - 1] = 0  # between texts; no window reaches over it
    order = suffix_array(symbols)
    left = np.repeat(ends, sizes) - 1 - np.arange(ends[-1])  # bytes of the text from here on
    order = order[left[order] >= length]
    # compare adjacent prefixes, eight bytes at a time and only of pairs that agreed so far
    words = np.lib.stride_tricks.sliding_window_view(flat, 8).view(U)[:, 0] if len(flat) >= 8 else np.zeros(0, U)
    same = np.arange(max(0, len(order) - 1))
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])] if length >= 8 else ():
        same = same[words[order[same] + at] == words[order[same + 1] + at]]
    for at in range(length if length < 8 else 0):
        same = same[flat[order[same] + at] == flat[order[same + 1] + at]]
    found = np.zeros(ends[-1], dtype=bool)
    found[order[same]] = True
    found[order[same + 1]] = True
    return [found[e - n:e - n + max(0, n - length)] for e, n in zip(ends.tolist(), sizes.tolist())]


class Runs:
    """Runs of windows that share an anchor, of the documents of one slice.

    ``anchor`` and ``content`` (hashes), ``doc`` (row in the slice), ``start`` (byte in the slice), ``windows``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
        parts = []
        for lo in range(0, max(1, len(data) - length + 1), STRETCH):
            parts.append(self._stretch(data[lo:lo + STRETCH + length - 1], lo, offsets, length, gram))
        self.anchor, self.content, self.doc, self.start, self.windows = (np.concatenate(x) for x in zip(*parts))

    @staticmethod
    def _stretch(data: np.ndarray, lo: int, offsets: np.ndarray, length: int, gram: int):
        n, many, width = len(data), len(data) - length + 1, length - gram + 1
        if many <= 0:
            none = np.zeros(0, np.int64)
            return np.zeros(0, U), np.zeros(0, U), none, none, none
        total = np.zeros(n + 1, U)
        np.cumsum(BYTE[data] * power("up", n), out=total[1:])
        down = power("down", n + 1)
        grams = mix((total[gram:] - total[:-gram]) * down[:n - gram + 1])
        # 40 bits of the hash before the place: the minimum is the smallest hash and of those the leftmost
        low = (grams & ~U((1 << 24) - 1)) | np.arange(len(grams), dtype=U)
        step = 1
        while 2 * step <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        low = np.minimum(low[:many], low[width - step:width - step + many])
        where = (low & U((1 << 24) - 1)).astype(np.int64)
        inside = np.clip(offsets, lo, lo + many)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(inside))
        whole = np.arange(lo + length, lo + length + many) <= offsets[1:][doc]
        fresh = np.ones(many, dtype=bool)
        fresh[1:] = (where[1:] != where[:-1]) | (whole[1:] != whole[:-1]) | (doc[1:] != doc[:-1])
        edges = np.append(np.flatnonzero(fresh), many)
        start, windows = edges[:-1], np.diff(edges)
        start, windows = start[whole[start]], windows[whole[start]]
        end = start + windows + length - 1
        content = mix((total[end] - total[start]) * down[start] + windows.astype(U))
        return grams[where[start]], content, doc[start], start + lo, windows


def _window_names(text: bytes, length: int) -> np.ndarray:
    """A hash of each window of ``text``."""
    data = np.frombuffer(text, np.uint8)
    total = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE[data] * power("up", len(data)), out=total[1:])
    return mix((total[length:] - total[:-length]) * power("down", len(data) - length + 1))


def _ranges(repeated: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], repeated.view(np.int8), [0]))))
    return edge[::2].tolist(), edge[1::2].tolist()


def _scan(docs: DataFrame, made, columns: str, length: int, gram: int, wanted=None) -> DataFrame:
    """``made(key, size, runs, data, offsets)`` over slices of ``docs`` (key, size, text); it returns Arrow columns.

    ``wanted(key)``: which documents are looked at.
    """
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if wanted is not None:
                b = b.filter(pa.array(wanted(b.column("key").to_numpy())))
            key, size = (b.column(c).to_numpy() for c in ("key", "size"))
            for lo, hi, data, offsets in slices(b.column("text"), SLICE):
                runs = Runs(data, offsets, length, gram)
                yield pa.RecordBatch.from_arrays(made(key[lo:hi], size[lo:hi], runs, data, offsets), names)
            give_back()

    return docs.mapInArrow(run, columns)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Spans of repeated windows: key, size, start, stop (bytes, stop exclusive; spans of a text may touch or overlap).

    ``docs`` has key, size and text, each row a document; rows of one (key, size) must have one text. A window is
    repeated where its bytes start at any other place, in the same document or another.
    """
    prepare(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    gram = min(gram, length)
    by = ["anchor", "content", "windows"]

    def numbers(key, size, r: Runs, data, offsets) -> list[pa.Array]:
        return [pa.array(x) for x in (signed(r.anchor), signed(r.content), r.windows.astype(np.int32), key[r.doc],
                                      size[r.doc], (r.start - offsets[r.doc]).astype(np.int32))]

    runs = cut(_scan(docs, numbers, "anchor long, content long, windows int, key long, size int, start int", length, gram))
    shared = cut(runs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    few = sc.broadcast(key_filter(shared, "anchor", shared.count()))
    release(shared)

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_filter(*few.value, b.column("anchor").to_numpy().view(U))))

    strings = cut(runs.select(*by, "key").mapInArrow(maybe, "anchor long, content long, windows int, key long")
                  .groupBy(by).agg(F.count("*").alias("n"), F.min("key").alias("key")))
    several = strings.groupBy("anchor").agg(F.count("*").alias("strings"), F.sum(F.col("windows") + length).alias("bytes")) \
        .filter("strings > 1").select("anchor", "bytes", (F.col("bytes") > ANCHOR_BYTES).alias("hot"))
    strings = cut(strings.join(several, "anchor", "left"))
    # copies of a string repeat as a whole; where it is alone in its anchor there is nothing to compare it with
    copied = strings.filter("n > 1").select(*by, F.lit(0).alias("low"), F.col("windows").alias("high"))

    compared = strings.filter("hot is not null")
    total, anchors, keys = compared.agg(F.sum(F.col("windows") + length), F.count_distinct("anchor"), F.count_distinct("key")).first()
    mixed = sc.broadcast((key_filter(compared, "anchor", anchors), key_filter(compared, "key", keys)))

    def holding(key: np.ndarray) -> np.ndarray:
        """Documents that may hold a string to compare."""
        return in_filter(*mixed.value[1], key.view(U))

    def bytes_of(key, size, r: Runs, data, offsets) -> list[pa.Array]:
        at = np.flatnonzero(in_filter(*mixed.value[0], r.anchor))
        _, once = np.unique(r.content[at], return_index=True)
        at = at[once]
        raw = data.tobytes() if len(at) else b""
        stop = r.start[at] + r.windows[at] + length - 1
        return [pa.array(signed(r.anchor[at])), pa.array(signed(r.content[at])), pa.array(r.windows[at].astype(np.int32)),
                pa.array([raw[a:b] for a, b in zip(r.start[at].tolist(), stop.tolist())], pa.binary())]

    texts = _scan(docs, bytes_of, "anchor long, content long, windows int, text binary", length, gram, holding) \
        .groupBy(by).agg(F.min("text").alias("text"))
    texts = cut(texts.join(compared.drop("key", "bytes"), by))
    shards = max(1, -(-(total or 0) // SHARD_BYTES))

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a, c, w, found in zip(rows["anchor"], rows["content"], rows["windows"], repeated_windows(list(rows["text"]), length)):
            out += [(a, c, w, lo, hi) for lo, hi in zip(*_ranges(found))]
        give_back()
        return pd.DataFrame(out, columns=[*by, "low", "high"])

    spans = "anchor long, content long, windows int, low int, high int"
    sorted_ = texts.filter("not hot").select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), *by, "text") \
        .groupBy("shard").applyInPandas(sort, spans)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column("text").to_pylist()):
                name = _window_names(text, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(name)), pa.array(np.arange(len(name), dtype=np.int32)),
                     *(pa.array(np.repeat(b.column(c)[i].as_py(), len(name)), b.schema.field(c).type) for c in (*by, "n"))],
                    ["name", "low", *by, "n"])

    counted = texts.filter("hot").mapInArrow(windows, "name long, low int, anchor long, content long, windows int, n long")
    twice = counted.groupBy("anchor", "name").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    split = counted.drop("n").join(twice, ["anchor", "name"]).select(*by, "low", (F.col("low") + 1).alias("high"))
    settled = copied.union(sorted_).union(split)
    return runs.join(settled, by).select("key", "size", (F.col("start") + F.col("low")).alias("start"),
                                         (F.col("start") + F.col("high") + length - 1).alias("stop"))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (text and any other columns) with n_bytes, n_removed, n_spans (long) and kept (binary).

    Text is taken as UTF-8 bytes. Every row is a document of its own: rows that repeat an id, a null id included,
    repeat each other's bytes, and of copies all lose them. A null text has no bytes; one shorter than ``length``
    loses none. One row per row of ``docs``; its columns that have one of the new names are replaced, others stay,
    whatever their names. An empty table gives no rows. Ties do not arise: all places of a repeat are removed.
    """
    new = ("n_bytes", "n_removed", "n_spans", "kept")
    docs = docs.drop(*new)
    packed = docs.select(F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("row"),
                         F.xxhash64("text").alias("key"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    of_text = docs.columns.index("text")
    spans = cut(repeated_spans(packed.select("key", "size", F.col("row")["text"].alias("text")), length).groupBy("key", "size").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")))  # a text's own: no more than it has windows
    losing = docs.sparkSession.sparkContext.broadcast(key_filter(spans, "key", spans.count()))

    def finished(b: pa.RecordBatch) -> pa.RecordBatch:
        removed, pieces, kept = [], [], []
        text = pc.struct_field(b.column("row"), [of_text])
        raw, offsets = buffers(text)
        of = b.column("spans") if "spans" in b.schema.names else pa.nulls(len(b))
        for lo, hi, found in zip(offsets[:-1].tolist(), offsets[1:].tolist(), of, strict=True):
            left, n = raw[lo:hi], 0
            if found.is_valid:
                edge = np.zeros(hi - lo + 1, dtype=np.int32)
                np.add.at(edge, found.values.field("start").to_numpy(), 1)
                np.add.at(edge, found.values.field("stop").to_numpy(), -1)
                gone = np.cumsum(edge[:-1]) > 0
                left, n = left[~gone], len(_ranges(gone)[0])
            pieces.append(n)
            removed.append(hi - lo - len(left))
            kept.append(left.tobytes())
        made = [pa.array(removed, pa.int64()), pa.array(pieces, pa.int64()), pa.array(kept, pa.binary())]
        size = b.column("size").cast(pa.int64())
        return pa.RecordBatch.from_arrays([b.column("row"), size, *made], ["row", *new])

    def in_parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, _, _ in slices(pc.struct_field(b.column("row"), [of_text]), 4 * SLICE):
            yield finished(b.slice(lo, hi - lo))

    def parted(wanted: bool):
        """Only documents that may lose bytes are shuffled; the others are finished where they are read."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                there = in_filter(*losing.value, b.column("key").to_numpy().view(U))
                part = b.filter(pa.array(there == wanted))
                yield from [part] if wanted else in_parts(part)
                give_back()
        return run

    whole_type = packed.schema["row"].dataType.simpleString()
    ddl = f"row {whole_type}, n_bytes long, n_removed long, n_spans long, kept binary"
    whole = packed.mapInArrow(parted(False), ddl)
    losers = packed.mapInArrow(parted(True), f"row {whole_type}, key long, size int").join(spans, ["key", "size"], "left")
    return whole.union(losers.mapInArrow(lambda batches: (x for b in batches for x in in_parts(b)), ddl)).select("row.*", *new)
