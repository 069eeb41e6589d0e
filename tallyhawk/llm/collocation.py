"""Phrase collocation mining by dynamic itemset counting.

The corpus is dealt into shards that are scanned in turn, round and round. Words are counted from the first scan on.
A longer phrase becomes active in the scan after the one in which both its subphrases (without its last and without
its first word) have reached the threshold, whichever shard that is, and it is counted in this and the following
scans until it has seen each shard once. So lengths are interleaved: in one scan, words, pairs and triples are counted
side by side, and mining ends when the last phrase has completed its cycle, at most a cycle a length later.

The counts are a table with one row a phrase, named by a 64-bit hash: its count so far, the shards counted and the
scan in which it reached the threshold. A phrase that reaches a threshold t over s shards has t / s or more in one of
them, so a shard's smaller counts are not kept (most phrases occur once); a shard without a count may hide up to that,
and a phrase is taken to have reached the threshold once it may have. Tasks know the subphrases that did from bitmaps of bounded size, which have no
false negatives; a phrase that gets in by chance is counted too, and the shards noted keep any phrase from being counted
twice. Tasks add up their counts before the shuffle, so a frequent word or phrase is a row a task. The phrases that
reached the threshold are written out by a last scan, which counts them by their words: neither hashes that meet nor counts that were not
kept change a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import combined, cut, in_filter, key_filters, prepare, release
from tallyhawk.llm.text import BYTE, U, buffers, mix, power, signed, slices

#: Between pieces, and between the words of a piece.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \x09"
SLICE = 1 << 20
UNKNOWN = "und"

_HASHED = "size int, h long, n long"
_NAMED = "size int, lang string, phrase string, n long"
_SPACE, _BREAK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_BREAK[list(BREAKS)] = True
_SPACE[list(BREAKS + BLANKS)] = True
_MIX = U(0xD6E8FEB86659FD93)


def _hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string."""
    data, offsets = buffers(strings)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    total = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE[data] * power("up", len(data)), out=total[1:])
    return mix((total[offsets[1:]] - total[offsets[:-1]]) * power("down", len(data) + 1)[offsets[:-1]])


class Tokens:
    """Words of one slice of texts: ``dictionary`` and for each word its ``code`` there, ``doc`` and ``piece``."""

    def __init__(self, text: pa.Array):
        data, offsets = buffers(pc.ascii_lower(text))
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        word = np.zeros(len(data) + 2, dtype=bool)
        word[1:-1] = ~_SPACE[data]
        cuts = offsets[1:-1]
        opens, closes = word[1:] & ~word[:-1], word[:-1] & ~word[1:]  # between the bytes
        inner = cuts[word[cuts] & word[cuts + 1]]  # words of two documents that touch
        opens[inner] = closes[inner] = True
        start, end = np.flatnonzero(opens), np.flatnonzero(closes)
        breaks = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(_BREAK[data], out=breaks[1:])
        self.doc = np.searchsorted(offsets, start, "right") - 1
        self.piece = breaks[start] + self.doc
        ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[word[1:-1]].tobytes())])
        coded = words.dictionary_encode()
        self.dictionary, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _phrases(lang: pa.Array, text: pa.Array, longest: int, ready: list, late: list | None):
    """Active phrases of one slice, by size: size, tokens, languages of the texts, places, exact names, hashes, which count.

    ``ready[k]``: bitmap of phrases of k words that reached the threshold before this scan; ``late[k]``: those of them
    whose phrases have not completed their cycle (None: nothing has).
    """
    t = Tokens(text)
    if not len(t.code):
        return
    lang = lang.dictionary_encode()
    of_lang = lang.indices.to_numpy()[t.doc].astype(np.int64)
    h = mix(_hashes(t.dictionary)[t.code] ^ mix(_hashes(lang.dictionary))[of_lang])
    name = _named(of_lang * len(t.dictionary) + t.code)  # of the phrase that starts here, exact
    many, single = int(name.max()) + 1, name
    at = np.arange(len(name))  # where phrases of the size start
    yield 1, t, lang, of_lang, at, name, h, np.ones(len(at), dtype=bool)
    for size in range(2, longest + 1):
        on = in_filter(*ready[size - 1], h)  # of phrases one word shorter, at ``at``
        pair = np.flatnonzero((at[1:] == at[:-1] + 1) & on[1:] & on[:-1])
        pair = pair[at[pair] + size - 1 < len(t.piece)]
        pair = pair[t.piece[at[pair]] == t.piece[at[pair] + size - 1]]
        if not len(pair):
            return
        if late is None:
            count = np.ones(len(pair), dtype=bool)
        else:
            new = in_filter(*late[size - 1], h)
            count = new[pair] | new[pair + 1]
        name = _named(name[pair] * many + single[at[pair] + size - 1])
        h = mix(h[pair] * _MIX + h[pair + 1])
        at = at[pair]
        yield size, t, lang, of_lang, at, name, h, count


def _named(key: np.ndarray) -> np.ndarray:
    """Names from 0, equal ones for equal keys."""
    order = np.argsort(key)
    sorted_ = key[order]
    fresh = np.zeros(len(key), dtype=np.int64)
    np.cumsum(sorted_[1:] != sorted_[:-1], out=fresh[1:])
    name = np.empty(len(key), dtype=np.int64)
    name[order] = fresh
    return name


def _counting(longest: int, words: bool, ready: list, late: list | None):
    """Counts of the active phrases of the batches (lang, text), by hash."""
    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for b in batches:
            for lo, hi, _, _ in slices(b.column("text"), SLICE):
                for size, *_, h, count in _phrases(b.column("lang")[lo:hi], b.column("text")[lo:hi], longest, ready, late):
                    if size > 1 or words:
                        found = np.sort(h[count])
                        edge = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1], [True]))) if len(found) else np.zeros(1, np.int64)
                        yield pa.table({"size": pa.array(np.full(len(edge) - 1, size, np.int32)),
                                        "h": pa.array(signed(found[edge[:-1]])), "n": pa.array(np.diff(edge))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from combined(tables(batches), ["size", "h"], ["n"], held=1 << 19)

    return run


def _naming(longest: int, wanted: list):
    """Counts of the phrases of the bitmaps ``wanted[size]``, by their words; of size 0 all words of each language."""
    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for b in batches:
            for lo, hi, _, _ in slices(b.column("text"), SLICE):
                for size, t, lang, of_lang, at, name, h, _ in _phrases(b.column("lang")[lo:hi], b.column("text")[lo:hi], longest, wanted, None):
                    if size == 1:
                        n = np.bincount(of_lang, minlength=len(lang.dictionary))
                        yield pa.table({"size": pa.array(np.zeros(len(n), np.int32)), "lang": lang.dictionary.cast(pa.string()),
                                        "phrase": pa.array([""] * len(n)), "n": pa.array(n)})
                    keep = np.flatnonzero(in_filter(*wanted[size], h))
                    if not len(keep):
                        break
                    _, first, n = np.unique(name[keep], return_index=True, return_counts=True)
                    first = keep[first]
                    parts = [t.dictionary.take(pa.array(t.code[at[first] + k])) for k in range(size)]
                    phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
                    yield pa.table({"size": pa.array(np.full(len(first), size, np.int32)),
                                    "lang": lang.dictionary.take(pa.array(of_lang[at[first]])).cast(pa.string()),
                                    "phrase": phrase.cast(pa.string()), "n": pa.array(n)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from combined(tables(batches), ["size", "lang", "phrase"], ["n"], held=1 << 16)

    return run


def _part(phrase: str, words: str) -> Column:
    """The first words of a phrase, or with a negative number the last."""
    return F.expr(f"substring_index({phrase}, ' ', {words})")


def _bitmaps(rows: DataFrame, sizes: list[int], counts: dict[int, int]) -> list:
    """A key filter of ``rows`` (size, h) for each size, at its place in a list."""
    found = key_filters(rows, "h", "size", {k: counts.get(k, 0) for k in sizes}) if sizes else {}
    return [None, *(found[k] for k in sizes)]


def count_phrases(docs: DataFrame, longest: int = 3, least: int = 10, shards: int = 3) -> DataFrame:
    """size, lang, phrase, f: every word and phrase of up to ``longest`` words that occurs ``least`` times, with its exact count.

    A row of size 0 a language has the number of its words. ``docs`` has lang and text, neither null.
    """
    spark = docs.sparkSession
    prepare(spark)
    shard = F.pmod(F.xxhash64(*docs.columns), F.lit(shards))
    shorter = list(range(1, longest))
    enough = -(-least // shards)
    state = None
    for step in range(longest * shards):
        ready, late = [None] * (longest + 1), None
        if state is not None:
            reached = state.filter((F.col("size") < longest) & F.col("reach").isNotNull())
            fresh = F.col("reach") >= step - shards
            sizes = {r["size"]: (r["n"], r["late"]) for r in reached.groupBy("size").agg(
                F.count("*").alias("n"), F.count_if(fresh).alias("late")).collect()}
            if step >= shards and not any(x for _, x in sizes.values()):
                break  # every phrase has completed its cycle
            ready = _bitmaps(reached, shorter, {k: n for k, (n, _) in sizes.items()})
            if step >= shards:
                late = _bitmaps(reached.filter(fresh), shorter, {k: x for k, (_, x) in sizes.items()})
        known = spark.sparkContext.broadcast((ready, late))

        def run(batches, known=known, active=min(longest, step + 1), words=step < shards):
            return _counting(active, words, *known.value)(batches)

        bit = 1 << (step % shards)
        found = docs.filter(shard == step % shards).mapInArrow(run, _HASHED).groupBy("size", "h").agg(F.sum("n").alias("n")) \
            .filter(F.col("n") >= enough).select("size", "h", F.lit(0).cast("long").alias("f"), F.lit(0).alias("seen"),
                                                 F.lit(None).cast("int").alias("reach"), "n")
        before = state
        rows = found if before is None else found.union(before.withColumn("n", F.lit(0).cast("long")))
        merged = rows.groupBy("size", "h").agg(F.sum("f").alias("f"), F.max("seen").alias("seen"), F.max("reach").alias("reach"),
                                               F.sum("n").alias("n"))
        total = F.when(F.col("seen").bitwiseAND(bit) == 0, F.col("f") + F.col("n")).otherwise(F.col("f"))
        seen = F.when(F.col("n") > 0, F.col("seen").bitwiseOR(bit)).otherwise(F.col("seen"))
        hidden = (enough - 1) * (min(step + 1, shards) - F.bit_count("seen"))
        state = merged.select("size", "h", total.alias("f"), seen.alias("seen"), "reach")
        state = cut(state.withColumn("reach", F.coalesce("reach", F.when(F.col("f") + hidden >= least, F.lit(step)))))
        if before is not None:
            release(before)
        known.unpersist()

    often = state.filter(F.col("reach").isNotNull())
    counts = {r["size"]: r["count"] for r in often.groupBy("size").count().collect()}
    wanted = spark.sparkContext.broadcast(_bitmaps(often, [*shorter, longest], counts))
    release(state)
    named = docs.mapInArrow(lambda batches: _naming(longest, wanted.value)(batches), _NAMED)
    return named.groupBy("size", "lang", "phrase").agg(F.sum("n").alias("f")).filter((F.col("size") == 0) | (F.col("f") >= least))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, contained: int = 50, shards: int = 3) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score (long): the ``top`` phrases of each language of ``docs`` (lang, text).

    Texts are lower-cased (A-Z), cut into pieces at ``BREAKS`` and those into words at ``BLANKS``. A candidate has 2 to
    ``longest`` words and occurs a >= ``least`` times within pieces. Cut in two parts that occur l and r times it
    scores floor(1000000 a a / (l r)); the lowest-scoring cut counts, ties to the shortest first part. A candidate
    goes where a longer one that holds its words has at least ``contained`` per cent of its count. n: words of the
    language. Ties in the ranking: larger a, then the phrase in byte order. A null text is empty, a null lang is
    ``und``; rows that repeat count again, other columns are ignored, texts of any length count as a whole, an empty
    table gives no rows.
    """
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    often = cut(count_phrases(docs, longest, least, shards))
    total = often.filter("size = 0").select("lang", F.col("f").alias("n"))
    often = often.filter("size > 0")
    candidates = often.filter("size > 1").select("size", "lang", "phrase", F.col("f").alias("a"))
    parts = often.select("lang", "phrase", "f")
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))) \
        .withColumn("left", _part("phrase", "k")).withColumn("right", _part("phrase", "k - size")) \
        .join(parts.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"]) \
        .join(parts.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"])
    wide = {c: f"cast({c} as decimal(38,0))" for c in "alr"}
    score = F.expr(f"(cast(1000000 as decimal(38,0)) * {wide['a']} * {wide['a']}) div ({wide['l']} * {wide['r']})")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inside = candidates.filter("size > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.expr(f"longer is null or cast(100 as decimal(38,0)) * longer < cast({contained} as decimal(38,0)) * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
