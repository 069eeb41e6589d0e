"""Substring dedup: words inside a window of words that an earlier document also has are removed.

A suffix automaton of every document against every document would be quadratic, so both sides are
first cut down to where they can meet. Each window names its anchor: the leftmost gram with the
smallest hash inside it. Equal windows have equal anchors, and about two words in nine start one.

1. One pass gathers (anchor, doc_id); an anchor of one document alone cannot repeat and is dropped.
2. A second pass gathers, for the anchors left, each run of windows that one anchor owns: a hash of
   its words, where it starts, how many windows. Where all runs of an anchor have the same words, the
   smallest doc_id among them settles all their windows.
3. The words of the other runs, once per distinct run, are the references. They are dealt into shards
   by anchor (the windows of an anchor with very many runs by their own hash), and a suffix automaton
   of each shard's references, each state marked with the smallest doc_id it occurs in, streams the
   runs for their matching statistics. A shard's size is bounded, and an automaton goes to the runs
   that can match it alone, instead of being sent to every task.

Hashes have 64 bits; equal hashes are taken for equal words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, in_filter, key_filter, prepare, tidied
from tallyhawk.llm.text import SMALL_SLICE, U, Words, grams, mix, signed, slices

WINDOW = 13
GRAM = 6
#: Stands for a missing doc_id: later than any other.
NO_ID = 1 << 62
#: References of one automaton; also the runs of one anchor above which its windows are dealt on their own.
SHARD_RUNS = 4_000


class Runs:
    """Runs of consecutive windows that share an anchor, for one slice of documents."""

    def __init__(self, words: Words, window: int, gram: int):
        n, width = len(words.hash) - window + 1, window - gram + 1
        self.words = words
        if n <= 0:
            self.anchor = self.content = np.zeros(0, U)
            self.start = self.windows = self.doc = np.zeros(0, np.int64)
            return
        smallest, _ = grams(words.hash, np.zeros(len(words.hash), np.int64), gram)
        where = np.arange(len(smallest))
        power = 1
        while 2 * power <= width:
            smallest, where = self._leftmost(smallest, where, power, len(smallest) - power)
            power *= 2
        smallest, where = self._leftmost(smallest, where, width - power, n)
        whole = words.doc[:n] == words.doc[window - 1:]
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (where[1:] != where[:-1]) | ~whole[:-1]
        self.start = np.flatnonzero(whole & fresh)
        ends = np.append(np.flatnonzero(fresh), n)
        self.windows = ends[np.searchsorted(ends, self.start, "right")] - self.start
        broken = np.append(np.flatnonzero(~whole), n)
        self.windows = np.minimum(self.windows, broken[np.searchsorted(broken, self.start)] - self.start)
        self.anchor = smallest[self.start]
        self.doc = words.doc[self.start]
        self.end = self.start + self.windows + window - 1
        self.content = content(words.hash, self.start, self.end)

    @staticmethod
    def _leftmost(value: np.ndarray, where: np.ndarray, step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if step == 0:
            return value[:n], where[:n]
        left = value[:n] <= value[step:step + n]
        return np.where(left, value[:n], value[step:step + n]), np.where(left, where[:n], where[step:step + n])


def content(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash for the words from ``start`` to before ``end``, for each pair."""
    base, inverse = 0xA24BAED4963EE407, pow(0xA24BAED4963EE407, -1, 1 << 64)
    up, down = np.full(len(hashes) + 1, base, U), np.full(len(hashes) + 1, inverse, U)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    total = np.concatenate((np.zeros(1, U), np.cumsum(hashes * up[:-1])))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U))


class SuffixAutomaton:
    """All substrings of the references; each state knows the smallest document they occur in."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.document = [-1], [0], [1 << 62]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.document.append(1 << 62)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """A copy of ``q`` for its substrings that end after ``p`` and ``word``."""
        made = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = made
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = made
            p = self.link[p]
        return made

    def add(self, words: list[int], document: int) -> None:
        """Add a reference text that ``document`` holds."""
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
            else:
                made = self._state(self.length[last] + 1, 0, {})
                p = last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = made
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[made] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
                last = made
            if document < self.document[last]:
                self.document[last] = document

    def close(self) -> None:
        """Hand the documents down to all shorter substrings; to be called after the last ``add``."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.document[s] < self.document[self.link[s]]:
                self.document[self.link[s]] = self.document[s]

    def stream(self, words: list[int], window: int) -> list[int]:
        """Matching statistics cut at ``window``: for each window of ``words`` the smallest document with it."""
        state = matched = 0
        found = []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while self.length[self.link[state]] >= window and state:
                state = self.link[state]
                matched = self.length[state]
            if i >= window - 1:
                found.append(self.document[state] if matched >= window else 1 << 62)
        return found


def _per_slice(docs: DataFrame, made, columns: str, window: int, gram: int) -> DataFrame:
    """``made(ids, runs)`` over slices of ``docs`` (doc_id, row, text); it returns Arrow columns."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row")]
            for lo, hi, data, offsets in slices(b.column("text"), SMALL_SLICE):
                runs = Runs(Words(data, offsets, lower=False), window, gram)
                yield pa.RecordBatch.from_arrays(made([i[lo:hi] for i in ids], runs), names)

    return docs.mapInArrow(tidied(run), columns)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Maximal-by-run spans of repeated windows: doc_id, row, start, stop (word indexes, stop exclusive).

    ``docs`` has doc_id, row and text, where (doc_id, row) names a row. A window is repeated where a
    document of smaller doc_id has the same words anywhere.
    """
    prepare(docs.sparkSession)
    sc = docs.sparkSession.sparkContext

    seen = _per_slice(docs, lambda ids, r: [pa.array(signed(r.anchor)), pa.array(ids[0][r.doc])],
                      "anchor long, doc_id long", window, gram)
    shared = cut(seen.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                 .filter("a < b").select("anchor"))
    few = sc.broadcast(key_filter(shared, "anchor", shared.count()))

    def owned(ids: list[np.ndarray], r: Runs) -> list[pa.Array]:
        at = np.flatnonzero(in_filter(*few.value, r.anchor))
        doc = r.doc[at]
        return [pa.array(x) for x in (signed(r.anchor[at]), signed(r.content[at]), ids[0][doc], ids[1][doc],
                                      (r.start[at] - r.words.first[doc]).astype(np.int32), r.windows[at].astype(np.int32))]

    runs = cut(_per_slice(docs, owned, "anchor long, content long, doc_id long, row long, start int, windows int",
                          window, gram))
    distinct = cut(runs.groupBy("anchor", "content", "windows").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")))
    several = cut(distinct.groupBy("anchor").agg(F.count("*").alias("runs")).filter("runs > 1"))
    # one run of words for the anchor: its smallest document settles all its windows
    alone = distinct.join(several, "anchor", "left_anti").filter("least < most").select(
        "anchor", "content", F.lit(0).alias("low"), F.col("windows").alias("high"), "least")

    total = several.agg(F.sum("runs")).first()[0] or 0
    mixed = sc.broadcast(key_filter(several, "anchor", several.count()))

    def texts(ids: list[np.ndarray], r: Runs) -> list[pa.Array]:
        at = np.flatnonzero(in_filter(*mixed.value, r.anchor))
        _, once = np.unique(r.content[at], return_index=True)
        at = at[once]
        raw = r.words.hash.tobytes()
        words = [raw[8 * a:8 * b] for a, b in zip(r.start[at].tolist(), r.end[at].tolist())] if len(at) else []
        return [pa.array(signed(r.anchor[at])), pa.array(signed(r.content[at])), pa.array(words, pa.binary())]

    references = _per_slice(docs, texts, "anchor long, content long, words binary", window, gram) \
        .groupBy("anchor", "content").agg(F.min("words").alias("words"))
    references = references.join(distinct, ["anchor", "content"]).join(several, "anchor")
    hot = F.col("runs") > SHARD_RUNS
    by_window = F.expr(f"transform(sequence(0, windows - 1), i -> struct(i as low, substring(words, i * 8 + 1, {8 * window}) as words))")
    references = references.select(
        "anchor", "content", "least", F.explode(F.when(hot, by_window).otherwise(
            F.array(F.struct(F.lit(0).alias("low"), "words")))).alias("r"), hot.alias("hot"))
    shards = max(1, -(-total // SHARD_RUNS))
    shard = F.pmod(F.when(F.col("hot"), F.xxhash64("r.words")).otherwise(F.xxhash64("anchor")), F.lit(shards))
    references = references.select(shard.alias("shard"), "anchor", "content", "least", "r.low", "r.words")

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        flat = np.frombuffer(b"".join(rows["words"]), dtype=U)
        _, flat = np.unique(flat, return_inverse=True)
        ends = np.cumsum(rows["words"].str.len().to_numpy() // 8)
        texts = [x.tolist() for x in np.split(flat, ends[:-1])]
        automaton = SuffixAutomaton()
        for t, d in zip(texts, rows["least"].tolist()):
            automaton.add(t, d)
        automaton.close()
        out = []
        for a, c, low, t in zip(rows["anchor"].tolist(), rows["content"].tolist(), rows["low"].tolist(), texts):
            found = automaton.stream(t, window)
            at = 0
            for i in range(1, len(found) + 1):
                if i == len(found) or found[i] != found[at]:
                    out.append((a, c, low + at, low + i, found[at]))
                    at = i
        return pd.DataFrame(out, columns=["anchor", "content", "low", "high", "least"])

    matched = references.groupBy("shard").applyInPandas(match, "anchor long, content long, low int, high int, least long")
    settled = alone.union(matched)
    spans = runs.join(settled, ["anchor", "content"]).filter("least < doc_id")
    return spans.select("doc_id", "row", (F.col("start") + F.col("low")).alias("start"),
                        (F.col("start") + F.col("high") + window - 1).alias("stop"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with n_words, n_removed and kept: the words left, joined by a space.

    A null text has no words; a text shorter than the window loses none. Of copies of a document the one with
    the smallest doc_id keeps its words; a missing doc_id is later than all others; rows that repeat a doc_id, or
    have none, are one document and lose nothing to each other. Texts of any length are read whole. One row per
    row of ``docs``; columns of it that have one of the new names are replaced, others stay, whatever their names.
    """
    docs = docs.drop("n_words", "n_removed", "kept")
    own = "_"
    while any(c.lower().startswith(own) for c in docs.columns):  # names that no column has
        own += "_"
    row_, key_, spans_, id_, of_ = (own + n for n in ("row", "key", "spans", "id", "of"))
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    docs = docs.withColumn(row_, F.xxhash64("text"))
    keyed = docs.select(number.alias("doc_id"), F.col(row_).alias("row"), "text")
    spans = cut(repeated_spans(keyed, window).groupBy(F.col("doc_id").alias(id_), F.col("row").alias(of_)).agg(
        F.collect_set(F.struct("start", "stop")).alias(spans_))  # a document's own: as many as it has anchors at most
        .withColumn(key_, F.xxhash64(id_, of_)))
    losing = docs.sparkSession.sparkContext.broadcast(key_filter(spans, key_, spans.count()))
    fields = [f for f in docs.schema if f.name != row_]
    ddl = "".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}, " for f in fields)

    def finished(b: pa.RecordBatch) -> pa.RecordBatch:
        total, removed, kept = [], [], []
        texts = pc.cast(pc.fill_null(b.column("text"), ""), pa.binary())
        of = b.column(spans_) if spans_ in b.schema.names else pa.nulls(len(b))
        for text, found in zip(texts, of, strict=True):
            words = text.as_py().split()  # of bytes: at 0x20 and 0x09-0x0D alone
            total.append(len(words))
            if found.is_valid:
                edge = np.zeros(len(words) + 1, dtype=np.int32)
                np.add.at(edge, found.values.field("start").to_numpy(), 1)
                np.add.at(edge, found.values.field("stop").to_numpy(), -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        made = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), *made],
                                          [*(f.name for f in fields), "n_words", "n_removed", "kept"])

    def parted(wanted: bool):
        """Only documents that may lose words are shuffled; the others are finished where they are read."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                there = in_filter(*losing.value, b.column(key_).to_numpy().view(U))
                part = b.filter(pa.array(there == wanted))
                yield part if wanted else finished(part)
        return run

    named = docs.withColumn(key_, F.xxhash64(number, row_))
    whole = named.drop(row_).mapInArrow(tidied(parted(False)), f"{ddl}n_words long, n_removed long, kept string")
    losers = named.mapInArrow(tidied(parted(True)), f"{ddl}{row_} long, {key_} long").drop(key_).join(
        spans.drop(key_), (number == F.col(id_)) & (F.col(row_) == F.col(of_)), "left").drop(id_, of_, row_)
    return whole.union(losers.mapInArrow(lambda batches: map(finished, batches), f"{ddl}n_words long, n_removed long, kept string"))
