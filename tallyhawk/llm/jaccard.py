"""N-gram Jaccard join by PartEnum signatures.

Two sets of words' shingles with Jaccard similarity of at least t, neither larger than s, differ in at
most k = floor(2 (1 - t) / (1 + t) * s) elements. PartEnum cuts the (hashed) feature domain into
n1 = ceil((k + 1) / 2) parts; such sets differ by at most one element in one of them. Each part is cut
into n2 = 3 again, and for each two of these the elements inside are one signature: the sets share one
of the part they differ by one in. A signature without elements would tie strangers, so there are
``slack`` parts more than needed: a set with at most that many parts whose elements lie in fewer than
two of the three still has a part that must differ by at most one and none of whose signatures is
empty, and its empty signatures are left out. Signatures belong to a band of sizes, whose upper end is s; a set that may be
similar to sets of the next band has signatures for that band too.

1. Equal sets are one vertex, named by a hash of the set, so copies are never paired.
2. Only sets that may be similar to another go on. A set of n shows its ``shown(n)`` smallest elements, a few more than
   it may differ in. Of two similar sets, that whose last shown element is the smaller has at least ``needed(n)`` of
   its shown ones among those that the other shows (its elements up to there are all shown), and so has the other at
   least as many. A set fewer of whose shown elements are shown by another set is similar to none: strangers that share
   a passage make no signatures.
3. (signature, vertex) pairs are gathered, pre-aggregated to the smallest and largest vertex. Signatures
   of one vertex alone fall away, and of those with the same vertices one stays. A vertex has a sketch, the parities of
   its elements by their hash, about two a set's element: sketches differ in at most as many places as the sets do.
   Of a signature's vertices those are tied whose sketches allow them to be similar; where a signature has more than
   ``SKETCHED`` each is tied to the smallest. The connected groups of these ties (star rounds) hold all similar pairs.
4. The sets of the vertices in groups are read again. A group's neighbouring size classes are dealt into
   blocks of bounded elements; a pair of blocks is one task's work: exact intersections of its pairs over an inverted list. It
   returns joining links only, never the pairs.
5. The components of the links give the answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import components, cut, give_back, in_filter, key_filter, prepare, release, tidied
from tallyhawk.llm.text import SMALL_SLICE, U, Words, grams, mix, signed, slices

#: Second-level parts of each first-level part.
N2 = 3
#: A band's upper end is about its lower end divided by the similarity this often.
BAND_STEPS = 2
#: Per cent of a set's elements that it shows beyond those that it may differ in.
SHOWN_MORE = 10
#: Vertices of a signature whose sketches are compared; rows of sketches that a task holds.
SKETCHED = 4096
SKETCH_ROWS = 20_000
#: Elements of one block of a group; a task holds two blocks.
BLOCK_ELEMENTS = 1_000_000


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted by (document, hash), and their documents.

    With fewer than ``k`` words the whole sequence is the one shingle; without words there is none.
    """
    h, at = grams(words.hash, words.doc, k)
    doc = words.doc[at]
    for d in np.flatnonzero((words.count > 0) & (words.count < k)):
        whole = words.hash[words.first[d]:words.first[d + 1]]
        one = U(len(whole))
        for x in whole:
            one = mix(np.array([one ^ x]))[0]
        h, doc = np.append(h, one), np.append(doc, d)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


class Bands:
    """Size bands: band i holds sizes from ``low[i]``; similar sets lie in one band or in neighbours."""

    def __init__(self, percent: int, largest: int):
        self.low, self.percent = [1], percent
        while self.low[-1] <= largest or len(self.low) < 3:
            x = self.low[-1]
            for _ in range(BAND_STEPS):
                x = x * 100 // percent + 1
            self.low.append(x)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.low, size, "right")) - 1


def parts_for(percent: int, high: int) -> int:
    """First-level parts for similar sets of sizes up to ``high``: at most one difference in one of them."""
    k = 2 * (100 - percent) * high // (100 + percent)
    return math.ceil((k + 1) / 2)


def signatures(elements: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of one set: for its own band, and for the next if a set there can be similar."""
    own = bands.of(len(elements))
    out = []
    for band in (own, own + 1):
        if band > own and 100 * len(elements) < bands.percent * bands.low[band]:
            continue
        n1 = parts_for(bands.percent, bands.low[band + 1] - 1)
        slack = 1 + n1 // 20
        n1 += slack
        spread = mix(elements + U(2 * band + 1))
        part = ((spread >> U(32)) % U(n1 * N2)).astype(np.int64)
        total = np.zeros(n1 * N2, dtype=U)  # sums of mixed elements: equal for equal subsets
        np.add.at(total, part, spread)
        total = total.reshape(n1, N2)
        filled = np.bincount(part, minlength=n1 * N2).reshape(n1, N2) > 0
        leave_out = (filled.sum(axis=1) < N2 - 1).sum() <= slack
        place = np.arange(n1, dtype=U) << U(32)
        for chosen in combinations(range(N2), N2 - 1):
            mark = U((band << 8) + sum(1 << c for c in chosen))
            made = mix(mix(total[:, chosen].sum(axis=1, dtype=U)) + mix(place + mark))
            out.append(made[filled[:, chosen].any(axis=1)] if leave_out else made)
    return np.concatenate(out)


def _common(n, percent: int):
    """Elements that a set of ``n`` has at least in common with a similar one; also the size of the smallest such."""
    return (percent * n + 99) // 100


def _more(n, percent: int):
    return np.minimum(np.maximum(1, n * SHOWN_MORE // 100), _common(n, percent))


def shown(n, percent: int):
    """How many of its smallest elements a set of ``n`` shows."""
    return n - _common(n, percent) + _more(n, percent)


def needed(n, percent: int):
    """How many of its shown elements a set of ``n`` has to find shown by another to be similar to it."""
    return _more(_common(n, percent), percent)


def sketch(elements: np.ndarray) -> bytes:
    """The parity of the number of elements in each of 2 to 4 times as many places, 64 at least."""
    places = 1 << max(6, (2 * len(elements) - 1).bit_length())
    at = (mix(elements + U(3)) & U(places - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=places) & 1).tobytes()


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches, a row each, as they are with the places of ``width`` bytes."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1)


def sketched_links(ids: np.ndarray, size: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Links that join all sets connected by pairs whose sketches differ in no more places than similar sets may."""
    width = np.fromiter(map(len, sketches), np.int64, len(sketches))
    row, rows = np.zeros(len(ids), dtype=np.int64), {}
    for w in np.unique(width).tolist():
        of = np.flatnonzero(width == w)
        row[of] = np.arange(len(of))
        rows[w] = np.frombuffer(b"".join(sketches[i] for i in of), np.uint8).reshape(len(of), w)
    links, left = [], np.arange(len(ids))
    while len(left):
        joined, left = [left[0]], left[1:]
        while joined and len(left):
            one = joined.pop()
            near = 100 * np.minimum(size[left], size[one]) >= percent * np.maximum(size[left], size[one])
            for w in np.unique(width[left[near]]).tolist():
                at = np.flatnonzero(near & (width[left] == w))
                least = min(w, int(width[one]))
                apart = _folded(rows[w][row[left[at]]], least) ^ _folded(rows[int(width[one])][row[one]][None], least)
                near[at] = (100 + percent) * np.bitwise_count(apart).sum(axis=1, dtype=np.int64) <= (100 - percent) * (size[left[at]] + size[one])
            links += [(int(ids[one]), int(ids[i])) for i in left[near]]
            joined += left[near].tolist()
            left = left[~near]
    return links


def joining_links(ids: list[int], sets: list[np.ndarray], percent: int, left: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links (J >= percent / 100) that join all sets that are connected by such links.

    With ``left`` only links between a left and another set are looked for. An inverted list over the
    elements gives a set's intersections with all sets before it at once; only the first link into
    each of their components is returned.
    """
    order = sorted(range(len(sets)), key=lambda i: (not left[i] if left else False, len(sets[i]), ids[i]))
    cross = sum(left) if left else 0
    size = np.array([len(sets[i]) for i in order])
    flat = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(order)), size)
    by_element = np.argsort(flat, kind="stable")  # owners ascend inside an element's list
    flat, owner = flat[by_element], owner[by_element]
    begin = np.searchsorted(flat, flat, "left")
    before = np.arange(len(flat)) - begin
    if cross:
        lefts = np.concatenate(([0], np.cumsum(owner < cross)))
        before = np.minimum(before, lefts[np.searchsorted(flat, flat, "right")] - lefts[begin])
    place = np.empty(len(flat), dtype=np.int64)
    place[by_element] = np.arange(len(flat))
    start = np.cumsum(size) - size
    label = np.arange(len(order))
    links = []
    for j in range(max(1, cross), len(order)):
        entry = place[start[j]:start[j] + size[j]]
        count = before[entry]
        total = int(count.sum())
        if not total:
            continue
        step = np.repeat(begin[entry] - (np.cumsum(count) - count), count) + np.arange(total)
        shared = np.bincount(owner[step], minlength=j)
        near = np.flatnonzero((shared > 0) & (100 * shared >= percent * (size[:j] + size[j] - shared)))
        if len(near):
            joined, at = np.unique(label[near], return_index=True)
            links += [(ids[order[j]], ids[order[int(near[a])]]) for a in at]
            label[:j][np.isin(label[:j], joined)] = joined[0]
            label[j] = joined[0]
    return links


def _slices(text: pa.Array, shingle: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, element hashes, their edges by row, vertex of each row) for slices of ``text``."""
    for lo, hi, data, offsets in slices(text, SMALL_SLICE):
        h, doc = shingle_sets(Words(data, offsets, lower=True), shingle)
        edge = np.searchsorted(doc, np.arange(hi - lo + 1))
        total = np.concatenate((np.zeros(1, U), np.cumsum(mix(h + U(1)))))
        yield lo, hi, h, edge, mix(total[edge[1:]] - total[edge[:-1]] + np.diff(edge).astype(U))


def _sets(docs: DataFrame, shingle: int, made, columns: str) -> DataFrame:
    """``made(ids, element hashes, edges, vertex of each document)`` over slices of ``docs`` (doc_id, text)."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, h, edge, vertex in _slices(b.column("text"), shingle):
                yield pa.RecordBatch.from_arrays(made(b.column("doc_id").slice(lo, hi - lo), h, edge, vertex), names)

    return docs.mapInArrow(tidied(run), columns)


def _chosen(docs: DataFrame, shingle: int, which) -> DataFrame:
    """The rows of ``docs`` that ``which(element hashes, edges)`` marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, h, edge, _ in _slices(b.column("text"), shingle):
                yield b.slice(lo, hi - lo).filter(pa.array(which(h, edge)))

    return docs.mapInArrow(tidied(run), docs.schema)


def jaccard_components(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key, kept for each row of ``docs`` (doc_id, text).

    Sets of ``shingle``-word shingles of the text with A-Z lower-cased; two documents are linked when
    100 * intersection >= percent * union, and component_id is the smallest doc_id reachable. A null text or
    one without words has the empty set and is linked with nothing; rows that repeat a doc_id are judged
    each by its own text. ``text_key`` is a hash of the text, which with doc_id names the row; ``kept`` marks
    one doc_id and text of each component: the smallest doc_id's, ties to the smaller text_key. A row without
    doc_id belongs to its component like any other and gives it no id; it is kept only where none has one.
    Repeated rows share the verdict; texts of any length count as a whole. An empty table gives no rows;
    other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key")).alias("doc_id"), "text")
    bands = Bands(percent, 1 << 40)

    def describe(ids, h, edge, vertex) -> list[pa.Array]:
        return [ids, pa.array(np.diff(edge).astype(np.int64)), pa.array(signed(vertex))]

    def show(h, edge) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(edge)
        doc = np.repeat(np.arange(len(n)), n)
        at = np.flatnonzero(np.arange(len(h)) - edge[doc] < shown(n, percent)[doc])  # a set's elements ascend
        return h[at], doc[at]

    def show_all(ids, h, edge, vertex) -> list[pa.Array]:
        element, doc = show(h, edge)
        return [pa.array(signed(element)), pa.array(signed(vertex[doc]))]

    def mark(h, edge, vertex) -> tuple[np.ndarray, np.ndarray]:
        made = [signatures(h[a:z], bands) if z > a else np.zeros(0, U) for a, z in zip(edge, edge[1:])]
        return np.concatenate(made), np.repeat(vertex, [len(m) for m in made])

    def all_marks(ids, h, edge, vertex) -> list[pa.Array]:
        return [pa.array(signed(x)) for x in mark(h, edge, vertex)]

    described = cut(_sets(docs, shingle, describe, "doc_id struct<doc_id:bigint,text_key:bigint>, n long, vertex long")
                    .select("doc_id.*", "n", "vertex"))
    met = cut(_sets(docs, shingle, show_all, "element long, vertex long").groupBy("element").agg(
        F.min("vertex").alias("least"), F.max("vertex").alias("most")).filter("least < most").select("element"))
    by_another = spark.sparkContext.broadcast(key_filter(met, "element", met.count()))
    release(met)

    def may_join(h, edge) -> np.ndarray:
        element, doc = show(h, edge)
        n = np.diff(edge)
        found = np.bincount(doc[in_filter(*by_another.value, element)], minlength=len(n))
        return (n > 0) & (found >= needed(n, percent))

    docs = cut(_chosen(docs, shingle, may_join))
    marks = _sets(docs, shingle, all_marks, "mark long, vertex long")
    shared = cut(marks.groupBy("mark").agg(F.min("vertex").alias("least"), F.max("vertex").alias("most"))
                 .filter("least < most").select("mark", "least"))
    of_several = spark.sparkContext.broadcast(key_filter(shared, "mark", shared.count()))

    def shared_marks(ids, h, edge, vertex) -> list[pa.Array]:
        m, v = mark(h, edge, vertex)
        at = in_filter(*of_several.value, m)
        return [pa.array(signed(m[at])), pa.array(signed(v[at]))]

    def sketches(ids, h, edge, vertex) -> list[pa.Array]:
        n = np.diff(edge)
        return [pa.array(signed(vertex)), pa.array(n), pa.array([sketch(h[a:z]) for a, z in zip(edge, edge[1:])], pa.binary())]

    met = cut(_sets(docs, shingle, shared_marks, "mark long, vertex long").distinct().join(shared, "mark"))
    # signatures with the same vertices say the same
    marked = met.groupBy("mark").agg(F.count("*").alias("sets"), F.sum(F.xxhash64("vertex").cast("decimal(38,0)")).alias("all")) \
        .filter("sets > 1").groupBy("sets", "all").agg(F.min("mark").alias("mark"))
    marked = cut(marked.select("mark", "sets"))
    few = met.join(marked.filter(F.col("sets") <= SKETCHED), "mark")
    described_sets = _sets(docs, shingle, sketches, "vertex long, n long, sketch binary").groupBy("vertex").agg(
        F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    deal = marked.filter(F.col("sets") <= SKETCHED).agg(F.sum("sets")).first()[0] or 0
    dealt = few.join(described_sets, "vertex").select("mark", "vertex", "n", "sketch", F.pmod(F.xxhash64("mark"), F.lit(deal // SKETCH_ROWS + 1)).alias("deal"))

    def allowed(rows: pd.DataFrame) -> pd.DataFrame:
        found = set()
        for at in rows.groupby("mark").indices.values():
            found.update(sketched_links(rows["vertex"].to_numpy()[at], rows["n"].to_numpy()[at], rows["sketch"].to_numpy()[at].tolist(), percent))
        give_back()
        return pd.DataFrame(list(found), columns=["vertex", "least"], dtype="int64")

    ties = dealt.groupBy("deal").applyInPandas(allowed, "vertex long, least long")
    ties = cut(ties.union(met.join(marked.filter(F.col("sets") > SKETCHED), "mark").select("vertex", "least")))
    groups = cut(components(ties, "vertex", "least", "group"))
    release(met, marked, ties)
    # similar sets lie in one size class or in neighbours, so a group's classes meet in pairs (c, c + 1) only
    sized = groups.withColumnRenamed("node", "vertex").join(
        described.filter("n > 0").groupBy("vertex").agg(F.min("n").alias("n")), "vertex")
    widest = F.lit(math.log(100 / percent) + 1e-9)
    sized = sized.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / widest)).withColumn(
        "pair", F.explode(F.array(F.col("class") - 1, F.col("class"))))
    # written, as are the component minima below: both sides of the join are plain exchanges, so a hot group's rows can be split
    sizes = cut(sized.groupBy("group", "pair").agg(F.ceil(F.sum("n") / BLOCK_ELEMENTS).alias("blocks"), F.count("*").alias("sets")))
    chosen = cut(sized.join(sizes.filter("sets > 1"), ["group", "pair"]).select("vertex", "group", "pair", "blocks"))
    in_groups = spark.sparkContext.broadcast(key_filter(chosen, "vertex", chosen.count()))

    def elements(ids, h, edge, vertex) -> list[pa.Array]:
        at = np.flatnonzero(in_filter(*in_groups.value, vertex) & (np.diff(edge) > 0)).tolist()
        raw = h.tobytes()
        return [pa.array(signed(vertex[at])), pa.array([raw[8 * edge[i]:8 * edge[i + 1]] for i in at], pa.binary())]

    sets = _sets(docs, shingle, elements, "vertex long, elements binary") \
        .groupBy("vertex").agg(F.min("elements").alias("elements")).join(chosen, "vertex")
    pairs = sets.withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "group", "pair", "vertex", "elements", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        left = None if rows["a"].iloc[0] == rows["b"].iloc[0] else (rows["block"] == rows["a"]).tolist()
        found = joining_links(rows["vertex"].tolist(), [np.frombuffer(e, U) for e in rows["elements"]], percent, left)
        give_back()
        return pd.DataFrame(found, columns=["x", "y"], dtype="int64")

    linked = cut(pairs.groupBy("group", "pair", "a", "b").applyInPandas(links, "x long, y long"))
    root = components(linked, "x", "y", "root").withColumnRenamed("node", "vertex")
    rooted = described.join(root, "vertex", "left").select(
        "doc_id", "text_key", "n", F.when(F.col("n") > 0, F.coalesce("root", "vertex")).alias("root"))
    # written, so that both sides of the join below are plain exchanges and a hot component's rows can be split
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    least = cut(rooted.filter("n > 0").groupBy("root").agg(F.min(row).alias("least")))
    out = rooted.join(least, "root", "left")
    same = F.col("least.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("least.text_key") == F.col("text_key"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                      "text_key", (F.col("least").isNull() | same).alias("kept"))
