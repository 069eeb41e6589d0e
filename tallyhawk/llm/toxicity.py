"""Toxic passages by maximum-scoring segments of token log-odds.

Learning: a token's score is its log-odds of occurring in toxic against clean training documents with a
Dirichlet prior that follows its frequency in both, less ``SURE`` standard deviations, so that rare words
count for less; it is kept where that is at least ``MIN_ODDS``. Equal texts are one document. Every
other token has the small negative score ``NEUTRAL``, so a clean text's sum drifts down. A word is
looked up whole, then by its first seven to four letters; such a stem is another token for the first,
the second and each further word of a text that has it, so a text that dwells on a stem tells more
than one that has it by chance. A stem's counts leave out the words and longer stems that have a score
of their own.

Scoring: every token is scored where it stands. A text is read in stretches: one ends where its running sum
falls to zero or ``DROP`` below its peak. A stretch counts a word once, later ones in it are neutral, so within a
segment a repeated word is no more evidence than one, but a word met before takes nothing from a passage further on.
A linear scan finds all maximal scoring segments of each stretch (Ruzzo and Tompa). A segment of
score s in a text of n tokens has the E-value K n exp(-lambda s) by Karlin and Altschul's extreme-value
law; lambda solves sum p exp(lambda s) = 1 over the tokens of clean training documents, K is the
maximum-likelihood fit to their best segments. Segments with an E-value below 1 are significant. A
document's evidence is the sum of -log E over them; a logistic curve of log(1 + evidence), fitted on
training documents, makes it the score.

Counts over all training documents are summed and chosen from by Spark, without a limit. The ``HEAD`` most frequent
chosen tokens are sent to all tasks; where there are more, the others stay a table and meet the texts that may hold
them in a join.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, in_filter, key_filter, prepare

STEMS = (7, 6, 5, 4)
#: Words of one stem in a text that are told apart.
NTH = 3
SURE = 1.64
MIN_ODDS = 1.5
MIN_COUNT = 5
HEAD = 200_000
NEUTRAL = -0.15
#: Fall of the running sum that ends a stretch: 40 neutral words.
DROP = 6.0
#: Weight of the prior against the counts.
PRIOR = 0.1
_WORD = re.compile(r"[^\W\d_]+")
_FLUSH = 500_000


def tokens(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall(text.lower())


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, after last) by the linear scan of Ruzzo and Tompa."""
    found: list[tuple[int, int, float, float]] = []  # first, after last, sum before, sum through
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, after, low, high = i, i + 1, before, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
        found.append((first, after, low, high))
    return [(high - low, first, after) for first, after, low, high in found]


@dataclass
class Model:
    """Token scores, the extreme-value law (lambda, K) and the logistic curve (slope, middle).

    ``rest`` is the table (form, odds) of the scores beyond the ``HEAD`` most frequent, ``hint`` the bitmap of their
    CRC-32; both are None where ``scores`` has them all. The table stays with the driver.
    """

    scores: dict[str, float]
    rate: float
    scale: float
    slope: float = 1.0
    middle: float = 1.0
    rest: DataFrame | None = None
    hint: tuple[np.ndarray, int] | None = None

    def __post_init__(self):
        self.stems = {f[:-2] for f in self.scores if f[-2:-1] == "*"}

    def __getstate__(self):
        return self.__dict__ | {"rest": None}

    def may_score(self, word: str) -> bool:
        return word in self.scores or any(word[:n] in self.stems for n in STEMS if len(word) >= n)

    def passages(self, words: list[str], known: dict[str, bool], rest: dict[str, float] | None = None) -> list[tuple[float, int, int]]:
        """Significant segments: (-log of the E-value, first word, after last word)."""
        _, found = self.scan(words, known, rest)
        if not found:
            return []
        space = math.log(self.scale * len(words))
        return [(e, a, b) for s, a, b in found if (e := self.rate * s - space) > 0]

    def scan(self, words: list[str], known: dict[str, bool],
             rest: dict[str, float] | None = None) -> tuple[list[float], list[tuple[float, int, int]]]:
        """Positive scores of a text's ``words`` and its maximal segments.

        ``known`` remembers for the task which words may score; ``rest`` has the text's scores from the table.
        """
        if len(known) > _FLUSH:
            known.clear()
        distinct = set(words)
        for w in distinct.difference(known):
            known[w] = self.may_score(w)
        may = {w for w in distinct if known[w]}
        get = self.scores.get
        if rest:
            own = Model(rest, self.rate, self.scale)
            may.update(w for w in distinct if own.may_score(w))
            get = lambda f: self.scores.get(f, rest.get(f))
        if not may:
            return [], []
        of: dict[str, float | None] = {}  # by word, from its first place on
        nth: dict[str, int] = {}
        stretches: list[list[tuple[int, float]]] = []  # scored places
        counted: set[str] = set()
        total = peak = last = 0.0
        for i, w in enumerate(words):
            if w not in may:
                continue
            if w not in of:
                score = get(w)
                for n in STEMS:
                    if len(w) >= n:
                        nth[w[:n]] = k = min(NTH, nth.get(w[:n], 0) + 1)
                        score = get(f"{w[:n]}*{k}") if score is None else score
                of[w] = score
            if of[w] is None:
                continue
            now = total + NEUTRAL * (i - last - 1)
            if not stretches or now <= 0 or now <= peak - DROP:
                stretches.append([])
                counted.clear()
                now = peak = 0.0
            elif w in counted:
                continue
            counted.add(w)
            stretches[-1].append((i, of[w]))
            total, last = now + of[w], i
            peak = max(peak, total)
        found = []
        for places in stretches:
            start = places[0][0]
            scores = [NEUTRAL] * (places[-1][0] - start + 1)
            for i, score in places:
                scores[i - start] = score
            found += [(s, a + start, b + start) for s, a, b in segments(scores)]
        return [score for places in stretches for _, score in places], found

    def evidence(self, text: str | None, known: dict[str, bool], rest: dict[str, float] | None = None) -> float:
        return sum(e for e, _, _ in self.passages(tokens(text), known, rest)) if text else 0.0

    def probability(self, evidence: float) -> float:
        x = self.slope * (math.log1p(evidence) - self.middle)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


def _log_odds(toxic: float, clean: float) -> Column:
    """Log-odds ratio of ``a`` and ``b`` under the prior, less its margin of error."""
    prior = PRIOR * (F.col("a") + F.col("b"))
    x, y = F.col("a") + prior, F.col("b") + prior
    all_prior = PRIOR * (toxic + clean)
    delta = F.log(x / F.greatest(F.lit(0.5), toxic + all_prior - x)) - F.log(y / F.greatest(F.lit(0.5), clean + all_prior - y))
    return delta - SURE * F.sqrt(1 / x + 1 / y)


def choose(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """form, a, odds of the significant tokens of ``counts`` (form, a, b); longer forms take their counts out of their stems."""
    def significant(level: DataFrame) -> DataFrame:
        return cut(level.filter(f"a >= {MIN_COUNT}").withColumn("odds", _log_odds(toxic, clean)).filter(f"odds >= {MIN_ODDS}"))

    is_stem = F.substring("form", -2, 1) == "*"
    found = [significant(counts.filter(~is_stem).withColumn("word", F.col("form")).withColumn("nth", F.lit("*1")))]
    for n in STEMS:
        longer = reduce(DataFrame.union, found).filter(F.length("word") >= n)
        taken = longer.groupBy(F.concat(F.substring("word", 1, n), "nth").alias("form")).agg(
            F.sum("a").alias("less_a"), F.sum("b").alias("less_b"))
        left = [F.greatest(F.lit(0), F.col(c) - F.coalesce(f"less_{c}", F.lit(0))).alias(c) for c in "ab"]
        found.append(significant(counts.filter(is_stem & (F.length("form") == n + 2)).join(taken, "form", "left").select(
            "form", *left, F.substring("form", 1, n).alias("word"), F.substring("form", -2, 2).alias("nth"))))
    return reduce(DataFrame.union, found).select("form", "a", "odds")


def law(histogram: dict[float, int]) -> float:
    """lambda: the positive root of sum p exp(lambda s) = 1 over scores and counts."""
    top = max([s for s in histogram if s > 0], default=4.0)
    histogram = histogram | {top: histogram.get(top, 0) + 1, NEUTRAL: histogram.get(NEUTRAL, 0) + 1}
    total = sum(histogram.values())
    low, high = 1e-6, 10.0
    for _ in range(80):
        middle = (low + high) / 2
        if sum(n / total * math.exp(min(700.0, middle * s)) for s, n in histogram.items()) < 1:
            low = middle
        else:
            high = middle
    return low


def curve(binned: dict[tuple[float, int], int]) -> tuple[float, float]:
    """Slope and middle of the logistic curve for counts by (log(1 + evidence), label), by damped Newton steps."""
    x = np.array([k[0] for k in binned])
    y = np.array([k[1] for k in binned], dtype=float)
    n = np.array(list(binned.values()), dtype=float)
    design = np.stack([np.ones_like(x), x], axis=1)
    beta, ridge = np.array([-1.0, 1.0]), np.diag([1e-3, 1e-1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (y - p)) - ridge @ (beta - [-1.0, 1.0])
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    slope = max(float(beta[1]), 1e-3)
    return slope, -float(beta[0]) / slope


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic (0 or 1) of the documents that ``labels`` (doc_id, toxic) covers, written once.

    A doc_id labelled more than once takes the largest label; a text that several labelled documents have
    is one row, with the largest of their labels. Who is who is settled on hashes of the texts; then only the
    texts needed are shuffled, and by the same join at every size.
    """
    prepare(docs.sparkSession)
    labels = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    texts = docs.select("doc_id", F.xxhash64("text").alias("h")).join(labels, "doc_id").groupBy("h").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    keys = cut(texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("key", F.xxhash64("doc_id")))
    held = docs.sparkSession.sparkContext.broadcast(key_filter(keys, "key", keys.count()))

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_filter(*held.value, b.column("key").to_numpy().view(np.uint64))))

    docs = docs.withColumn("key", F.xxhash64("doc_id")).mapInArrow(covered, "doc_id long, text string, key long")
    return cut(docs.join(keys.select("doc_id", "toxic").hint("merge"), "doc_id").select("text", "toxic"))


def _with_rest(texts: DataFrame, model: Model) -> DataFrame:
    """``texts`` with ``rest``: the scores from the model's table that each text's tokens may need, or null."""
    if model.rest is None:
        return texts.withColumn("rest", F.lit(None).cast("map<string, double>"))
    held = texts.sparkSession.sparkContext.broadcast(model)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        bitmap, bits = held.value.hint

        def forms(word: str) -> list[str]:
            made = [word, *(f"{word[:n]}*{k + 1}" for n in STEMS if len(word) >= n for k in range(NTH))]
            sums = np.array([zlib.crc32(f.encode()) for f in made], dtype=np.uint64)
            return [f for f, there in zip(made, in_filter(bitmap, bits, sums)) if there]

        for b in batches:
            ids, out = [], []
            if len(known) > _FLUSH:
                known.clear()
            for h, text in zip(b.column("h").to_pylist(), b.column("text").to_pylist()):
                words = set(tokens(text))
                known.update((w, forms(w)) for w in words.difference(known))
                mine = {f for w in words for f in known[w]}
                ids += [h] * len(mine)
                out += mine
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], ["h", "form"])

    # texts of one hash share the map: it is looked up by form, so one too many in it changes nothing
    texts = texts.withColumn("h", F.xxhash64("text"))
    met = texts.select("h", "text").filter("text is not null").mapInArrow(wanted, "h long, form string").distinct().join(
        model.rest, "form").groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("form", "odds"))).alias("rest"))
    return texts.join(met, "h", "left").drop("h")


def _rests(batch: pa.RecordBatch) -> list[dict[str, float] | None]:
    return [r and dict(r) for r in batch.column("rest").to_pylist()]


def fit(train: DataFrame) -> Model:
    """Learn from ``train`` (text, toxic). Without toxic or without clean rows every score is low."""
    prepare(train.sparkSession)
    sc = train.sparkSession.sparkContext
    train = train.select("text", F.col("toxic").cast("int").alias("toxic")).filter("text is not null and toxic is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            held = list(words[0].keys() | words[1].keys())
            made = [pa.array(held, pa.string()), *(pa.array([words[y][f] for f in held], pa.int64()) for y in (1, 0))]
            for c in words:
                c.clear()
            return pa.RecordBatch.from_arrays(made, ["form", "a", "b"])

        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                found = set(tokens(text))
                words[label].update(found)
                for n in STEMS:
                    for stem, c in Counter([w[:n] for w in found if len(w) >= n]).items():
                        words[label].update([f"{stem}*{k + 1}" for k in range(min(c, NTH))])
                words[label][""] += 1  # documents
                if len(words[0]) + len(words[1]) > _FLUSH:
                    yield out()
        yield out()

    counted = cut(train.mapInArrow(count, "form string, a long, b long").groupBy("form").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")).filter(f"form = '' or a >= {MIN_COUNT}"))
    totals = counted.filter("form = ''").first()
    toxic, clean = (totals["a"], totals["b"]) if totals else (0, 0)
    if not toxic or not clean:
        return Model({}, 1.0, 1.0, 1.0, 5.0)
    found = choose(counted.filter("form <> ''"), toxic, clean)
    head = found.orderBy(F.desc("a"), "form").limit(HEAD + 1).collect()
    model = Model({r["form"]: r["odds"] for r in head[:HEAD]}, 1.0, 1.0)
    if len(head) > HEAD:
        last = head[HEAD - 1]
        beyond = (F.col("a") < last["a"]) | ((F.col("a") == last["a"]) & (F.col("form") > last["form"]))
        model.rest = cut(found.filter(beyond).select("form", "odds"))
        keys = model.rest.withColumn("key", F.crc32(F.col("form").cast("binary")))
        model.hint = key_filter(keys, "key", keys.count())
        train = cut(_with_rest(train, model))
    else:
        train = _with_rest(train, model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Clean documents' token scores (kind 0) and best segments (kind 1: documents, kind 2: their tokens)."""
        known: dict[str, bool] = {}
        held: Counter = Counter()
        for b in batches:
            for text, label, rest in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), _rests(b)):
                words = tokens(text)
                if label or not words:
                    continue
                scores, parts = first.value.scan(words, known, rest)
                held.update((0, round(s, 2)) for s in scores)
                held[0, NEUTRAL] += len(words) - len(scores)
                best = round(max((s for s, _, _ in parts), default=0.0), 1)
                held[1, best] += 1
                held[2, best] += len(words)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.float64()),
             pa.array(held.values(), pa.int64())], ["kind", "x", "n"])

    first = sc.broadcast(model)
    sums = train.mapInArrow(measure, "kind int, x double, n long").groupBy("kind", "x").agg(F.sum("n").alias("n")).collect()
    model.rate = law({r["x"]: r["n"] for r in sums if r["kind"] == 0})
    events = sum(r["n"] for r in sums if r["kind"] == 1 and r["x"] > 0) or 1
    model.scale = events / max(1.0, sum(r["n"] * math.exp(-model.rate * r["x"]) for r in sums if r["kind"] == 2))

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        held: Counter = Counter()
        for b in batches:
            for text, label, rest in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), _rests(b)):
                held[round(math.log1p(second.value.evidence(text, known, rest)), 1), label] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.float64()), pa.array([k[1] for k in held], pa.int32()),
             pa.array(held.values(), pa.int64())], ["x", "label", "n"])

    second = sc.broadcast(model)
    bins = train.mapInArrow(evidence, "x double, label int, n long").groupBy("x", "label").agg(F.sum("n").alias("n")).collect()
    model.slope, model.middle = curve({(r["x"], r["label"]): r["n"] for r in bins})
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and passages (array of evidence, start, stop in words), one row per row of ``docs``.

    A null or empty text has no passage and the curve's lowest score. Other columns play no part.
    """
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("evidence", pa.float64()), ("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        m = held.value
        for b in batches:
            found = [m.passages(tokens(t), known, r) if t else [] for t, r in zip(b.column("text").to_pylist(), _rests(b))]
            scores = np.array([m.probability(sum(e for e, _, _ in f)) for f in found], dtype=np.float64)
            spans = [[{"evidence": e, "start": a, "stop": z} for e, a, z in f] for f in found]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                                              pa.array(spans, kind)], ["doc_id", "score", "predicted", "passages"])

    return _with_rest(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).mapInArrow(
        run, "doc_id long, score double, predicted int, passages array<struct<evidence: double, start: int, stop: int>>")
