"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's features are the byte n-grams (1 to 3) of its lower-cased letters, runs of other characters
being one space, hashed into ``FEATURES`` buckets. Term frequencies are dampened by a square root,
weighted by the inverse document frequency over all training documents and normalised. Each language
has several centroids: spherical k-means over a bounded sample of its training documents
(``SAMPLE`` a language, those with the smallest hash). A text takes the language of the centroid with
the largest cosine; it is rejected if it has no letter or is too far from every centroid. How far is
too far depends on a text's length, as short texts hold few n-grams and lie far out: the sample's texts
and stretches of them of doubling length are measured against their language's centroids, and a text is
rejected below ``SLACK`` times the ``QUANTILE`` of those of about its number of n-grams. Noise, texts of
languages that are not learned and texts of a few words over and over lie below it.

Fitting: one pass for the document frequencies, whose partial counts are summed by Spark, one for the
sample, one for its vectors, which are clustered in a task a language; the driver gets the centroids.
Predictions are one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, give_back, prepare, tidied

FEATURES = 1 << 13
SAMPLE = 400
CENTROIDS = 4
SLACK = 0.85
QUANTILE = 0.01
#: Letters of the stretches that are measured.
STRETCHES = tuple(1 << i for i in range(4, 13))
#: Texts or stretches a quantile is taken of.
ENOUGH = 20
#: Distances are kept by the logarithm of the number of n-grams.
LENGTHS = 32
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """The letters of a text, lower-cased, what lies between them being one space."""
    found = _OTHER.sub(" ", text.lower()).strip()
    if found and not found.replace(" ", "").isalpha():  # numerals and the like that are no digits
        found = " ".join("".join(c if c.isalpha() else " " for c in found).split())
    return found


def counts_of(found: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of :func:`letters`; None without any."""
    if not found:
        return None
    b = np.frombuffer(f" {found} ".encode(), dtype=np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(256) + b[1:]
    three = two[:-1] * np.uint32(256) + b[2:]
    hashed = [(g + np.uint32(n << 26)) * np.uint32(2654435761) >> np.uint32(32 - 13) for n, g in ((1, b), (2, two), (3, three))]
    return np.bincount(np.concatenate(hashed), minlength=FEATURES)


def term_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of a text's letters; None without a letter."""
    return counts_of(letters(text))


def length_class(counts: np.ndarray) -> int:
    return min(LENGTHS, int(counts.sum()).bit_length()) - 1


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts) * idf
    norm = np.sqrt(v @ v)
    return v / norm if norm else v


@dataclass
class Model:
    """``names[i]`` is the language of ``centroids[i]``; ``nearest`` the least cosine by language and length class."""

    names: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    nearest: dict[str, list[float]]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine to its nearest centroid (0 to 1), whether the text is rejected."""
        counts = term_counts(text) if text else None
        if counts is None or not self.names:
            return "und", 0.0, True
        cosines = self.centroids @ vector(counts, self.idf)
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.names[best], score, score < self.nearest[self.names[best]][length_class(counts)]


def cluster(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from evenly spread seeds: the farthest from those chosen before, first the mean's nearest."""
    mean = vectors.sum(axis=0)
    chosen = [int(np.argmax(vectors @ mean))]
    nearest = vectors @ vectors[chosen[0]]
    for _ in range(min(k, len(vectors)) - 1):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen].copy()
    for _ in range(rounds):
        label = np.argmax(vectors @ centres.T, axis=1)
        for c in range(len(centres)):
            total = vectors[label == c].sum(axis=0)
            norm = np.sqrt(total @ total)
            if norm:
                centres[c] = total / norm
    return centres


def fit(train: DataFrame) -> Model:
    """Learn from ``train`` (text, lang); rows with a null lang or no letter teach nothing, repeated texts of a language once.

    Every value of lang with a letter in its texts is learned; texts of any length count as a whole. Without rows
    nothing is learned and every text is ``und``.
    """
    prepare(train.sparkSession)
    train = train.select("text", "lang").filter("lang is not null and text is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(FEATURES + 1, dtype=np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                if (c := term_counts(t)) is not None:
                    total[:-1] += c > 0
                    docs += 1
        total[-1] = docs
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(total)], ["feature", "n"])

    counted = train.select("text").mapInArrow(tidied(frequencies), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df = np.zeros(FEATURES + 1)
    for r in counted.collect():  # FEATURES + 1 rows
        df[r["feature"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1e-3

    # the texts with the smallest hashes of each language: a share of the hashes that holds some times as many, then exactly
    texts = train.select("lang", F.xxhash64("text").alias("h"), F.octet_length("text").alias("n"))
    share = cut(texts.groupBy("lang").agg((F.lit(8.0 * SAMPLE) / F.count("*")).alias("share")))
    few = texts.join(share, "lang").filter(F.shiftrightunsigned("h", 33) < F.col("share") * (1 << 31)).select("lang", "h", "n").distinct()
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 33), "h", "n")
    sample = cut(few.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= SAMPLE).select("lang", "h").distinct())

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, t, h in zip(*(b.column(c).to_pylist() for c in ("lang", "text", "h")), strict=True):
                whole = letters(t)
                parts = [(0, whole)] + [(n, whole[(at := h % (len(whole) - n)):at + n]) for n in STRETCHES if n < len(whole)]
                for n, part in parts:
                    if (c := counts_of(part.strip())) is not None:
                        at = np.flatnonzero(c)
                        out.append((lang, h, n, at.astype("<u2").tobytes(), c[at].astype("<u8").tobytes()))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], ["lang", "h", "part", "at", "c"])

    # a language's sample is bounded: SAMPLE texts and their stretches
    held = train.sparkSession.sparkContext.broadcast(idf)
    rows = train.withColumn("h", F.xxhash64("text")).join(sample, ["lang", "h"], "left_semi") \
        .mapInArrow(tidied(sampled), "lang string, h long, part int, at binary, c binary") \
        .groupBy("lang", "h", "part").agg(F.min(F.struct("at", "c")).alias("v")).select("lang", "h", "part", "v.*")

    def learned(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "part"])
        texts = rows[rows["part"] == 0]
        centres = cluster(np.stack([vector(_dense(a, c), held.value) for a, c in zip(texts["at"], texts["c"])]).astype(np.float32), CENTROIDS)
        seen: list[list[float]] = [[] for _ in range(LENGTHS)]
        for a, c in zip(rows["at"], rows["c"]):  # one at a time: together the stretches take some hundred MB
            counts = _dense(a, c)
            seen[length_class(counts)].append(float((centres @ vector(counts, held.value)).max()))
        give_back()
        enough = min(ENOUGH, max(map(len, seen)))  # of a length; other lengths take the nearest one's
        least = {i: SLACK * float(np.quantile(x, QUANTILE)) for i, x in enumerate(seen) if len(x) >= enough}
        least = [least[min(least, key=lambda k: (abs(k - i), k))] for i in range(LENGTHS)]
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "centres": [centres.tobytes()], "nearest": [least]})

    found = sorted(rows.groupBy("lang").applyInPandas(learned, "lang string, centres binary, nearest array<double>").collect())
    centres = [np.frombuffer(r["centres"], np.float32).reshape(-1, FEATURES) for r in found]
    return Model([r["lang"] for r, c in zip(found, centres) for _ in c],
                 np.concatenate(centres) if centres else np.zeros((0, FEATURES), np.float32),
                 idf.astype(np.float32), {r["lang"]: r["nearest"] for r in found})


def _dense(at: bytes, counts: bytes) -> np.ndarray:
    out = np.zeros(FEATURES)
    out[np.frombuffer(at, "<u2")] = np.frombuffer(counts, "<u8")
    return out


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the doc_id as text leaves ``remainder``; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text and any other columns) with lang_pred, lang_score and rejected, replacing such columns.

    A null text or one without a letter is "und", score 0, rejected. Whole texts are read; lang, source and
    doc_id play no part, so rows that repeat a text or an id are judged alike. Of languages at the same cosine
    the first in order of name is taken. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("lang_pred", "lang_score", "rejected")
    held = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [held.value.predict(t) for t in b.column("text").to_pylist()]
            made = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, "lang_pred", "lang_score", "rejected"])

    return docs.mapInArrow(tidied(run), f"{fields}, lang_pred string, lang_score double, rejected boolean")
