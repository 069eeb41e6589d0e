"""Source divergence audit: how far the vocabulary of each source lies from the other sources of its language.

Terms are counted by Arrow compute functions inside the tasks (``ascii_lower``, ``split_pattern_regex``,
``dictionary_encode``, hash ``group_by``): a task merges its batches and hands on partial counts, which Spark adds
up. The counts are then dealt into shards of terms. A shard is a columnar block, one row for each source and one
column for each term, of at most ``SHARD_CELLS`` numbers whatever the vocabulary; it adds up its terms' divergences
for each pair of sources, and the sums of the shards are added by Spark. No pair is made for a single term.

All numbers are integers and every division is floored, so the result does not depend on the order of summing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import combined, cut, prepare
from tallyhawk.llm.text import slices

#: What lies between terms: all of ASCII but its letters, lower-cased before.
BETWEEN = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: A probability of one, before the one that is added.
SCALE = 1_000_000_000
#: Numbers in the block of a shard.
SHARD_CELLS = 1 << 16

_COUNTS = "lang string, source string, term string, n long, docs long"


def count_batch(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Terms of one batch: lang, source, term, n (occurrences) and docs (rows with the term)."""
    words = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    term = pc.list_flatten(words).dictionary_encode()
    row = pc.list_parent_indices(words)
    there = pc.greater(pc.binary_length(term.dictionary), 0).take(term.indices)  # a split at an end leaves an empty one
    found = pa.table({"row": row, "code": term.indices}).filter(there)
    found = found.group_by(["row", "code"]).aggregate([([], "count_all")])
    found = pa.table({"lang": lang.take(found["row"]), "source": source.take(found["row"]), "code": found["code"], "n": found["count_all"]})
    found = found.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ("n", "count")])
    return pa.table({"lang": found["lang"], "source": found["source"], "term": term.dictionary.take(found["code"].combine_chunks()),
                     "n": found["n_sum"], "docs": found["n_count"]})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = (count_batch(b.column("lang")[lo:hi], b.column("source")[lo:hi], b.column("text")[lo:hi])
            for b in batches for lo, hi, _, _ in slices(b.column("text")))
    yield from combined(made, ["lang", "source", "term"], ["n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs of ``docs`` (lang, source, text); null counts as ''."""
    prepare(docs.sparkSession)
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return docs.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, terms: str):
    """Smoothed share of ``n`` in ``total`` with ``terms`` kept terms, in units of 1 / SCALE; exact beyond 64 bits."""
    return F.expr(f"1 + (cast({SCALE} as decimal(38,0)) * (cast({n} as decimal(20,0)) + 2)) div "
                  f"(cast({total} as decimal(20,0)) + 2 * cast({terms} as decimal(20,0)))")


def _pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over one shard's terms, for each pair of the language's sources."""
    base = rows[rows["term"].isna()].sort_values("source")
    cells = rows[rows["term"].notna()]
    sources = base["source"].tolist()
    code, terms = pd.factorize(cells["term"])
    block = np.repeat(base["p"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    block[pd.Index(sources).get_indexer(cells["source"]), code] = cells["p"].to_numpy(np.int64)
    parts = []
    for i in range(len(sources) - 1):
        p, q = block[i], block[i + 1:]
        parts.append(pd.DataFrame({"source": sources[i], "item": sources[i + 1:],
                                   "value": ((p - q) * (p - q) // (p + q)).sum(axis=1)}))
    found = pd.concat(parts) if parts else pd.DataFrame({"source": [], "item": [], "value": []}, dtype=object)
    found.insert(0, "lang", rows["lang"].iloc[0])
    return found


def source_divergence(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value (long), rank (int, from 1) for ``docs`` (text, lang, source, other columns ignored).

    A language keeps the terms that at least ``least_docs`` of its rows hold. Part ``pair``: every other source of the
    language with the divergence summed over all kept terms. Part ``term``: the ``top`` kept terms that the source uses
    more than its language does. Ranks follow the value downward, ties the item upward (byte order). Null text, lang
    and source count as ''; each row is a document, also one that repeats another or has no id. A source without terms
    has its pairs; a source alone in its language has none. An empty table gives no rows. Texts of any length count
    as a whole.
    """
    counts = cut(term_counts(docs))
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("lang_n")) \
        .filter(F.col("d") >= least_docs).drop("d")
    cells = cut(counts.join(kept, ["lang", "term"]))
    # sizes: a row a source, not a row a term
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cut(groups.join(sizes, ["lang", "source"], "left").fillna(0, ["total"]))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("sources")).join(
        cells.groupBy("lang").agg(F.count_distinct("term").alias("terms")), "lang", "left").fillna(0, ["terms"])
    shards = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / F.lit(SHARD_CELLS))).cast("int")
    groups = cut(groups.join(langs.withColumn("shards", shards), "lang").withColumn(
        "base", F.when(F.col("terms") > 0, _share("0", "total", "terms")).otherwise(F.lit(1))))

    cells = cut(cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "total", "terms").alias("p"), _share("lang_n", "lang_total", "terms").alias("q"),
        F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard")))
    base = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"),
                         F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    half = cells.drop("q").unionByName(base).groupBy("lang", "shard").applyInPandas(
        _pairs, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = half.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"),
                       "value").select("lang", "x.source", "x.item", "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    over = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    return pair.union(over.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))
