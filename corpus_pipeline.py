"""From raw documents to packed training sequences.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's
documents, the last one the packed pieces. Each stage works on all that the one before kept. Between
stages the rows are written as Parquet in the cluster's shared folder and read again, so a lost executor
costs some tasks of one stage. Nulls, empty texts, repeated rows and extra columns are treated as the
operators' docstrings say; a stage returns the columns of documents. An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm import dedup, jaccard, language, packing, substring
from tallyhawk.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or far from every language go. The model learns from the rows with a lang.

    Ids are not looked at: rows that repeat an id or have none are judged each by its text.
    """
    model = language.fit(docs)
    return language.identify(docs.select(*COLUMNS), model).filter("not rejected").select(*COLUMNS)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows of the (doc_id, text_key) in ``dropped``; an id may be null or name several texts.

    The names are written first: where they are few, Spark knows it and leaves the texts where they are.
    """
    gone = materialize(dropped.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "pipeline")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    return docs.select(*COLUMNS).join(gone, same, "left_anti")


def _once(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row of each (doc_id, text_key) in ``repeated``, the others of ``docs`` as they are.

    Rows are combined in the tasks that read them, so a row that repeats in a third of the table meets no one task.
    """
    names = materialize(repeated.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "pipeline")
    if names.isEmpty():
        return docs.select(*COLUMNS)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    rest = [c for c in COLUMNS if c != "doc_id"]
    one = docs.join(names, same, "left_semi").groupBy("doc_id", F.xxhash64("text").alias("_key")).agg(F.min(F.struct(*rest)).alias("_row"))
    return docs.join(names, same, "left_anti").select(*COLUMNS).union(one.select("doc_id", "_row.*").select(*COLUMNS))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal after lower-casing A-Z one row stays: of the largest doc_id (a null one is the smallest).

    Where that id has several of the group's texts, that with the smallest text_key stays; of repeated rows one.
    """
    found = materialize(dedup.exact_dedup(docs).filter("group_size > 1"), "pipeline")
    best = found.filter("kept").groupBy("text_sha256").agg(F.min("text_key").alias("best"))
    dropped = found.join(best, "text_sha256").filter("not kept or text_key <> best")
    repeated = found.filter("kept").groupBy("doc_id", "text_key").count().filter("count > 1")
    return _once(_without(docs, dropped), repeated)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by a Jaccard similarity of at least 0.8 on five-word shingles, the smallest doc_id's text stays.

    A row without doc_id stays only where no other of its group has one; texts without words all stay.
    """
    return _without(docs, jaccard.jaccard_components(docs, shingle=5, percent=80).filter("not kept"))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 13-word windows that a document of smaller doc_id has too go; other texts stay as they are.

    A missing doc_id is later than all others; rows that share an id, or have none, are one document.
    """
    found = substring.without_repeats(docs.select(*COLUMNS), window=13)
    return found.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))) \
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))) \
        .select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed into sequences of at most 2048 ids; every row has its own pieces."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048), 2048)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", remove_repeated_passages),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language models and packing have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None
