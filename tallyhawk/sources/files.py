"""Input files: delimited transactions, snapshot files, picking and archiving.

A "file" named ``transactions_DDMMYYYY.txt`` may be a single file or a
directory of part files (what Spark writes); both read the same way.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.functions.scalars import day_from_name, decimal_comma
from tallyhawk.schemas import (
    BLACKLIST_FILE,
    FILE_KINDS,
    KIND_TRANSACTIONS,
    REFERENCE,
    STRICT,
    TERMINALS_FILE,
    TRANSACTIONS_FILE,
)

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


class BadRowsError(ValueError):
    pass


# --- transactions ------------------------------------------------------------------

CORRUPT = "_corrupt"
#: The file's columns and the whole line of a row with another number of fields.
RAW_TRANSACTIONS = T.StructType([*TRANSACTIONS_FILE.fields, T.StructField(CORRUPT, T.StringType())])
#: A row's fields are only counted where no column is pruned from the parser.
RAW_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}


def read_transactions_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The ``;``-separated file as text columns (explicit schema, no inference)."""
    return (spark.read.schema(RAW_TRANSACTIONS).option("sep", ";").option("header", True)
            .options(**RAW_OPTIONS).csv(path))


def parse_transactions(raw: DataFrame, *more: str) -> DataFrame:
    """Typed fact rows plus ``_reject`` (NULL for good rows, else the reason); columns ``more`` of ``raw`` stay."""
    ts = F.try_to_timestamp(F.trim(F.col("transaction_date")), F.lit(TS_FORMAT)).cast("timestamp_ntz")
    amt = decimal_comma("amount")
    fields = F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields"))
    reject = (fields.when(F.col("transaction_id").isNull(), F.lit("missing id"))
               .when(ts.isNull(), F.lit("bad transaction_date"))
               .when(amt.isNull(), F.lit("bad amount"))
               .when(F.col("card_num").isNull(), F.lit("missing card")))
    return raw.select(
        F.col("transaction_id").alias("trans_id"),
        ts.alias("trans_date"),
        amt.alias("amt"),
        F.col("card_num"),
        F.col("oper_type"),
        F.col("oper_result"),
        F.col("terminal"),
        F.to_date(ts).alias("trans_day"),
        reject.alias("_reject"),
        F.coalesce(CORRUPT, "amount").alias("_amount_text"),
        *more,
    )


def scan_transactions(spark: SparkSession, path: str | list[str], on_bad: str = "reject") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows). ``on_bad="fail"`` raises when any row is bad (the reference's load fails)."""
    parsed = parse_transactions(read_transactions_raw(spark, path))
    good = parsed.filter(F.col("_reject").isNull()).drop("_reject", "_amount_text")
    bad = parsed.filter(F.col("_reject").isNotNull())
    if on_bad == "fail":
        first = bad.select("_reject", "_amount_text").limit(1).collect()
        if first:
            raise BadRowsError(f"bad transaction row: {first[0]['_reject']} ({first[0]['_amount_text']!r})")
    return good, bad


# --- snapshots -----------------------------------------------------------------------

def read_snapshot(spark: SparkSession, path: str, schema, sep: str = ";") -> DataFrame:
    """A full snapshot file: ``.xlsx`` through the Excel job, else delimited text or parquet."""
    lower = path.lower().rstrip("/")
    if lower.endswith(".xlsx"):
        from tallyhawk.sources.excel import read_xlsx
        return read_xlsx(spark, path, schema)
    if lower.endswith(".parquet"):
        return spark.read.parquet(path).select(*schema.fieldNames())
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def read_terminals(spark: SparkSession, path: str) -> DataFrame:
    df = read_snapshot(spark, path, TERMINALS_FILE)
    return df.select(*[F.trim(F.col(c)).alias(c) for c in TERMINALS_FILE.fieldNames()])


def read_blacklist(spark: SparkSession, path: str) -> DataFrame:
    """Blacklist snapshot: (entry date, passport) -> passport_num, entry_dt."""
    df = read_snapshot(spark, path, BLACKLIST_FILE)
    d = F.trim(F.col("date"))
    entry = F.coalesce(F.try_to_timestamp(d, F.lit("yyyy-MM-dd HH:mm:ss")),
                       F.try_to_timestamp(d, F.lit("yyyy-MM-dd"))).cast("date")
    return df.select(F.trim(F.col("passport")).alias("passport_num"), entry.alias("entry_dt"))


# --- file names ------------------------------------------------------------------------

def list_inputs(spark: SparkSession, input_dir: str) -> DataFrame:
    """Names directly inside ``input_dir`` (files or dataset directories) with kind and day.

    Listing is metadata only: it runs through Hadoop's FileSystem so any
    cluster file system works.
    """
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(input_dir)
    fs = p.getFileSystem(hconf)
    rows = []
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith((".", "_")):
                continue
            rows.append((name, st.getPath().toString()))
    return classify_names(spark.createDataFrame(rows, "name string, path string"))


def classify_names(names: DataFrame, name_col: str = "name") -> DataFrame:
    """Add ``kind`` (first matching kind substring) and ``day`` (parsed from the name)."""
    kind = F.lit(None).cast("string")
    for k in reversed(FILE_KINDS):
        kind = F.when(F.col(name_col).contains(k), F.lit(k)).otherwise(kind)
    return names.withColumn("kind", kind).withColumn("day", day_from_name(name_col))


def choose_files(listing: DataFrame, semantics: str = STRICT) -> DataFrame:
    """The files to load next (columns kind, name, path, day).

    reference: one row per kind; names sorted as text, first match per kind,
    kinds picked independently -- ``01042021`` sorts before ``02032021`` and a
    missing kind pairs files of different days.
    strict: every file of the earliest parsed day, however many a kind has and
    whether or not it has every kind.
    """
    files = listing.filter(F.col("kind").isNotNull())
    if semantics == REFERENCE:
        first = F.min_by(F.struct("name", "path", "day"), F.col("name"))
        return files.groupBy("kind").agg(first.alias("f")).select("kind", "f.name", "f.path", "f.day")
    earliest = files.agg(F.min("day").alias("day"))
    return files.join(F.broadcast(earliest), "day", "left_semi").select("kind", "name", "path", "day")


def pick_files(spark: SparkSession, input_dir: str, semantics: str = STRICT) -> dict:
    """The next day's inputs as ``{"day": date, "days": {kind: date}, kind: path, ...}``; transactions: a list.

    ``day`` is the terminals file's day, used for the dimensions (Q8); the
    report uses the transactions file's day. They differ only when reference
    picking pairs files of different days. ``{}`` when nothing is left. Under
    strict a day with several transactions files takes them all; a second
    snapshot of one kind for one day is an error, as either could be meant.
    """
    rows = choose_files(list_inputs(spark, input_dir), semantics).orderBy("name").collect()   # one day's names
    if not rows:
        return {}
    out: dict = {"days": {r["kind"]: r["day"] for r in rows}}
    for r in rows:
        if r["kind"] == KIND_TRANSACTIONS:
            out.setdefault(KIND_TRANSACTIONS, []).append(r["path"])
        elif r["kind"] in out:
            raise ValueError(f"two {r['kind']} files for {r['day']}: {out[r['kind']]}, {r['path']}")
        else:
            out[r["kind"]] = r["path"]
    out["day"] = out["days"].get("terminals", rows[0]["day"])
    return out


def archive_files(spark: SparkSession, paths: list[str], archive_dir: str, suffix: str = ".backup") -> list[str]:
    """Move consumed inputs to ``archive_dir/<name><suffix>`` (a rename on the cluster file system).

    An earlier backup of the name (of a day that was corrected) is kept under a number, which restoring ignores.
    """
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    adir = Path(archive_dir)
    fs = adir.getFileSystem(hconf)
    fs.mkdirs(adir)
    moved = []
    for src in paths:
        sp = Path(src)
        dst = Path(adir, sp.getName() + suffix)
        if fs.exists(dst):
            n = 1
            while fs.exists(Path(adir, f"{dst.getName()}.{n}")):
                n += 1
            fs.rename(dst, Path(adir, f"{dst.getName()}.{n}"))
        if not fs.rename(sp, dst):
            raise OSError(f"could not archive {src} -> {dst}")
        moved.append(dst.toString())
    return moved


def restore_files(spark: SparkSession, archive_dir: str, input_dir: str, suffix: str = ".backup",
                  since: _dt.date | None = None) -> list[str]:
    """Move archived inputs back, dropping the suffix (the first step of a replay); with ``since`` that day's and later ones."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    adir, idir = Path(archive_dir), Path(input_dir)
    fs = adir.getFileSystem(hconf)
    fs.mkdirs(idir)
    moved = []
    if not fs.exists(adir):
        return moved
    for st in fs.listStatus(adir):
        name = st.getPath().getName()
        if not name.endswith(suffix):
            continue
        if since is not None and (found := re.search(r"_(\d{8})\.[^./]+$", name[: -len(suffix)])) and \
                _dt.datetime.strptime(found[1], "%d%m%Y").date() < since:
            continue
        dst = Path(idir, name[: -len(suffix)])
        if not fs.rename(st.getPath(), dst):
            raise OSError(f"could not restore {name}")
        moved.append(dst.toString())
    return moved


def day_name(day: _dt.date) -> str:
    return day.strftime("%d%m%Y")
