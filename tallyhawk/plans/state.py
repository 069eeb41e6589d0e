"""Warehouse storage on plain parquet, published atomically per day.

Layout under ``root`` (any Hadoop file system)::

    epoch=<e>/<table>/load_day=<d>/v=<n>/           facts, report and rejects of one input day
    epoch=<e>/dims/<name>/v=<n>/is_open=<b>/        a dimension version, split open / closed rows
    epoch=<e>/blacklist/v=<n>/                      blacklist snapshot, version n
    log/c<n>.json                                   one commit

A day's facts, report and rejects are filed under the input file's day,
whatever the dates of the rows, and are read only through the versions that
the log lists for that day, so a corrected day replaces exactly what it wrote
before. Dimension versions are immutable: a day reads one version and writes
a new one. Each is partitioned by ``is_open``; the history at version n is its
open rows plus the closed rows of every version listed in its commit
(``closed_versions``): a strict day merges only the open rows and adds its
newly closed rows as one more closed partition.

A day becomes visible only with its commit, one small file created without
overwriting, as the last step. A second writer that wants the same number
fails there. A crash before it leaves the previous state; one while it is
written leaves a file without all its rows, which readers skip and the next
commit numbers past. There is one writer at a time: a failed attempt's version
folders are overwritten by the next. A full reset (the reference's "drop all
tables") starts a new epoch instead of deleting anything.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.schemas import DIMENSIONS, FACT_TRANSACTIONS, INITIAL_WATERMARK, OPEN_END, REPORT

LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("kind", T.StringType()),          # run | backfill | compact | reset
    T.StructField("day", T.DateType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("max_update_dt", T.DateType()),
    T.StructField("committed_at", T.StringType()),
    T.StructField("versions", T.ArrayType(T.LongType())),  # closed versions; live versions of a load day
    T.StructField("open_rows", T.LongType()),       # current rows, counted while written
    T.StructField("rows", T.LongType()),            # rows of the whole commit
])

FACTS, REPORTS, REJECTS = "fact_transactions", "report", "rejects"
BY_DAY = {FACTS: FACT_TRANSACTIONS, REPORTS: REPORT,
          REJECTS: T.StructType([*FACT_TRANSACTIONS.fields, T.StructField("_reject", T.StringType()),
                                 T.StructField("_amount_text", T.StringType())])}
TABLES = [*DIMENSIONS, "blacklist"]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._state = None

    # -- commit log ------------------------------------------------------------------
    def _log(self) -> list:
        """All rows of complete commits, in order: about ten a loaded day."""
        path = f"{self.root}/log"
        if not self._exists(path):
            return []
        rows = self.spark.read.schema(LOG_SCHEMA).json(path).collect()
        held: dict[int, list] = {}
        for r in rows:
            if r["seq"] is not None:
                held.setdefault(r["seq"], []).append(r)
        return [r for seq in sorted(held) for r in held[seq] if len(held[seq]) == r["rows"]]

    @staticmethod
    def _state_of(log: list) -> dict:
        """Last commit's epoch, day and tables, and the live versions of every load day of the epoch."""
        st = {"seq": 0, "epoch": 0, "day": None, "kind": None, "tables": {}, "days": {t: {} for t in BY_DAY}}
        for r in log:
            if r["seq"] != st["seq"]:
                if r["epoch"] != st["epoch"]:
                    st["days"] = {t: {} for t in BY_DAY}
                st |= {"seq": r["seq"], "epoch": r["epoch"], "day": None, "kind": r["kind"], "tables": {}}
            if r["table_name"] not in BY_DAY:
                st["day"] = r["day"]
            if r["table_name"] in BY_DAY:
                st["days"][r["table_name"]][r["day"]] = list(r["versions"] or [])
            elif r["table_name"]:
                st["tables"][r["table_name"]] = (r["version"], r["max_update_dt"], list(r["versions"] or []), r["open_rows"])
        return st

    def state(self) -> dict:
        """The last commit: seq, epoch, day, per table its version and watermark, per load day its versions."""
        if self._state is None:
            self._state = self._state_of(self._log())
        return self._state

    def before(self, day: _dt.date) -> Warehouse:
        """The warehouse as it was before ``day`` was first loaded, to load that day again."""
        log, epoch = self._log(), self.state()["epoch"]
        old = Warehouse(self.spark, self.root)
        old._state = self._state_of([]) | {"epoch": epoch}
        for seq in sorted({r["seq"] for r in log}, reverse=True):
            st = self._state_of([r for r in log if r["seq"] <= seq])
            if st["epoch"] != epoch:
                break
            if st["day"] is None or st["day"] < day:
                old._state = st
                break
            if st["kind"] == "backfill" and any(d < day for ds in st["days"].values() for d in ds):
                raise ValueError(f"{day} was loaded with earlier days at once; there is no state before it to go back to")
        return old

    def next_version(self) -> int:
        """Number of the next commit and its folders: past every commit file, complete or not."""
        path, fs = self._fs(f"{self.root}/log")
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return max([int(n[1:10]) for n in names if n.startswith("c")], default=0) + 1

    def watermark(self, table: str) -> _dt.date:
        v = self.state()["tables"].get(table)
        return v[1] if v and v[1] is not None else INITIAL_WATERMARK

    def version(self, table: str) -> int | None:
        v = self.state()["tables"].get(table)
        return v[0] if v else None

    def closed_versions(self, table: str) -> list[int]:
        v = self.state()["tables"].get(table)
        return list(v[2]) if v else []

    def open_rows(self, table: str) -> int | None:
        """Rows of the table's current version that are open, as counted when it was written."""
        v = self.state()["tables"].get(table)
        return v[3] if v else None

    def commit(self, day: _dt.date | None, tables: dict[str, tuple], kind: str = "run", epoch: int | None = None,
               days: dict[str, list[int] | dict[_dt.date, list[int]]] | None = None, seq: int | None = None) -> int:
        """Publish a day. ``tables``: name -> (version, watermark[, closed versions[, open rows]]).

        ``days``: the live versions of this load day's facts, report and rejects, or of several load days. ``seq``: the number the
        caller took from :meth:`next_version`; another writer's commit of that number makes this one fail.
        """
        seq = self.next_version() if seq is None else seq
        head = {"seq": seq, "epoch": self.state()["epoch"] if epoch is None else epoch, "kind": kind,
                "day": day and day.isoformat(), "committed_at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
        rows = []
        for name, spec in tables.items():
            version, mark, closed, open_rows = (tuple(spec) + (None, None))[:4]
            rows.append(head | {"table_name": name, "version": version, "max_update_dt": mark and mark.isoformat(),
                                "versions": closed, "open_rows": open_rows})
        for t, v in (days or {}).items():
            rows += [head | {"day": d and d.isoformat(), "table_name": t, "versions": x}
                     for d, x in (v if isinstance(v, dict) else {day: v}).items()]
        return self._publish(seq, rows or [head])

    def _publish(self, seq: int, rows: list[dict]) -> int:
        text = "".join(json.dumps(r | {"rows": len(rows)}) + "\n" for r in rows)
        path, fs = self._fs(f"{self.root}/log/c{seq:09d}.json")
        try:
            out = fs.create(path, False)
        except Exception as e:
            raise FileExistsError(f"commit {seq} exists already (another writer?)") from e
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._state = None
        return seq

    def rewind(self, old: dict, dropped: set[_dt.date]) -> int:
        """Publish an earlier state again, without the ``dropped`` load days."""
        seq = self.next_version()
        head = {"seq": seq, "epoch": old["epoch"], "kind": "rewind", "committed_at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
        day = old["day"] and old["day"].isoformat()
        rows = [head | {"day": day, "table_name": t, "version": v, "max_update_dt": m and m.isoformat(), "versions": c, "open_rows": n}
                for t, (v, m, c, n) in old["tables"].items()]
        rows += [head | {"day": d.isoformat(), "table_name": t, "versions": []} for t in BY_DAY for d in sorted(dropped)]
        return self._publish(seq, rows or [head | {"day": day}])

    # -- paths ---------------------------------------------------------------------------
    def epoch_root(self, epoch: int | None = None) -> str:
        return f"{self.root}/epoch={self.state()['epoch'] if epoch is None else epoch}"

    def day_path(self, table: str, day: _dt.date, version: int) -> str:
        return f"{self.epoch_root()}/{table}/load_day={day}/v={version}"

    def table_path(self, table: str, version: int) -> str:
        base = "blacklist" if table == "blacklist" else f"dims/{table}"
        return f"{self.epoch_root()}/{base}/v={version}"

    # -- reads ----------------------------------------------------------------------------
    def read_table(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        v = self.version(table)
        if v is None:
            return None
        return self.spark.read.parquet(self.table_path(table, v))

    def write_history(self, table: str, version: int, hist: DataFrame) -> int:
        """Write a dimension version split by ``is_open`` (one job); returns its open row count."""
        from pyspark.sql import Observation
        open_now = (F.col("effective_to") == F.lit(OPEN_END)) & (F.col("deleted_flg") == F.lit(False))
        obs = Observation(f"{table}_rows")
        (hist.withColumn("is_open", F.coalesce(open_now, F.lit(False)))
             .observe(obs, F.count(F.when(F.col("is_open"), 1)).alias("open_rows"))
             .write.mode("overwrite").partitionBy("is_open").parquet(self.table_path(table, version)))
        return int(obs.get.get("open_rows", 0))

    def read_history(self, table: str, open_only: bool = False, version: int | None = None,
                     closed: list[int] | None = None) -> DataFrame | None:
        """A dimension's history (or only its open rows) at the committed version."""
        v = self.version(table) if version is None else version
        if v is None:
            return None
        fields = DIMENSIONS[table][2].fields
        cols = [f.name for f in fields]
        schema = T.StructType([*fields, T.StructField("is_open", T.BooleanType())])
        out = self.spark.read.schema(schema).parquet(self.table_path(table, v)) \
            .filter(F.col("is_open")).select(*cols)
        if not open_only:
            chain = self.closed_versions(table) if closed is None else closed
            leaves = [f"{self.table_path(table, k)}/is_open=false" for k in chain]
            leaves = [p for p in leaves if self._exists(p)]      # a day may close nothing
            if leaves:
                root = self.table_path(table, 0).rsplit("/", 1)[0]
                closed_schema = T.StructType([*fields, T.StructField("v", T.LongType()),
                                              T.StructField("is_open", T.BooleanType())])
                old = (self.spark.read.schema(closed_schema).option("basePath", root)
                       .parquet(*leaves).select(*cols))
                out = out.unionByName(old)
        return out

    def write_load_days(self, table: str, df: DataFrame, version: int, partition_col: str | None = None) -> None:
        """Write one version of several load days' rows, told apart by ``df``'s column load_day, in one job."""
        cols = ["load_day", "v", *([partition_col] if partition_col else [])]
        (df.withColumn("v", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*cols).parquet(f"{self.epoch_root()}/{table}"))

    def written_days(self, table: str, load_days: list[_dt.date], version: int) -> dict[_dt.date, list[int]]:
        """The load days that have rows in ``version``, with it as their live version."""
        return {d: [version] for d in load_days if self._exists(self.day_path(table, d, version))}

    def read_days(self, table: str, load_days: list[_dt.date] | None = None,
                  pending: tuple[_dt.date, list[int]] | dict[_dt.date, list[int]] | None = None) -> DataFrame:
        """Facts, report or rejects of all (or the given) load days: their live versions alone.

        ``pending``: versions of a load day, or of several, that are not committed yet.
        """
        live = dict(self.state()["days"][table])
        if pending:
            live |= pending if isinstance(pending, dict) else dict([pending])
        paths = [self.day_path(table, d, v) for d, vs in sorted(live.items()) for v in vs
                 if load_days is None or d in load_days]
        schema = BY_DAY[table]
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = T.StructType([*schema.fields, T.StructField("load_day", T.DateType()), T.StructField("v", T.LongType())])
        return (self.spark.read.schema(read).option("basePath", f"{self.epoch_root()}/{table}").parquet(*paths)
                .select(*schema.fieldNames()))

    def read_facts(self, day: _dt.date | None = None, pending: tuple[_dt.date, list[int]] | None = None) -> DataFrame:
        """All facts, or those whose operation is of ``day`` (a partition filter), from whichever file."""
        df = self.read_days(FACTS, pending=pending)
        return df if day is None else df.filter(F.col("trans_day") == F.lit(day))

    def read_report(self) -> DataFrame:
        return self.read_days(REPORTS)

    # -- maintenance --------------------------------------------------------------------------
    def vacuum(self, keep_commits: int = 7) -> list[str]:
        """Delete version folders that none of the last ``keep_commits`` commits refers to.

        Dimension, blacklist and chain versions of the current epoch are kept
        when a recent commit names them (as its version or, for strict
        histories, as a closed partition it still reads); so are the live and
        recent versions of each load day's facts, report and rejects. Older
        epochs (before a reset) are removed whole. Returns the deleted paths.
        """
        log = self._log()
        last = self.state()["seq"]
        live = {(t, d, v) for t, ds in self.state()["days"].items() for d, vs in ds.items() for v in vs}
        keep: set[tuple[str, int]] = set()
        for r in log:
            if r["seq"] <= last - keep_commits:
                continue
            if r["table_name"] in BY_DAY:
                live |= {(r["table_name"], r["day"], v) for v in r["versions"] or []}
            elif r["table_name"] is not None and r["version"] is not None:
                keep |= {(r["table_name"], v) for v in [r["version"], *(r["versions"] or [])]} | {("chain", r["version"])}
        epoch = self.state()["epoch"]
        deleted = []
        root, fs = self._fs(self.root)
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("epoch=") and name != f"epoch={epoch}":
                fs.delete(st.getPath(), True)
                deleted.append(st.getPath().toString())
        folders = [(t, f"dims/{t}") for t in DIMENSIONS] + [("blacklist", "blacklist"), ("chain", "chain")]
        for table, sub in folders:
            base, _ = self._fs(f"{self.epoch_root()}/{sub}")
            if not fs.exists(base):
                continue
            for st in fs.listStatus(base):
                name = st.getPath().getName()
                if name.startswith("v=") and (table, int(name[2:])) not in keep:
                    fs.delete(st.getPath(), True)
                    deleted.append(st.getPath().toString())
        for table in BY_DAY:
            base, _ = self._fs(f"{self.epoch_root()}/{table}")
            for of_day in fs.listStatus(base) if fs.exists(base) else []:
                day = of_day.getPath().getName().removeprefix("load_day=")
                for st in fs.listStatus(of_day.getPath()):
                    name = st.getPath().getName()
                    if name.startswith("v=") and (table, _dt.date.fromisoformat(day), int(name[2:])) not in live:
                        fs.delete(st.getPath(), True)
                        deleted.append(st.getPath().toString())
        return deleted

    # -- file system ------------------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return bool(fs.exists(p))
