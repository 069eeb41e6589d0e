"""Session construction and the shared scratch location.

On a cluster the session is handed to us; we only read its settings. The
builder here is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Defaults for local runs. On a cluster these come from spark-defaults.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "tallyhawk", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master or "local[8]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one JVM."""
    return spark.sparkContext.master.split("[")[0] == "local"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyhawk_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyhawk-ship-"), "tallyhawk.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._tallyhawk_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    and the master is local (tests) do we create our own folder: elsewhere a
    temporary folder would be another one on each machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or None
    sc = spark.sparkContext
    if not base:
        existing = sc.getCheckpointDir()
        if existing:
            base = existing
    if not base:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tallyhawk-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local on a cluster).

    It is removed when the application ends.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df, name: str = "stage"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage with one job (``checkpoint()`` would compute the plan twice:
    once for its count and once to write, unless the frame is persisted).
    Survives executor loss: the files are on the cluster's shared file system.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
