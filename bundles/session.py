"""Session helpers: a tuned local session for tests and a shared scratch area."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "bundles", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  On a cluster the caller's session wins."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is used as is.  Unset, a local session gets a fresh
    folder of its own; any other session is an error, since executors would
    write to their own disks.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="bundles-ckpt-", dir=os.environ.get("BUNDLES_SCRATCH", "/tmp"))
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_path_of(spark: SparkSession, name: str, inputs: list[str]) -> str:
    """The path under the shared folder that belongs to these input files: it changes when a file, its size or its time does."""
    sc = spark.sparkContext
    told = []
    for path in inputs:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(at)
        told += sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in files)
    return f"{checkpoint_root(spark)}/{name}-{hashlib.sha256(repr(told).encode()).hexdigest()[:16]}"


def materialize(df, spark: SparkSession | None = None, name: str = "stage"):
    """Cut lineage by writing parquet to the shared folder and reading it back.

    Survives executor loss (the files live on shared storage), unlike
    ``localCheckpoint``.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop_table(df) -> None:
    """Remove the files of a frame that ``materialize`` returned, once nothing reads them any more."""
    sc = df.sparkSession.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
