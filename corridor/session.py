"""Session helper: UTC clock, AQE on, UI off, and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query in this package relies on. ``session.timeZone`` is a
# semantic setting (hour/day-of-week are taken in UTC); the rest are tuning.
_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "corridor", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate on an existing session ignores builder conf for SQL keys;
    # set the semantic one explicitly.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The configured folder is used as is. Only a local-mode session (tests,
    single-machine runs) may get a scratch folder when none is set; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at the cluster's shared folder")
    d = tempfile.mkdtemp(prefix="corridor-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared checkpoint folder; Spark's file system deletes it when the session ends."""
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path
