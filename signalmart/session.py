"""Session construction and the shared work folder.

Everything that writes intermediate data (landed CSV, stream sinks,
checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``. We only pick our own folder when that setting is
unset *and* Spark runs in local mode (tests, bench); on a cluster an unset
checkpoint dir is a configuration error, because a machine-local temp folder
is invisible to the other executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the library assumes. None of them changes results; they
# shape the physical plan (AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed ones).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def _master_from_launcher() -> bool:
    """True when spark-submit (or a running context) already decides the
    master: then we must not override it with a local one."""
    from pyspark import SparkContext
    return SparkContext._active_spark_context is not None or \
        "PYSPARK_GATEWAY_PORT" in os.environ


def get_spark(master: str | None = None, app: str = "signalmart",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    master = master or os.environ.get("SIGNALMART_MASTER")
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    elif not _master_from_launcher():
        b = b.master("local[*]")  # plain `python` run with nothing configured
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:  # already set (Spark has appended its per-application folder)
        return current
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every "
                "executor can reach (HDFS, S3, ...) before running signalmart jobs")
        root = tempfile.mkdtemp(prefix="signalmart-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_conf(spark: SparkSession, **settings):
    """Temporarily set runtime SQL confs (dots written as '__')."""
    keys = {k.replace("__", "."): str(v) for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
