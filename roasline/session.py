"""Session helpers shared by the bench, the tests and the plans."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults of a session that this module starts itself on a local master, for keys that nobody set.
# A session that runs already, and any cluster master, keep their own settings.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "roasline", **conf: str) -> SparkSession:
    """The active session as it is, or a new one: `conf` always, local defaults on a local master only."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        given = SparkConf()
        where = master or given.get("spark.master", "local[*]")
        builder = SparkSession.builder.appName(app).master(where)
        defaults = {k: v for k, v in LOCAL_DEFAULTS.items() if not given.contains(k)} if where.startswith("local[") or where == "local" else {}
        for key, value in {**defaults, **conf}.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark) or spark.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(spark)
    return spark


LIBRARY_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def tell_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where it lies, whatever folder the driver runs in."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if LIBRARY_ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([LIBRARY_ROOT, *filter(None, known)])


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's checkpoint folder, for tables that cut a lineage."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_folder`` named."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting is used as is.  Only
    on a local master, where it may be unset (tests), a scratch folder is made; elsewhere a folder
    that other machines cannot see would lose checkpoints, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="roasline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
