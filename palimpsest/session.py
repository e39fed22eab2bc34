"""Spark session helpers.

Everything here is plain session configuration: adaptive execution on,
UTC session time zone (the SQL oracle is time-zone naive), the UI off.
On a cluster the session already exists and is returned untouched except
for the checkpoint directory, which is only set when the cluster left it
unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Size partitions so that a 1000-executor cluster reading 100 TB gets
    # ~128 MB splits; the local default of 8 shuffle partitions is set by
    # the caller (tests, bench).
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "palimpsest", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is
    unset on a ``local`` master do we pick a scratch folder of our own; on a
    cluster an unset one is an error, as executors couldn't see that folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="palimpsest-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the session's own file system layer."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for files of this application; the
    application's folder is deleted when its driver ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/palimpsest-work/{spark.sparkContext.applicationId}"
    fs, p = hadoop_path(spark, root)
    if not fs.exists(p):
        fs.mkdirs(p)
    fs.deleteOnExit(p)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (a cluster that ships it with --py-files finds it there as well)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
