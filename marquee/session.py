"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that hold for every job in this package.  AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splitting protects the
# per-event aggregations when one event (or one issue) carries a large share
# of the rows.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "marquee") -> SparkSession:
    """Return (or create) the session used by tests, bench and the driver."""
    master = master or os.environ.get("MARQUEE_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster the setting names a shared folder (HDFS/S3/...), which we
    never override.  Only local runs (tests, bench) get a fresh temp folder; on a
    cluster without the setting the job stops, as executors share no local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="marquee-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)   # a local run's tables end with it
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
