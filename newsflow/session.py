"""Session construction and cluster-wide settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every newsflow job relies on: UTC day arithmetic, adaptive
# execution (runtime coalescing and skew-join splitting), Arrow for the
# model hooks.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # page bodies in windows-125x, koi8, Shift_JIS, ... decode on the JVM
    "spark.sql.legacy.javaCharsets": "true",
    # ... and a malformed byte there is replaced instead of ending the job
    "spark.sql.legacy.codingErrorAction": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "newsflow") -> SparkSession:
    """Return the active session, or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("NEWSFLOW_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; set one only where it is unset.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    left alone.  Only an unset session (local tests, bench) gets a fresh
    scratch folder of its own.
    """
    value = checkpoint_dir(spark)
    if value:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(value)
        return value
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    value = tempfile.mkdtemp(prefix="newsflow-ckpt-")
    spark.sparkContext.setCheckpointDir(value)
    return value


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint, which keeps blocks
    on the executors that computed them).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored_frame(df):
    """``df`` written into the shared checkpoint folder as compressed Parquet and read back.

    Cuts the lineage like ``cut_lineage``; a reader opens only the columns it takes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/newsflow/frame-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
