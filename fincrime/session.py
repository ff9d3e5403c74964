"""Session construction and lineage cutting.

The library never builds a session on its own inside an operator: every
operator takes DataFrames and returns DataFrames.  ``build_session`` is for
scripts, tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins from real shuffle sizes
# (size-checked broadcast, sort-merge fallback), coalesces small partitions
# and splits skewed ones, so a hot key never lands in a single task.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.caseSensitive": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fincrime", extra: dict | None = None) -> SparkSession:
    """Session with the scale settings; UI off (no server is opened)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's checkpoint folder.  Only where none is set a scratch one is
    made, and only in a local session (tests, the bench): executors of a cluster
    don't share a machine's folders, so there it raises.  Never overrides a
    configured one."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not fallback:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; executors of a cluster need a shared folder")
        fallback = tempfile.mkdtemp(prefix="fincrime-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def new_shared_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the configured shared folder.

    Raises if no checkpoint folder is configured: a machine-local fallback
    would not survive the loss of the executor that wrote it.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir is not set; cannot cut lineage safely")
        spark.sparkContext.setCheckpointDir(d)
    return df.checkpoint(eager=True)
