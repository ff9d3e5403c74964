"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fincrime.session import ensure_checkpoint_dir

# A word, everywhere in this package: a run of anything but blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, so a lost executor costs a reread and not the work
    before.  The read back table has a known size, so Spark broadcasts it in a
    join only below ``spark.sql.autoBroadcastJoinThreshold`` and sorts and
    merges beyond, where adaptive execution splits a hot key."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
