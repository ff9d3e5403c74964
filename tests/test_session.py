"""Lineage helpers: reliable checkpoints in the session's configured folder."""

import os

from pyspark.sql import functions as F

from fincrime.session import SCALE_CONF, checkpoint_dir, cut_lineage, ensure_checkpoint_dir


def test_configured_checkpoint_dir_is_kept(spark):
    d = checkpoint_dir(spark)
    assert d  # set by the test session because none was configured
    assert ensure_checkpoint_dir(spark, "/tmp/should-not-be-used") == d


def test_cut_lineage_writes_to_the_shared_folder(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    cut = cut_lineage(df)
    assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in df.collect())
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # the lineage above the checkpoint is gone
    root = checkpoint_dir(spark).replace("file:", "")
    assert any(os.scandir(root))  # files were written to the configured folder


def test_scale_settings():
    assert SCALE_CONF["spark.sql.adaptive.enabled"] == "true"
    assert SCALE_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
