"""Sources and sinks: partition pruning of the newest snapshot, report writer."""

import os
import tempfile

from pyspark.sql import functions as F

from fincrime.operators import latest_snapshot
from fincrime.sources.catalog import Warehouse
from fincrime.sources.sinks import write_report


def test_newest_snapshot_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="fincrime-test-part-")
    df = spark.range(3000).select((F.lit(20240101) + F.col("id") % 3).cast("int").alias("coveragedatekey"),
                                  F.col("id").alias("accountkey"))
    df.write.mode("overwrite").partitionBy("coveragedatekey").parquet(f"{root}/fact")
    wh = Warehouse.from_parquet_root(spark, root)
    newest = latest_snapshot(wh["fact"], "coveragedatekey")
    rows = newest.collect()
    assert {r.coveragedatekey for r in rows} == {20240103} and len(rows) == 1000
    plan = newest._jdf.queryExecution().executedPlan().toString()
    # the newest key is a runtime partition filter of the fact scan: only the
    # newest partition's files are listed and read
    assert "PartitionFilters: [isnotnull(coveragedatekey" in plan
    assert "= Subquery subquery" in plan


def test_write_report_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="fincrime-test-out-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write_report(df, f"{out}/p")
    write_report(df, f"{out}/c", fmt="csv")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{out}/p").collect()) == [(1, "a"), (2, "b")]
    back = spark.read.option("header", "true").csv(f"{out}/c")
    assert back.columns == ["k", "v"] and back.count() == 2
    assert any(n.endswith(".csv") for n in os.listdir(f"{out}/c"))


def test_catalogue_on_uri_root_maps_declared_names(spark):
    wh = Warehouse.from_parquet_root(spark, "s3a://bucket/warehouse/", names=["dimclient", "factclient"])
    assert wh.has("core.DIMCLIENT") and wh.has("factclient") and not wh.has("dimcard")
    assert wh._sources["dimclient"] == "s3a://bucket/warehouse/dimclient"
    wh_all = Warehouse.from_parquet_root(spark, "hdfs://nn/warehouse")
    assert wh_all.has("vwpost_tran_leg_internal") and wh_all.has("vwfacttransaction")
