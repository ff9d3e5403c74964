"""A hot key (one match key holding most of the ledger) is split across
tasks by AQE's skew-join handling; no pair is lost."""

from decimal import Decimal

from pyspark.sql import functions as F

from fincrime.operators import contra_entry_match, latest_per_key


def _final_plan(df) -> tuple[str, int]:
    """Run through the DataFrame's own query execution, then read its final
    adaptive plan."""
    n = len(df.collect())
    return df._jdf.queryExecution().executedPlan().toString(), n


def test_hot_contra_key_is_split(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 4000
        ids = spark.range(n)
        hot = F.col("id") < n * 0.8  # 80% of credits on one (date, time, journal, amount)
        credits = ids.select(
            (F.col("id") + 10_000).alias("accountkey"), (F.col("id") + 10_000).alias("clientkey"),
            F.when(hot, F.lit(Decimal("100.00"))).otherwise((F.col("id") % 50 + 1).cast("decimal(18,2)"))
             .cast("decimal(18,2)").alias("transactionamount"),
            F.lit(20240101).alias("transactiondatekey"),
            F.when(hot, F.lit(9)).otherwise(F.col("id") % 7).alias("timekey"),
            F.when(hot, F.lit("HOT")).otherwise((F.col("id") % 13).cast("string")).alias("journalnumber"),
            F.lit(10).alias("transactionindicatorskey"))
        debits = spark.range(3).select(
            F.col("id").alias("accountkey"), F.col("id").alias("clientkey"),
            F.lit(Decimal("-100.00")).cast("decimal(18,2)").alias("transactionamount"),
            F.lit(20240101).alias("transactiondatekey"), F.lit(9).cast("bigint").alias("timekey"),
            F.lit("HOT").alias("journalnumber"), F.lit(50).alias("transactionindicatorskey"))
        ledger = credits.unionByName(debits).repartition(16)
        flagged = debits.select("accountkey")
        pairs = contra_entry_match(ledger, flagged,
                                   keys=("transactiondatekey", "timekey", "journalnumber"))
        plan, rows = _final_plan(pairs)
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan, plan[:2000]
        assert rows == int(n * 0.8) * 3  # every pair kept
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_top1_is_limited_before_shuffle(spark):
    # 90% of rows on one key: the partial WindowGroupLimit keeps at most one
    # row per key per map task, so the shuffle carries few rows for it
    df = spark.range(20000).select(F.when(F.col("id") < 18000, 0).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("t")).repartition(8)
    top = latest_per_key(df, ["k"], ["t"], ties=[])
    assert top.filter("k = 0").collect()[0]["t"] == 17999
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
