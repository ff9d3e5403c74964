"""Balanced row numbering equals the window's row_number: hot key, null keys,
null and equal orders, and values that no other representation may touch."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fincrime.operators import number_rows
from fincrime.operators import numbering
from fincrime.operators.numbering import global_rank


def same(df, keys, order, ties, ascending):
    got = number_rows(df, keys, order, ties=ties, ascending=ascending)
    cols = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in [*order, *ties]]
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*cols)))
    assert got.schema == want.schema or [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan and "InMemory" not in plan


@pytest.mark.parametrize("seed,ascending", [(1, True), (2, False)])
def test_balanced_equals_window(spark, seed, ascending):
    rnd = random.Random(seed)
    rows = []
    for i in range(3000):
        k = 0 if rnd.random() < 0.6 else rnd.choice([1, 2, None, 4])
        rows.append((k, rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randint(0, 50)]), i))
    df = spark.createDataFrame(rows, "k int, g string, t int, id bigint")
    for keys in (["k"], ["k", "g"]):
        same(df, keys, ["t"], ["id"], ascending)


@pytest.mark.parametrize("ascending", [True, False])
def test_every_value_is_kept(spark, ascending):
    big, end = 2 ** 53, dt.datetime(9999, 12, 31)
    rows = [(big + i % 3 if i % 5 else None, big + i, float("nan") if i % 4 else 1.5, end if i % 2 else None, i)
            for i in range(200)]
    df = spark.createDataFrame(rows, "k bigint, v bigint, x double, t timestamp_ntz, id int")
    same(df, ["k"], ["t"], ["id"], ascending)
    same(df, ["k"], ["x"], ["id"], ascending)
    same(df, ["k", "v"], ["id"], [], ascending)


def test_hot_key_spread_over_buckets(spark):
    df = spark.range(20000).select(F.when(F.col("id") < 15000, 0).otherwise(F.col("id") % 10 + 1).alias("k"),
                                   (F.col("id") % 100).alias("t"), "id")
    out = number_rows(df, ["k"], ["t"], ties=["id"], ascending=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__bucket" in plan           # no window over all rows is by the key alone
    assert out.filter("k = 0").agg(F.max("rn")).first()[0] == 15000


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(numbering, "ROWS", 100)
    monkeypatch.setattr(numbering, "SAMPLE", 3000)


def ranges(df) -> int:
    """Groups of the window that numbers rows: ranges of hot keys and the other keys."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "__bucket" in plan
    return plan.count("__bucket")


def test_constant_first_column_is_cut_by_the_next(spark, small_ranges):
    rows = [(0, "same", i % 7 if i % 11 else None, i) for i in range(4000)] + [(k, "same", 1, k) for k in range(1, 50)]
    df = spark.createDataFrame(rows, "k int, a string, b int, id int")
    out = number_rows(df, ["k"], ["a", "b"], ties=["id"], ascending=True)
    assert ranges(out)
    same(df, ["k"], ["a", "b"], ["id"], True)
    same(df, ["k"], ["a", "b"], ["id"], False)
    found = numbering._splits(df, ["k"], [(F.col("a"), True), (F.col("b"), True), (F.col("id"), True)], 4049, 1).collect()
    assert [r["k0"] for r in found] == [0] and 20 <= len(found[0]["__splits"]) <= numbering.SAMPLE // 4


def test_mixed_directions_and_values_without_order(spark, small_ranges):
    rnd = random.Random(8)
    rows = [(rnd.choice([0, 0, 0, 1, None]), rnd.choice([None, float("nan"), -0.0, 0.0, 2.5]), rnd.choice(["x", "y", None]), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, x double, s string, id int")
    got = number_rows(df, ["k"], [("x", False)], ties=[("s", True), ("id", False)])
    assert ranges(got)
    w = Window.partitionBy("k").orderBy(F.col("x").desc_nulls_last(), F.col("s").asc_nulls_last(), F.col("id").desc_nulls_last())
    want = df.withColumn("rn", F.row_number().over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_sample_of_another_table_steers_balance_only(spark, small_ranges):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.col("id"))
    other = spark.range(500).select(F.lit(1).alias("k"), (F.col("id") * 3).alias("id"))
    out = number_rows(df, ["k"], ["id"], ties=[], ascending=True, sample_of=other)
    assert ranges(out) and out.filter("rn <> id + 1").count() == 0 and out.count() == 2000


@pytest.mark.parametrize("ascending", [True, False])
def test_global_rank_is_the_row_number_over_everything(spark, small_ranges, ascending):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, rnd.randint(0, 40)]), rnd.choice("ab"), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v int, s string, id int")
    out = global_rank(df, [("v", ascending), ("s", not ascending), ("id", True)])
    key = lambda r: (r[0] is None, (r[0] or 0) * (1 if ascending else -1), ord(r[1]) * (-1 if ascending else 1), r[2])
    want = {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=key))}
    got = {r["id"]: r["rank"] for r in out.collect()}
    assert got == want and dict(out.dtypes)["rank"] == "bigint"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_global_rank_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(2,), (1,)], "v int")
    assert sorted(tuple(r) for r in global_rank(df, [("v", True)]).collect()) == [(1, 1), (2, 2)]
    assert global_rank(df.limit(0), [("v", True)]).count() == 0
    assert number_rows(df.limit(0), ["v"], ["v"], ties=[]).count() == 0


def test_cost_of_a_row_does_not_grow_with_the_cuts(spark, small_ranges):
    # a row halves the list of cuts; it is neither compared with each of them nor given a copy of them
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), "id")
    for out in (number_rows(df, ["k"], ["id"], ties=[], ascending=True), global_rank(df, [("id", True)])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "__bucket" in plan and "filter(" not in plan and "__splits" not in plan
    assert global_rank(df, [("id", True)]).filter("rank <> id + 1").count() == 0


def test_cuts_of_days_instants_and_bytes(spark, small_ranges):
    rows = [(i % 2, dt.date(2020, 1, 1 + i % 28), dt.datetime(2020, 3, 1 + i % 28, i % 24, i % 60), bytes([i % 251, 255]), i)
            for i in range(3000)] + [(None, None, None, None, i) for i in range(3000, 4000)]
    df = spark.createDataFrame(rows, "k int, d date, t timestamp, b binary, id int")
    for keys, order in ((["k"], ["d", "t", "b"]), (["k"], ["t"]), (["d"], ["b", "t"]), (["k", "b"], ["d"])):
        same(df, keys, order, ["id"], True)
        same(df, keys, order, ["id"], False)


def test_ranges_of_a_large_table_are_bounded(spark, small_ranges, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS", 1)
    monkeypatch.setattr(numbering, "RANGES", 30)
    found = numbering._splits(spark.range(3000), [], [(F.col("id"), True)], 3000, 1).collect()
    assert 20 <= len(found[0]["__splits"]) <= 31
    assert global_rank(spark.range(3000), [("id", False)]).filter("rank <> 3000 - id").count() == 0
