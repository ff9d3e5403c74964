"""Plan-shape checks: what Catalyst produces for the keyed queries."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry_mod

QUERIES = entry_mod.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["latest_per_key", "first_per_key", "report_incidents",
                                  "report_contra", "report_arrears"])
def test_top1_uses_window_group_limit(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in p
    assert "Partial" in p  # limited before the shuffle as well as after


def test_filters_reach_the_scan(spark):
    p = plan_of(QUERIES["filter_eq"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,MACHINERY)]" in p
    p = plan_of(QUERIES["filter_day"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p  # sargable day range
    p = plan_of(QUERIES["filter_between"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in p


def test_column_pruning(spark):
    p = plan_of(QUERIES["filter_eq"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p


def test_latest_snapshot_is_a_scalar_subquery(spark):
    df = QUERIES["latest_snapshot"](spark, SF_SMALL)
    p = plan_of(df)
    assert "Subquery" in p and "Exchange hashpartitioning" not in p  # no shuffle of the fact


def test_inline_relation_broadcast(spark):
    p = plan_of(QUERIES["inline_relation"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_contra_match_is_hash_partitioned_on_all_keys(spark):
    p = plan_of(QUERIES["contra_entry"](spark, SF_SMALL))
    assert "SortMergeJoin [transactiondate" in p or "BroadcastHashJoin [transactiondate" in p
    assert "cast(credit_amount" not in p  # the negated key keeps its decimal type
