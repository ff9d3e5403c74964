"""Exactness of the plan rewrites the reports rely on (random frames)."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from fincrime.operators import dedup

rows_l = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]), st.integers(0, 2)),
                  max_size=25)
rows_c = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y"]), st.integers(0, 1)),
                  max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_l, rows_c)
def test_distinct_pushed_below_fan_out_join(spark, left, right):
    # arrears: DISTINCT over (loan side x outcome side per client) equals the
    # join of the two DISTINCT sides when the client key is in both outputs
    L = spark.createDataFrame(left, "k int, a string, b int")
    C = spark.createDataFrame(right, "ck int, x string, y int")
    whole = dedup(L.join(C, L.k == C.ck))
    pushed = dedup(L).join(dedup(C), L.k == C.ck)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, pushed.collect()), key=str)
