"""Every keyed query equals its DuckDB oracle (order-insensitive) on sf0.001,
and the report keys also on sf0.01 (the driver's check size)."""

import pytest

from harness import compare, duck
from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as entry_mod
from fincrime.plans import oracle, registry

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def con_check():
    return duck(SF_CHECK)


def test_every_key_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_key_matches_oracle_small(spark, con_small, name):
    ok, n, _, detail = compare(spark, con_small, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, detail


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k.startswith(("report_", "full_"))))
def test_report_key_matches_oracle_check_size(spark, con_check, name):
    ok, n, _, detail = compare(spark, con_check, name, QUERIES[name], ORACLE[name], SF_CHECK)
    assert ok, detail
    assert n > 0


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == entry_mod.entry(spark).columns
