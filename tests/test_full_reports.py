"""The ten full reports on the warehouse derived from the driver tables:
they validate, run, and plan without Cartesian products."""

import pytest

from conftest import SF_SMALL

from fincrime.plans.full_reports import FULL_REPORTS
from fincrime.sources.derived_warehouse import warehouse_from_driver


WIDTHS = {"full_aml": 27, "full_employer": 56, "full_contra": 18, "full_missed_fraud": 19,
          "full_client_lookup": 13, "full_case_lookup": 6, "full_arrears": 28, "full_card_search": 13,
          "full_incidents": 15, "full_tollgate": 32}


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_from_driver(spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(FULL_REPORTS))
def test_full_report_runs(wh, name):
    df = FULL_REPORTS[name](wh)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert len(df.columns) == WIDTHS[name]
    assert all(len(r) == WIDTHS[name] for r in df.collect())
