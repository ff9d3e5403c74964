"""All keyed queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from fincrime.plans import full_oracle, full_reports
from fincrime.plans.context import Ctx
from fincrime.plans.operator_keys import OPERATOR_KEYS
from fincrime.plans.report_keys import REPORT_KEYS


def _wrap(f) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(Ctx(spark, sf_dir))
    run.__name__ = f.__name__
    run.__doc__ = f.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _wrap(f) for k, f in OPERATOR_KEYS.items()}
    out.update({k: _wrap(f) for k, f in REPORT_KEYS.items()})
    out.update({k: partial(full_reports.run, k) for k in full_oracle.REPORTS})
    return out
