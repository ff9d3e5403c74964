"""Per-call context of a keyed query: driver tables plus derived views."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fincrime.sources.driver import DriverTables
from fincrime.sources.fixtures import Fixtures


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = DriverTables(spark, sf_dir)
        self.fx = Fixtures(self.t)


def ts_lit(text: str):
    """Zone-less timestamp literal (the driver's timestamps are NTZ)."""
    return F.lit(text).cast("timestamp_ntz")


def d(text: str) -> _dt.date:
    return _dt.date.fromisoformat(text)
