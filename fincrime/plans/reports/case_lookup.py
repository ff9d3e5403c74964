"""Case folders of identity numbers created after an instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime.operators import semi_join_keys
from fincrime.plans.reports.common import ts_ntz
from fincrime.sources.catalog import Warehouse

COLUMNS = ["case_id", "case_creation_date", "case_client_surname", "case_id_passport_no",
           "case_client_first_name", "serving_consultant_cp_no"]
REQUIRED = {"case_folder": COLUMNS}


def case_lookup(wh: Warehouse, id_numbers: Sequence[str] | DataFrame, created_after) -> DataFrame:
    """Folders whose creation time is strictly after ``created_after``."""
    wh.validate(REQUIRED)
    cf = wh["case_folder"].filter(F.col("case_creation_date") > ts_ntz(created_after))
    return semi_join_keys(cf, "case_id_passport_no", id_numbers).select(*COLUMNS)
