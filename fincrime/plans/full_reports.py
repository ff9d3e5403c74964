"""The ten full reports run on the warehouse derived from the driver tables.

Search inputs are DataFrames derived from the same tables (a whole segment of
clients, accounts or cards at once), so the work grows with the data.
Used by the bench and by smoke tests; correctness of the layouts is checked
by the golden tests, and the report shapes against the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fincrime.operators import latest_snapshot, scd2_current
from fincrime.plans import reports as R
from fincrime.plans.reports.common import ts_ntz
from fincrime.sources.catalog import Warehouse
from fincrime.sources.derived_warehouse import warehouse_from_driver


def _clients_in_segment(wh: Warehouse, segment: str) -> DataFrame:
    return scd2_current(wh["dimclient"]).filter(F.col("lastname") == segment)


def _accounts_of_segment(wh: Warehouse, segment: str) -> DataFrame:
    cif = _clients_in_segment(wh, segment).select(F.col("cifnumber").alias("__c"))
    acc = scd2_current(wh["dimaccount"])
    return acc.join(cif, acc["clientnumber"] == cif["__c"], "left_semi")


def _primary_accounts_of_segment(wh: Warehouse, segment: str) -> DataFrame:
    cif = _clients_in_segment(wh, segment).select(F.col("cifnumber").alias("__c"))
    fc = latest_snapshot(wh["factclient"], "clientsnapshotdatekey")
    return fc.join(cif, fc["cifnumber"] == cif["__c"], "left_semi").select("primarydepositaccountnumber")


def aml(wh: Warehouse) -> DataFrame:
    acc = _accounts_of_segment(wh, "MACHINERY").filter(F.col("accountstatusname") == "F")
    return R.aml_evidence(wh, acc.select("accountnumberwithcheckdigit"), as_of="2024-07-15")


def employer(wh: Warehouse) -> DataFrame:
    # every employer of one industry, and the newest accounts of one status: numbers of both kinds
    emp = scd2_current(wh["dimemployer"]).filter(F.col("employerindustrytypename") == "EUROPE")
    acc = scd2_current(wh["dimaccount"]).filter((F.col("accountstatusname") == "P")
                                                & (F.col("accountopendate") >= ts_ntz("2001-06-01 00:00:00")))
    return R.employer_accounts(wh, emp.select("employernumberwithcheckdigit")
                               .union(acc.select("accountnumberwithcheckdigit")))


def contra(wh: Warehouse) -> DataFrame:
    return R.staff_from_stopped(wh, "STAFF", as_of="1999-01-31")


def missed_fraud(wh: Warehouse) -> DataFrame:
    return R.missed_fraud(wh, "1998-09-30")


def client_lookup(wh: Warehouse) -> DataFrame:
    return R.client_lookup(wh, _primary_accounts_of_segment(wh, "BUILDING"))


def case_lookup(wh: Warehouse) -> DataFrame:
    ids = _clients_in_segment(wh, "AUTOMOBILE").select("partyidentifiertypenumber")
    return R.case_lookup(wh, ids, "1998-01-01 00:00:00")


def arrears(wh: Warehouse) -> DataFrame:
    pda = _primary_accounts_of_segment(wh, "HOUSEHOLD")
    acc = scd2_current(wh["dimaccount"]).join(
        pda, F.col("accountnumber") == F.col("primarydepositaccountnumber"), "left_semi")
    return R.arrears(wh, acc.select("accountnumberwithcheckdigit"), "1995-01-01", "2001-12-31",
                     ["A-NEW", "B-EXISTING"])


def card_search(wh: Warehouse) -> DataFrame:
    cif = _clients_in_segment(wh, "FURNITURE").select(F.col("cifwithcheckdigit").alias("__c"))
    cards = wh["dimcard"].join(cif, F.col("clientnumber") == F.col("__c"), "left_semi")
    return R.card_search(wh, cards.select("cardnumber"))


def incidents(wh: Warehouse) -> DataFrame:
    return R.latest_incidents(wh)


def tollgate(wh: Warehouse) -> DataFrame:
    acc = scd2_current(wh["dimaccount"]).filter(F.col("accountstatusname") == "P")
    return R.tollgate(wh, acc.select("accountnumberwithcheckdigit"), merchant_type="5999",
                      exclude_response="114")


FULL_REPORTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "full_aml": aml, "full_employer": employer, "full_contra": contra,
    "full_missed_fraud": missed_fraud, "full_client_lookup": client_lookup,
    "full_case_lookup": case_lookup, "full_arrears": arrears, "full_card_search": card_search,
    "full_incidents": incidents, "full_tollgate": tollgate,
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return FULL_REPORTS[name](warehouse_from_driver(spark, sf_dir))
