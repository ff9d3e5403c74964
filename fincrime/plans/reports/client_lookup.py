"""Client and primary-account details by primary deposit account number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import latest_snapshot, scd2_current, semi_join_keys
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "factclient": ["cifnumber", "clientsnapshotdatekey", "primarydepositaccountnumber",
                   "residentialaddresskey", "employerkey"],
    "dimclient": ["cifnumber", "cifwithcheckdigit", "partyidentifiertypenumber", "titlename",
                  "firstname", "middlefirstname", "middlesecondname", "middlethirdname", "lastname",
                  "mobilephonenumber", "workphonenumber", "clientcreatedate", "rowiscurrent"],
    "dimaccount": ["accountkey", "accountnumber", "accountnumberwithcheckdigit", "accountopendate",
                   "rowiscurrent"],
    "factdepositaccountdailycoverage": ["accountkey", "snapshotdate", "lastcusttrandatekey",
                                        "currentbalanceamount", "stopsonaccountcount"],
    "dimaddress": ["addresskey", "addressline1text", "addressline2text", "addressline3text",
                   "addresscityname", "rowiscurrent"],
    "dimemployer": ["employerkey", "employername", "rowiscurrent"],
}


def client_lookup(wh: Warehouse, accounts: Sequence[str] | DataFrame,
                  clean_address: bool = False) -> DataFrame:
    """One row per client whose primary deposit account (number without
    check digit) is searched, from the newest client snapshot."""
    wh.validate(REQUIRED)
    fc = semi_join_keys(latest_snapshot(wh["factclient"], "clientsnapshotdatekey"),
                        "primarydepositaccountnumber", accounts)
    dc = scd2_current(wh["dimclient"]).drop("rowiscurrent", "clientkey")
    dac = scd2_current(wh["dimaccount"]).select(
        F.col("accountkey"), F.col("accountnumber").alias("__acc"), "accountnumberwithcheckdigit",
        "accountopendate")
    fd = latest_snapshot(wh["factdepositaccountdailycoverage"], "snapshotdate").select(
        F.col("accountkey").alias("__fdk"), "lastcusttrandatekey", "currentbalanceamount",
        "stopsonaccountcount")
    dad = scd2_current(wh["dimaddress"]).select(
        F.col("addresskey").alias("__ad"), "addressline1text", "addressline2text",
        "addressline3text", "addresscityname")
    de = scd2_current(wh["dimemployer"]).select(F.col("employerkey").alias("__em"), "employername")
    j = (fc.select("cifnumber", "primarydepositaccountnumber", "residentialaddresskey", "employerkey")
           .join(dc, "cifnumber")
           .join(dac, F.col("__acc") == F.col("primarydepositaccountnumber"))
           .join(fd, F.col("__fdk") == F.col("accountkey"))
           .join(dad, F.col("__ad") == F.col("residentialaddresskey"))
           .join(de, F.col("__em") == F.col("employerkey")))
    return j.select(
        F.col("partyidentifiertypenumber").alias("id_number"),
        F.col("cifwithcheckdigit").alias("cif_number"),
        fn.full_name("firstname", "middlefirstname", "middlesecondname", "middlethirdname",
                     title="titlename", last="lastname").alias("title_firstnames_lastname"),
        F.col("mobilephonenumber").alias("phone_cell"),
        F.col("workphonenumber").alias("phone_work"),
        F.to_date("clientcreatedate").alias("client_create_date"),
        F.col("accountnumberwithcheckdigit").alias("primary_deposit_account"),
        F.to_date("accountopendate").alias("account_open_date"),
        fn.date_from_key("lastcusttrandatekey").alias("last_cust_tran_date"),
        F.col("currentbalanceamount").alias("account_balance"),
        fn.flag_yes_no("stopsonaccountcount").alias("account_stopped"),
        fn.address_line("addressline1text", "addressline2text", "addressline3text",
                         "addresscityname", clean=clean_address).alias("home_address"),
        F.col("employername").alias("employer_name"))
