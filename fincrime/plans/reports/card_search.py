"""Card search: card, its owner's accounts, client and newest deposit balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import latest_snapshot, scd2_current, semi_join_keys
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "dimcard": ["cardnumber", "clientnumber", "embossedname", "cardholdertypecode",
                "cardexpirydate", "cardcreationdate", "cardreplacetimestamp", "cardstatusname",
                "rowiscurrent"],
    "dimaccount": ["accountnumber", "accountnumberwithcheckdigit", "clientnumber", "rowiscurrent"],
    "dimclient": ["cifwithcheckdigit", "firstname", "middlefirstname", "middlesecondname",
                  "middlethirdname", "lastname", "partyidentifiertypenumber", "rowiscurrent"],
    "factdepositaccountdailycoverage": ["accountnumber", "snapshotdate", "currentbalanceamount"],
}


def card_search(wh: Warehouse, cards: Sequence[str] | DataFrame) -> DataFrame:
    """One row per searched card x account of the card owner (8-character
    base of the card's 9-character client number)."""
    wh.validate(REQUIRED)
    dca = semi_join_keys(scd2_current(wh["dimcard"]), "cardnumber", cards).select(
        "cardnumber", F.col("clientnumber").alias("__card_client"), "embossedname",
        "cardholdertypecode", "cardexpirydate", "cardcreationdate", "cardreplacetimestamp",
        "cardstatusname").withColumn("__base", fn.strip_check_digit("__card_client", 8))
    da = scd2_current(wh["dimaccount"]).select(
        F.col("accountnumber").alias("__acc"), "accountnumberwithcheckdigit",
        F.col("clientnumber").alias("__owner"))
    dc = scd2_current(wh["dimclient"]).select(
        "cifwithcheckdigit", "firstname", "middlefirstname", "middlesecondname", "middlethirdname",
        "lastname", "partyidentifiertypenumber")
    fd = latest_snapshot(wh["factdepositaccountdailycoverage"], "snapshotdate").select(
        F.col("accountnumber").alias("__fda"), "currentbalanceamount")
    j = (dca.join(da, F.col("__owner") == F.col("__base"))
            .join(dc, F.col("cifwithcheckdigit") == F.col("__card_client"))
            .join(fd, F.col("__fda") == F.col("__acc")))
    return j.select(
        F.col("accountnumberwithcheckdigit").alias("account_number_check_digit"),
        F.col("currentbalanceamount").alias("dep_bal"),
        F.col("cifwithcheckdigit").alias("cif_check_digit"),
        fn.full_name("firstname", "middlefirstname", "middlesecondname", "middlethirdname")
          .alias("first_name"),
        F.col("lastname").alias("last_name"),
        F.col("partyidentifiertypenumber").alias("id_number"),
        F.col("cardnumber").alias("card_no"),
        F.col("embossedname").alias("card_name"),
        F.col("cardholdertypecode").alias("card_holder_type"),
        F.to_date("cardexpirydate").alias("expiry_dates"),
        F.to_date("cardcreationdate").alias("create_date"),
        F.to_date("cardreplacetimestamp").alias("replacement_date"),
        F.col("cardstatusname").alias("card_status"))
