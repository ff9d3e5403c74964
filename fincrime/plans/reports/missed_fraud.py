"""Missed-fraud disputes: disputed debit transactions of closed incidents on one day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import scd2_current
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "dbo_utdaccounttransactions": ["parentlink_recid", "amount", "createddatetime", "cardnumber",
                                   "incidentnumber", "trancode", "trantype",
                                   "additionaldescription", "disputed", "rowiscurrent"],
    "dbo_unathorisedtransactiondisputes": ["recid", "incidentlink_recid", "incidentnumber",
                                           "fraudtype", "resolution", "createddatetime",
                                           "lastmoddatetime", "rowiscurrent"],
    "dbo_incident": ["recid", "incidentnumber", "createddatetime", "status", "clientcif",
                     "rowiscurrent"],
    "dimclient": ["clientkey", "cifwithcheckdigit", "rowiscurrent"],
}


def missed_fraud(wh: Warehouse, day, excluded_word: str = "fee") -> DataFrame:
    """Debit disputes logged on ``day`` (a date), of closed incidents, not
    fees (any case), marked disputed and carrying an incident number."""
    wh.validate(REQUIRED)
    word = excluded_word.lower()
    utd = scd2_current(wh["dbo_utdaccounttransactions"]).filter(
        fn.day_filter("createddatetime", day) & (F.col("amount") < 0)
        & ~F.lower("additionaldescription").contains(word) & ~F.lower("trantype").contains(word)
        & (F.lower("disputed") == "yes") & F.col("incidentnumber").isNotNull()
    ).select("parentlink_recid", "amount", "createddatetime", "cardnumber",
             F.col("incidentnumber").alias("incidentnumber_utd"), "trancode", "trantype",
             "additionaldescription")
    td = scd2_current(wh["dbo_unathorisedtransactiondisputes"]).select(
        F.col("recid").alias("__td"), "incidentlink_recid",
        F.col("incidentnumber").alias("incidentnumber_td"), "fraudtype", "resolution",
        F.col("createddatetime").alias("createddatetime_td"),
        F.col("lastmoddatetime").alias("lastmoddatetime_td"))
    inc = scd2_current(wh["dbo_incident"]).filter(F.lower("status") == "closed").select(
        F.col("recid").alias("__inc"), F.col("incidentnumber").alias("csi_incident_number"),
        F.to_date("createddatetime").alias("incident_date"), "clientcif")
    dcl = scd2_current(wh["dimclient"]).select("clientkey", "cifwithcheckdigit")
    j = (utd.join(td, F.col("parentlink_recid") == F.col("__td"))
            .join(inc, F.col("incidentlink_recid") == F.col("__inc"))
            .join(dcl, F.col("cifwithcheckdigit") == F.col("clientcif")))
    out = j.select(
        "clientkey", "csi_incident_number", "incidentnumber_utd", "incidentnumber_td",
        F.lit("").alias("strack_ref"),
        F.col("cardnumber").alias("card_no"),
        fn.card_bin("cardnumber").alias("bin"),
        F.col("trancode").alias("tran_code"),
        F.col("trantype").alias("tran_desc"),
        "incident_date", "createddatetime_td", "lastmoddatetime_td",
        F.lit("").alias("tran_id"),
        F.col("additionaldescription").alias("description"),
        "amount",
        F.col("createddatetime").alias("csi_log_date"),
        fn.fraud_code("fraudtype").alias("fruad_code"),
        F.col("fraudtype").alias("fruad_description"),
        F.col("resolution").alias("summary_resolution"))
    return out.orderBy(F.col("csi_log_date").asc_nulls_last(), F.col("amount").asc_nulls_last())
