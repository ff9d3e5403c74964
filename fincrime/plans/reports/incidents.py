"""Latest incident per incident number, with the client's newest snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime.operators import latest_per_key, latest_snapshot, scd2_current
from fincrime.plans.reports.common import ties_over
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "factclient": ["clientkey", "clientsnapshotdatekey", "primarydepositaccountnumber"],
    "dimclient": ["clientkey", "cifwithcheckdigit", "partyidentifiertypenumber", "firstname",
                  "lastname", "rowiscurrent"],
    "dbo_incident": ["incidentnumber", "clientcif", "noncbclientidnumber", "createddatetime",
                     "profilefullname", "actualcategory", "actualsubcategory", "actualissue",
                     "subject", "symptom", "resolution"],
}


def latest_incidents(wh: Warehouse, incident_current_only: bool = False) -> DataFrame:
    """One row per incident number: its newest version by creation time.

    ``incident_current_only`` also requires the incident row to be current
    (the source takes every version; the newest-per-incident rule covers it).
    """
    wh.validate(REQUIRED)
    fc = latest_snapshot(wh["factclient"], "clientsnapshotdatekey") \
        .select("clientkey", "primarydepositaccountnumber")
    dc = scd2_current(wh["dimclient"]).select(
        "clientkey", "cifwithcheckdigit", "partyidentifiertypenumber", "firstname", "lastname")
    inc = wh["dbo_incident"]
    if incident_current_only:
        inc = scd2_current(inc)
    inc = inc.select("incidentnumber", "clientcif", "noncbclientidnumber", "createddatetime",
                     "profilefullname", "actualcategory", "actualsubcategory", "actualissue",
                     "subject", "symptom", "resolution")
    j = fc.join(dc, "clientkey").join(inc, F.col("cifwithcheckdigit") == F.col("clientcif"))
    out = j.select(
        F.col("incidentnumber").alias("incident_number"),
        F.col("cifwithcheckdigit").alias("cif_check_digit"),
        F.col("partyidentifiertypenumber").alias("id_number"),
        F.col("firstname").alias("first_name"),
        F.col("lastname").alias("last_name"),
        F.col("primarydepositaccountnumber").alias("primary_deposit_account"),
        F.col("noncbclientidnumber").alias("non_cb_client_id_number"),
        F.to_date("createddatetime").alias("incident_create_date"),
        F.col("profilefullname").alias("owner_full_name"),
        F.col("actualcategory").alias("actual_category"),
        F.col("actualsubcategory").alias("actual_sub_category"),
        F.col("actualissue").alias("actual_issue"),
        "subject", "symptom", "resolution", "createddatetime")
    newest = latest_per_key(out, ["incident_number"], ["createddatetime"],
                            ties=ties_over(out, ["incident_number", "createddatetime"]))
    return newest.drop("createddatetime")
