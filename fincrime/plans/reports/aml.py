"""Client evidence pack (AML) from a set of account numbers.

account -> its client(s) -> deposit and loan accounts of the client with the
newest balance per account -> the client's current primary cards -> newest
client snapshot, employer, addresses -> one row per card x account.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import dedup, latest_per_key, newest_rows, scd2_current, semi_join_keys, union_all
from fincrime.operators.clients import cards_of_client
from fincrime.plans.reports.common import current, ties_over, to_date_value
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "dimaccount": ["accountnumber", "accountnumberwithcheckdigit", "accountstatusname",
                   "accountopendate", "clientnumber", "rowiscurrent"],
    "factdepositaccountdailycoverage": ["accountnumber", "currentbalanceamount", "productkey",
                                        "homebranchkey", "coveragedatekey", "isfinalload"],
    "factloanaccountdailycoverage": ["accountnumber", "productkey", "originatingbranchkey",
                                     "coveragedatekey"],
    "dimproduct": ["productkey", "productgroupname", "productname"],
    "dimbranch": ["branchkey", "branchcode", "branchname"],
    "dimcard": ["cardkey", "cardnumber", "primarycardnumber", "cardholdertypecode",
                "cardholdertypename", "cardstatusname", "embossedname", "partyidentifiernumber",
                "cardcreationdate", "clientnumber", "rowiscurrent"],
    "factclient": ["cifnumber", "residentialaddresskey", "postaladdresskey", "employerkey",
                   "primarydepositaccountnumber", "clientsnapshottimestamp"],
    "dimemployer": ["employerkey", "employername"],
    "dimaddress": ["addresskey", "addressline1text", "addressline2text", "addressline3text",
                   "addresscityname", "addresspostcode"],
    "dimclient": ["cifnumber", "cifwithcheckdigit", "titlename", "firstname", "lastname",
                  "birthdate", "clientcreatedate", "partyidentifiertypenumber",
                  "partyidentifiertypename", "homephonenumber", "workphonenumber",
                  "mobilephonenumber"],
}

_ACCOUNT_COLS = ["clientnumber", "currentbalanceamount", "accountnumber",
                 "accountnumberwithcheckdigit", "accountstatusname", "productkey",
                 "productgroupname", "productname", "accountopendate", "branchcode", "branchname"]


def _newest(rows: DataFrame) -> DataFrame:
    keys = ["accountnumber", "accountnumberwithcheckdigit"]
    return latest_per_key(rows, keys, ["coveragedatekey"],
                          ties=[F.col("__fd_key").desc_nulls_last()] +
                          ties_over(rows, keys + ["coveragedatekey", "__fd_key"]))


def client_accounts(wh: Warehouse, clients: DataFrame) -> DataFrame:
    """Deposit and loan accounts of the clients, newest balance per account
    (each product family numbered on its own, then UNION ALL)."""
    da = scd2_current(wh["dimaccount"]).join(clients, "clientnumber", "left_semi").select(
        "clientnumber", F.col("accountnumber").alias("__an"), "accountnumberwithcheckdigit",
        "accountstatusname", "accountopendate")
    fd_all = wh["factdepositaccountdailycoverage"]
    dp = wh["dimproduct"].select(F.col("productkey").alias("__pk"), "productgroupname", "productname")
    db = wh["dimbranch"].select(F.col("branchkey").alias("__bk"), "branchcode", "branchname")

    fd = fd_all.select("accountnumber", "currentbalanceamount", "productkey", "homebranchkey",
                       "coveragedatekey")
    dep = (da.join(fd, F.col("accountnumber") == F.col("__an"))
             .join(dp, F.col("__pk") == F.col("productkey"), "left")
             .join(db, F.col("__bk") == F.col("homebranchkey")))
    # (the source groups these rows before numbering them; with a total tie
    # order, duplicates cannot change which row is newest, so no DISTINCT)
    dep = dep.select(*_ACCOUNT_COLS, "coveragedatekey", F.col("coveragedatekey").alias("__fd_key"))

    # Rows are numbered by the loan's day first and the deposit's day second, so only the newest
    # loan rows of an account (among those whose branch is known: the branch join drops the
    # others before the numbering) and the newest matching deposit rows can be its first row.
    # Both are chosen before they meet; ties stay for the numbering.
    fl = wh["factloanaccountdailycoverage"].select("accountnumber", "productkey", "originatingbranchkey",
                                                   "coveragedatekey")
    owned = da.select(F.col("__an").alias("__own")).distinct()
    fl = fl.join(owned, F.col("accountnumber") == F.col("__own"), "left_semi") \
           .join(db.select(F.col("__bk").alias("__known")), F.col("originatingbranchkey") == F.col("__known"), "left_semi")
    fl = newest_rows(fl, ["accountnumber"], "coveragedatekey")
    newest_key = fd_all.select(F.max("coveragedatekey")).scalar()
    fd_match = fd_all.filter((F.col("coveragedatekey") == newest_key) | (F.col("isfinalload") == 1)) \
        .join(owned, F.col("accountnumber") == F.col("__own"), "left_semi") \
        .select("accountnumber", "currentbalanceamount", "coveragedatekey")
    fd_match = newest_rows(fd_match, ["accountnumber"], "coveragedatekey") \
        .select(F.col("accountnumber").alias("__fda"), F.col("currentbalanceamount").alias("__bal"),
                F.col("coveragedatekey").alias("__fd_key"))
    loan = (da.join(fl, F.col("accountnumber") == F.col("__an"))
              .join(fd_match, F.col("__fda") == F.col("accountnumber"), "left")
              .join(dp, F.col("__pk") == F.col("productkey"), "left")
              .join(db, F.col("__bk") == F.col("originatingbranchkey")))
    loan = loan.select(
        "clientnumber",
        F.coalesce(F.col("__bal"), F.lit(0).cast("decimal(23,2)")).alias("currentbalanceamount"),
        *[c for c in _ACCOUNT_COLS if c not in ("clientnumber", "currentbalanceamount")],
        "coveragedatekey", "__fd_key")
    return union_all(_newest(dep), _newest(loan)).select(*_ACCOUNT_COLS)


def aml_evidence(wh: Warehouse, accounts: Sequence[str] | DataFrame, as_of=None,
                 current_only: bool = False) -> DataFrame:
    """Evidence pack for the clients owning the searched accounts
    (``accountnumberwithcheckdigit``).  ``as_of`` fixes the age reference
    date (default: today).  ``current_only`` also restricts client,
    employer, address and product to current versions (the source does not)."""
    wh.validate(REQUIRED)
    as_of_d = to_date_value(as_of)
    client = semi_join_keys(wh["dimaccount"], "accountnumberwithcheckdigit", accounts) \
        .select("clientnumber").distinct()
    account = client_accounts(wh, client)

    # Cards, snapshots and details are filtered by the searched clients, not by
    # the account rows: the final inner joins require a card, an account and the
    # details of the same searched client anyway, so the result is the same and
    # the account pipeline (two windows over the balance history) runs once.
    clients = client.select(F.col("clientnumber").alias("__owner"))
    card = cards_of_client(wh["dimcard"], client)

    fc = wh["factclient"].select("cifnumber", "residentialaddresskey", "postaladdresskey",
                                 "employerkey", "primarydepositaccountnumber",
                                 "clientsnapshottimestamp")
    fc = fc.join(clients, F.col("cifnumber") == F.col("__owner"), "left_semi")
    fc = latest_per_key(fc, ["cifnumber"], ["clientsnapshottimestamp"],
                        ties=ties_over(fc, ["cifnumber", "clientsnapshottimestamp"]))
    acc_hist = wh["dimaccount"].select(F.col("accountnumber").alias("__pan"),
                                       "accountnumberwithcheckdigit")
    emp = current(wh["dimemployer"], current_only).select(F.col("employerkey").alias("__ek"),
                                                          "employername")
    pre = dedup(fc.join(acc_hist, F.col("__pan") == F.col("primarydepositaccountnumber"))
                  .join(emp, F.col("__ek") == F.col("employerkey"))
                  .select("cifnumber", "residentialaddresskey", "postaladdresskey",
                          "accountnumberwithcheckdigit", "employername"))
    addr = current(wh["dimaddress"], current_only)
    res = addr.select(F.col("addresskey").alias("__rk"), F.col("addressline1text").alias("__r1"),
                      F.col("addressline2text").alias("__r2"), F.col("addressline3text").alias("__r3"),
                      F.col("addresscityname").alias("__rc"), F.col("addresspostcode").alias("__rp"))
    pos = addr.select(F.col("addresskey").alias("__pk2"), F.col("addressline1text").alias("__p1"),
                      F.col("addresscityname").alias("__pc"))
    details = dedup(pre.join(res, F.col("__rk") == F.col("residentialaddresskey"))
                       .join(pos, F.col("__pk2") == F.col("postaladdresskey"))
                       .select(F.col("cifnumber").alias("__cd_cif"),
                               fn.home_address("__r1", "__r2", "__r3", "__rc", "__rp", "__p1", "__pc")
                                 .alias("home_address"),
                               F.col("accountnumberwithcheckdigit").alias("__cd_acc"),
                               "employername"))

    dc = current(wh["dimclient"], current_only).join(
        client, F.col("cifnumber") == client["clientnumber"], "left_semi")
    a = account.select(*[F.col(c).alias(f"a_{c}") for c in account.columns])
    j = (dc.join(card, F.col("card_clientnumber") == F.col("cifnumber"))
           .join(a, F.col("a_clientnumber") == F.col("card_clientnumber"))
           .join(details, F.col("__cd_cif") == F.col("cifnumber")))
    out = j.select(
        F.col("a_accountnumberwithcheckdigit").alias("account_number_check_digit"),
        F.col("cifwithcheckdigit").alias("cif_number"),
        F.col("a_productgroupname").alias("product_group"),
        F.col("a_productname").alias("product_desc"),
        F.col("titlename").alias("title"),
        F.col("firstname").alias("first_name"),
        F.col("lastname").alias("last_name"),
        F.col("birthdate").alias("date_of_birth"),
        fn.age_years("birthdate", as_of_d).alias("age"),
        F.col("clientcreatedate").alias("first_client_contact_date"),
        F.col("a_accountopendate").alias("date_opened"),
        F.col("a_branchcode").alias("home_branch_code"),
        F.col("a_branchname").alias("home_branch_name"),
        F.col("primarycardnumber").alias("card_prim_no"),
        F.col("cardstatusname").alias("card_status"),
        F.col("cardholdertypename").alias("card_type"),
        F.col("embossedname").alias("card_name"),
        F.col("cardcreationdate").alias("card_allocated_date"),
        F.col("partyidentifiertypenumber").alias("id_number"),
        F.col("partyidentifiertypename").alias("id_type"),
        F.col("employername").alias("employer_name"),
        "home_address",
        F.col("homephonenumber").alias("phone_home"),
        F.col("workphonenumber").alias("phone_work"),
        F.col("mobilephonenumber").alias("phone_cell"),
        F.col("a_currentbalanceamount").alias("balance_on_account"),
        F.col("a_accountstatusname").alias("account_status"))
    return dedup(out)
