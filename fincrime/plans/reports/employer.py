"""All accounts of clients found by employer number or account number,
in a fixed 56-column case layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import dedup, flag_keys, latest_snapshot, scd2_current, semi_join_keys
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "factclient": ["clientkey", "clientsnapshotdatekey", "residentialaddresskey", "employerkey",
                   "primarydepositaccountnumber", "clientcollectionskey"],
    "dimclient": ["clientkey", "cifnumber", "titlename", "initials", "lastname",
                  "partyidentifiertypenumber", "homephonenumber", "mobilephonenumber",
                  "workphonenumber", "clientcreatedate", "rowiscurrent"],
    "d_client": ["cif", "teller_key"],
    "d_teller": ["teller_key", "teller_no", "teller_name"],
    "dimaddress": ["addresskey", "addressline1text", "addressline2text", "addressline3text",
                   "addresspostcode", "rowiscurrent"],
    "dimemployer": ["employerkey", "employername", "employernumberwithcheckdigit", "rowiscurrent"],
    "dimaccount": ["accountkey", "accountnumber", "accountnumberwithcheckdigit", "clientnumber",
                   "accounttypecode", "accountcategorycode", "accountstatusname", "accountopendate",
                   "rowiscurrent"],
    "dimclientcollections": ["clientcollectionskey", "clientstatusname", "rowiscurrent"],
    "factdepositaccountdailycoverage": ["accountkey", "coveragedatekey", "homebranchkey"],
    "dimbranch": ["branchkey", "branchname", "branchcode", "rowiscurrent"],
    "dimproduct": ["productcode", "productgroupname"],
    "factloanaccountdailycoverage": ["accountkey", "clientkey", "lastadvancedatekey"],
    "factcapout": ["accountkey", "advanceamount"],
    "factclientdailysummary": ["clientkey", "lastloanbranchkey"],
    "factcreditcardaccountdailycoverage": ["accountkey", "creditlimitamount", "accountopendatekey",
                                           "openingbranchkey"],
}

_LOAN, _CARD = "Loan", "Credit Card"


def _blank(name: str):
    return F.lit("").alias(name)


def employer_accounts(wh: Warehouse, search: Sequence[str] | DataFrame, application_company: str = "",
                      faithful: bool = False) -> DataFrame:
    """Rows for clients whose current employer number (with check digit) is
    searched, or for searched accounts (with check digit).  ``search`` is a list
    or a DataFrame (first column) of any size that holds numbers of both kinds.

    Default reading: newest snapshot AND (employer OR account).
    ``faithful=True`` keeps the source's precedence: (newest snapshot AND
    employer) OR account, any snapshot."""
    wh.validate(REQUIRED)
    fc_all = wh["factclient"]
    fc_new = latest_snapshot(fc_all, "clientsnapshotdatekey")
    de = flag_keys(scd2_current(wh["dimemployer"]), "employernumberwithcheckdigit", search, "__emp_hit")
    da_all = flag_keys(scd2_current(wh["dimaccount"]), "accountnumberwithcheckdigit", search, "__acc_hit")
    dc = scd2_current(wh["dimclient"])

    # Narrow the snapshot rows before the wide joins: clients of a searched
    # employer UNION clients owning a searched account (the exact row test
    # is applied again after the joins).
    emp_keys = semi_join_keys(scd2_current(wh["dimemployer"]), "employernumberwithcheckdigit", search) \
        .select("employerkey")
    owner_cifs = semi_join_keys(scd2_current(wh["dimaccount"]), "accountnumberwithcheckdigit", search) \
        .select(F.col("clientnumber").alias("__own"))
    owner_keys = dc.join(owner_cifs, F.col("cifnumber") == F.col("__own"), "left_semi").select("clientkey")
    by_emp = fc_new.join(emp_keys, "employerkey", "left_semi")
    by_acc = (fc_all if faithful else fc_new).join(owner_keys, "clientkey", "left_semi")
    fc = by_emp.unionByName(by_acc).select(
        "clientkey", "clientsnapshotdatekey", "residentialaddresskey", "employerkey",
        "primarydepositaccountnumber", "clientcollectionskey")

    mdc = wh["d_client"].select(F.col("cif").alias("__mcif"), F.col("teller_key").alias("__mtk"))
    mdt = wh["d_teller"].select(F.col("teller_key").alias("__tk"), "teller_no", "teller_name")
    dad = scd2_current(wh["dimaddress"]).select(
        F.col("addresskey").alias("__ad"), "addressline1text", "addressline2text", "addressline3text",
        "addresspostcode")
    de_sel = de.select(F.col("employerkey").alias("__ek"), "employername", "__emp_hit")
    da = da_all.select(F.col("accountkey").alias("__ak"), F.col("clientnumber").alias("__acl"),
                       F.col("accountnumberwithcheckdigit").alias("__acc_no"),
                       "accounttypecode", "accountcategorycode", "accountstatusname", "accountopendate", "__acc_hit")
    da2 = scd2_current(wh["dimaccount"]).select(F.col("accountnumber").alias("__pan"),
                        F.col("accountnumberwithcheckdigit").alias("primary_deposit_account"))
    dcc = scd2_current(wh["dimclientcollections"]).select(
        F.col("clientcollectionskey").alias("__cck"), "clientstatusname")
    fd = latest_snapshot(wh["factdepositaccountdailycoverage"], "coveragedatekey").select(
        F.col("accountkey").alias("__fdk"), F.col("homebranchkey").alias("__hbk"))
    branch_all = wh["dimbranch"]

    dp = wh["dimproduct"].select(F.col("productcode").alias("__pc"), "productgroupname")
    def branch(alias: str, cur: bool = False) -> DataFrame:
        b = scd2_current(branch_all) if cur else branch_all
        return b.select(F.col("branchkey").alias(f"__{alias}k"), F.col("branchname").alias(f"{alias}_name"),
                        F.col("branchcode").alias(f"{alias}_code"))

    # The loan and card facts are daily histories joined without a snapshot
    # filter (as in the source), and only a few of their columns reach the
    # DISTINCT result.  Each side is therefore reduced to DISTINCT (account key,
    # the columns it contributes) before the left join: the same final rows,
    # without multiplying every account by its history.
    # (loan INNER JOIN advance) as one right side: padded only when both miss;
    # its branch comes from the client summary of the loan's client.
    # Only the accounts of the narrowed clients can reach the result.
    cand = scd2_current(wh["dimaccount"]).join(fc.join(dc.select("clientkey", F.col("cifnumber").alias("__cc")), "clientkey")
                         .select("__cc"), F.col("clientnumber") == F.col("__cc"), "left_semi") \
        .select(F.col("accountkey").alias("__cand"))
    loan = wh["factloanaccountdailycoverage"].join(
        cand, F.col("accountkey") == F.col("__cand"), "left_semi").select(
        F.col("accountkey").alias("__lk"), F.col("clientkey").alias("__lck"), "lastadvancedatekey")
    cap = wh["factcapout"].select(F.col("accountkey").alias("__capk"), "advanceamount")
    fcds = wh["factclientdailysummary"].select(F.col("clientkey").alias("__sck"), "lastloanbranchkey")
    loan_side = dedup(
        loan.join(cap, F.col("__lk") == F.col("__capk"))
            .join(fcds, F.col("__sck") == F.col("__lck"), "left")
            .join(branch("db"), F.col("__dbk") == F.col("lastloanbranchkey"), "left")
            .select("__lk", "lastadvancedatekey", "advanceamount", "db_name", "db_code"))
    card_side = dedup(
        wh["factcreditcardaccountdailycoverage"]
        .join(cand, F.col("accountkey") == F.col("__cand"), "left_semi")
        .join(branch("db3", cur=True), F.col("__db3k") == F.col("openingbranchkey"), "left")
        .select(F.col("accountkey").alias("__cck2"), "creditlimitamount", "accountopendatekey",
                "db3_name", "db3_code"))

    j = (fc.join(dc, "clientkey")
           .join(mdc, F.col("__mcif") == F.col("cifnumber"))
           .join(mdt, F.col("__mtk") == F.col("__tk"))
           .join(dad, F.col("__ad") == F.col("residentialaddresskey"))
           .join(de_sel, F.col("__ek") == F.col("employerkey"))
           .join(da, F.col("__acl") == F.col("cifnumber"))
           .join(da2, F.col("__pan") == F.col("primarydepositaccountnumber"))
           .join(dcc, F.col("__cck") == F.col("clientcollectionskey"))
           .join(fd, F.col("__fdk") == F.col("__ak"), "left")
           .join(branch("db2"), F.col("__db2k") == F.col("__hbk"), "left")
           .join(dp, F.col("__pc") == fn.composite_key("accounttypecode", "accountcategorycode"))
           .join(loan_side, F.col("__lk") == F.col("__ak"), "left")
           .join(card_side, F.col("__cck2") == F.col("__ak"), "left"))
    emp_hit, acc_hit = F.col("__emp_hit"), F.col("__acc_hit")
    if faithful:
        newest = fc_new.select(F.max("clientsnapshotdatekey")).scalar()
        j = j.filter(((F.col("clientsnapshotdatekey") == newest) & emp_hit) | acc_hit)
    else:
        j = j.filter(emp_hit | acc_hit)

    grp = F.col("productgroupname")
    out = j.select(
        "primary_deposit_account",
        F.coalesce("db_name", "db2_name", "db3_name").alias("branch_name"),
        _blank("branch_street_address"),
        F.coalesce("db_code", "db2_code", "db3_code").alias("branch_code"),
        F.when(~grp.isin(_LOAN, _CARD), F.col("__acc_no")).alias("savings_account"),
        F.when(grp.isin(_LOAN, _CARD), F.col("__acc_no")).alias("loan_contract"),
        F.when(grp == _LOAN, F.col("advanceamount").cast("decimal(23,2)"))
         .when(grp == _CARD, F.col("creditlimitamount").cast("decimal(23,2)")).alias("amount_lost"),
        _blank("amount_prevented"), _blank("forensics_case_nr"), _blank("saps_case_nr"),
        "titlename", "initials", "lastname",
        F.col("partyidentifiertypenumber").alias("id_number"),
        _blank("postal_address_1"), _blank("postal_address_2"), _blank("postal_address_3"),
        _blank("postal_code"),
        F.col("addressline1text").alias("home_address_1"),
        F.col("addressline2text").alias("home_address_2"),
        F.col("addressline3text").alias("home_address_3"),
        F.col("addresspostcode").alias("post_code"),
        _blank("application_no"),
        F.when(grp == _LOAN, fn.date_from_key("lastadvancedatekey"))
         .when(grp == _CARD, fn.date_from_key("accountopendatekey")).alias("application_date"),
        F.lit(application_company).alias("application_company"),
        _blank("status"), _blank("decline_reason_code"), _blank("if_07_details"),
        F.col("homephonenumber").alias("phone_home"),
        F.col("mobilephonenumber").alias("phone_cell"),
        "employername",
        _blank("gross_salary"),
        F.col("workphonenumber").alias("phone_work"),
        _blank("e-mail"),
        _blank("ref_title"), _blank("ref_initials"), _blank("ref_surname"),
        _blank("ref_home_telephone"), _blank("ref_work_telephone"), _blank("ref_telephone"),
        _blank("fam_title"), _blank("fam_initials"), _blank("fam_surname"),
        _blank("fam_home_telephone"), _blank("fam_work_telephone"), _blank("fam_telephone"),
        _blank("credit_card_number"), _blank("bank_name"), _blank("branch_number"),
        _blank("bank_account_number"), _blank("bank_account_type"),
        F.to_date("clientcreatedate").alias("clientcreatedate"),
        fn.teller_label("teller_no", "teller_name").alias("create_teller"),
        F.col("accountstatusname").alias("account_status"),
        F.col("clientstatusname").alias("client_handed_over_status"),
        F.when(grp != _LOAN, F.col("accountopendate")).alias("savings_account_open_date"))
    return dedup(out)
