"""Loan arrears of clients found by primary deposit account, with the
teller who activated the client's first card, scoring detail and ratio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import (dedup, first_per_key, latest_snapshot, number_rows,
                                scd2_current, semi_join_keys)
from fincrime.plans.reports.common import date_key, to_date_value
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "factclient": ["clientkey", "clientsnapshotdatekey", "primarydepositaccountnumber", "employerkey"],
    "dimclient": ["clientkey", "cifnumber", "cifwithcheckdigit", "partyidentifiertypenumber",
                  "clientcreatedate", "rowiscurrent"],
    "dimaccount": ["accountkey", "accountnumber", "accountnumberwithcheckdigit", "rowiscurrent"],
    "dimcard": ["clientnumber", "cardactivatedtellernumber", "cardactivetimestamp", "rowiscurrent"],
    "dimteller": ["tellerkey", "tellernumber", "tellername", "rowiscurrent"],
    "factloanaccountdailycoverage": ["accountkey", "clientkey", "productkey", "coveragedatekey",
                                     "lastadvancedatekey", "lastarrearsdatekey",
                                     "arrearsinstallmentcount", "loanbalanceamount",
                                     "loanarrearsamount", "loanofficertellerkey",
                                     "clientcollectionskey"],
    "factcapout": ["accountkey", "advanceamount", "transactionbranchkey"],
    "dimemployer": ["employerkey", "employername", "employernumberwithcheckdigit",
                    "employerindustrytypename", "rowiscurrent"],
    "dimproduct": ["productkey", "productname", "productgroupname", "rowiscurrent"],
    "factdepositaccountdailycoverage": ["accountkey", "coveragedatekey", "currentbalanceamount",
                                        "stopsonaccountcount"],
    "dimbranch": ["branchkey", "branchname", "provincename"],
    "dimclientcollections": ["clientcollectionskey", "clientstatusname", "rowiscurrent"],
    "creditapplicationoutcome": ["cifwithcheckdigit", "clienttype", "lrid_date", "logical_record_id"],
    "dbo_smapplication": ["logicalrecordid", "loanpurpose", "retailername"],
    "dbo_smsmresults": ["logicalrecordid", "privatesector"],
    "dbo_gdcreditpolicystrategy": ["logicalrecordid", "score_mi"],
}

PACK = 32     # credit outcomes of a client that travel with a loan row through the sort
LOAN_GROUPS = ["Loan", "Facility", "Credit Card"]

OUTPUT = ["id_number", "cif_check_digit", "client_create_date", "create_teller",
          "primary_deposit_account", "dep_bal", "account_stopped", "loan_contract",
          "application_date", "client_type", "default_date", "num_arrears_installments",
          "loan_purpose", "retailer_name", "mie", "loan_bal", "loan_arrears", "product_desc",
          "loan_teller", "branch_name", "province", "client_handed_over_status", "employer_no",
          "employer_name", "industry", "capout", "prism_score", "client_arrears_ratio"]


def accounts_with_tellers(wh: Warehouse, accounts: Sequence[str] | DataFrame) -> DataFrame:
    """cif, teller key of the first activated card, primary deposit account."""
    fc = latest_snapshot(wh["factclient"], "clientsnapshotdatekey").select(
        "clientkey", "primarydepositaccountnumber")
    d = scd2_current(wh["dimclient"]).select("clientkey", "cifnumber", "cifwithcheckdigit")
    da = semi_join_keys(scd2_current(wh["dimaccount"]), "accountnumberwithcheckdigit", accounts) \
        .select(F.col("accountnumber").alias("__an"), "accountnumberwithcheckdigit")
    client = fc.join(d, "clientkey").join(da, F.col("__an") == F.col("primarydepositaccountnumber"))
    card = scd2_current(wh["dimcard"]).select("clientnumber", "cardactivatedtellernumber",
                                              "cardactivetimestamp")
    card = card.join(client.select(F.col("cifwithcheckdigit").alias("__cw")),
                     F.col("clientnumber") == F.col("__cw"), "left_semi")
    tel = scd2_current(wh["dimteller"]).select("tellerkey", fn.try_int("tellernumber").alias("__tn"))
    ct = card.join(tel, F.col("__tn") == F.col("cardactivatedtellernumber"))
    first = first_per_key(ct, ["clientnumber"], ["cardactivetimestamp"],
                          ties=[F.col("tellerkey").asc_nulls_last(),
                                F.col("cardactivatedtellernumber").asc_nulls_last()])
    return client.join(first, F.col("clientnumber") == F.col("cifwithcheckdigit")).select(
        F.col("cifnumber").alias("cif"), F.col("tellerkey").alias("teller_key"),
        F.col("accountnumberwithcheckdigit").alias("primary_deposit_account"))


def searched_clients(wh: Warehouse, accounts: Sequence[str] | DataFrame) -> DataFrame:
    """The client search with the clients' own columns, built once: a row a
    current client version, teller and primary deposit account.

    Its rows are distinct over all columns and its join columns are known not to
    be null, so no use of it can narrow what lies below: all uses plan the same
    exchange, and Spark runs it once and reads it again for the others."""
    awt = accounts_with_tellers(wh, accounts)
    dc = scd2_current(wh["dimclient"]).select("clientkey", "cifnumber", "cifwithcheckdigit",
                                              "partyidentifiertypenumber", "clientcreatedate")
    s = dc.join(awt, F.col("cif") == F.col("cifnumber")).drop("cifnumber", "cif")
    joined_by = ["clientkey", "cifwithcheckdigit", "teller_key", "primary_deposit_account"]
    return dedup(s.dropna(subset=joined_by))


def arrears(wh: Warehouse, accounts: Sequence[str] | DataFrame, date_from, date_to,
            client_types: Sequence[str]) -> DataFrame:
    """Arrears rows for the clients of the searched primary deposit accounts
    (with check digit), loan application date and credit-outcome date both
    in [date_from, date_to], credit outcome client type in ``client_types``.
    Sorted by ID number, highest first."""
    wh.validate(REQUIRED)
    lo, hi = to_date_value(date_from), to_date_value(date_to)
    search = searched_clients(wh, accounts)
    fl = latest_snapshot(wh["factloanaccountdailycoverage"], "coveragedatekey")
    app_date = fn.date_from_key("lastadvancedatekey")
    # the range of the key reaches the scan; the date test drops keys that are no day
    fl = fl.filter(F.col("lastadvancedatekey").between(date_key(lo), date_key(hi)) & app_date.isNotNull())
    fl = fl.select("accountkey", "clientkey", "productkey", "lastadvancedatekey", "lastarrearsdatekey",
                   "arrearsinstallmentcount", "loanbalanceamount", "loanarrearsamount",
                   "loanofficertellerkey", "clientcollectionskey")
    da = scd2_current(wh["dimaccount"]).select(F.col("accountkey").alias("__lak"),
                                               F.col("accountnumberwithcheckdigit").alias("loan_contract"))
    fca = wh["factcapout"].select(F.col("accountkey").alias("__cak"), "advanceamount",
                                  "transactionbranchkey")
    fcl = latest_snapshot(wh["factclient"], "clientsnapshotdatekey").select(
        F.col("clientkey").alias("__fck"), F.col("employerkey").alias("__fek"),
        F.col("primarydepositaccountnumber").alias("__ppan"))
    de = scd2_current(wh["dimemployer"]).select(F.col("employerkey").alias("__ek"), "employername",
                                                "employernumberwithcheckdigit",
                                                "employerindustrytypename")
    dp = scd2_current(wh["dimproduct"]).select(F.col("productkey").alias("__pk"), "productname",
                                               "productgroupname")
    dt = scd2_current(wh["dimteller"]).select(F.col("tellerkey").alias("__tk"),
                                              F.col("tellernumber").alias("__t_no"),
                                              F.col("tellername").alias("__t_name"))
    # the primary deposit account must be one found for a searched client
    da2 = scd2_current(wh["dimaccount"]).select(F.col("accountkey").alias("__dak"),
                                                F.col("accountnumber").alias("__dan"),
                                                F.col("accountnumberwithcheckdigit").alias("__pda"))
    da2 = da2.join(search.select(F.col("primary_deposit_account").alias("__spda")),
                   F.col("__pda") == F.col("__spda"), "left_semi")
    fd = latest_snapshot(wh["factdepositaccountdailycoverage"], "coveragedatekey").select(
        F.col("accountkey").alias("__fdk"), "currentbalanceamount", "stopsonaccountcount")
    db = wh["dimbranch"].select(F.col("branchkey").alias("__bk"), "branchname", "provincename")
    dt2 = scd2_current(wh["dimteller"]).select(F.col("tellerkey").alias("__t2k"),
                                               F.col("tellernumber").alias("__t2_no"),
                                               F.col("tellername").alias("__t2_name"))
    dcc = scd2_current(wh["dimclientcollections"]).select(
        F.col("clientcollectionskey").alias("__cck"), "clientstatusname")
    # days as a range of the column itself, so that the scan sees it; outcomes of the searched
    # clients only, before the scoring joins (exact: the join by CIF below drops the others)
    cao = wh["creditapplicationoutcome"].filter(
        F.col("clienttype").isin(list(client_types)) & (F.col("lrid_date") >= F.lit(lo))
        & (F.col("lrid_date") < F.date_add(F.lit(hi), 1))) \
        .join(search.select(F.col("cifwithcheckdigit").alias("__scw")),
              F.col("cifwithcheckdigit") == F.col("__scw"), "left_semi") \
        .select(F.col("cifwithcheckdigit").alias("__cao_cif"), "clienttype", "logical_record_id")
    sma = wh["dbo_smapplication"].select(F.col("logicalrecordid").alias("__sma"), "loanpurpose",
                                         "retailername")
    smr = wh["dbo_smsmresults"].select(F.col("logicalrecordid").alias("__smr"), "privatesector")
    gd = wh["dbo_gdcreditpolicystrategy"].select(F.col("logicalrecordid").alias("__gd"), "score_mi")

    # the searched clients are the most selective input: their loan rows first
    j = (fl.join(search.drop("primary_deposit_account"), "clientkey")
           .join(da, F.col("__lak") == F.col("accountkey"))
           .join(fca, F.col("__cak") == F.col("accountkey"), "left")
           .join(fcl, F.col("__fck") == F.col("clientkey"))
           .join(de, F.col("__ek") == F.col("__fek"))
           .join(dp, F.col("__pk") == F.col("productkey"))
           .join(dt, F.col("__tk") == F.col("teller_key"))
           .join(da2, F.col("__dan") == F.col("__ppan"))
           .join(fd, F.col("__fdk") == F.col("__dak"))
           .join(db, F.col("__bk") == F.col("transactionbranchkey"), "left")
           .join(dt2, F.col("__t2k") == F.col("loanofficertellerkey"), "left")
           .join(dcc, F.col("__cck") == F.col("clientcollectionskey"), "left"))
    # dealt out by client at once: the DISTINCT and the join with the outcomes both stay there
    loan_side = dedup(j.select(
        F.col("partyidentifiertypenumber").alias("id_number"),
        F.col("cifwithcheckdigit").alias("cif_check_digit"),
        F.col("clientcreatedate").alias("client_create_date"),
        fn.teller_label("__t_no", "__t_name").alias("create_teller"),
        F.col("__pda").alias("primary_deposit_account"),
        F.col("currentbalanceamount").alias("dep_bal"),
        fn.flag_yes_no("stopsonaccountcount").alias("account_stopped"),
        "loan_contract",
        app_date.alias("application_date"),
        fn.date_from_key("lastarrearsdatekey").alias("default_date"),
        F.col("arrearsinstallmentcount").alias("num_arrears_installments"),
        F.col("loanbalanceamount").alias("loan_bal"),
        F.col("loanarrearsamount").alias("loan_arrears"),
        F.col("productname").alias("product_desc"),
        F.when(F.col("productgroupname").isin(LOAN_GROUPS),
               fn.teller_label("__t2_no", "__t2_name")).alias("loan_teller"),
        F.col("branchname").alias("branch_name"),
        F.col("provincename").alias("province"),
        F.col("clientstatusname").alias("client_handed_over_status"),
        F.col("employernumberwithcheckdigit").alias("employer_no"),
        F.col("employername").alias("employer_name"),
        F.col("employerindustrytypename").alias("industry"),
        F.col("advanceamount").alias("capout"),
        fn.arrears_ratio("loanarrearsamount", "loanbalanceamount").alias("client_arrears_ratio"))
        .repartition("cif_check_digit"))
    # Credit outcomes join by client only, so every loan row meets every
    # outcome row of its client.  Both sides carry the client's CIF, so the
    # product of the two DISTINCT sides is itself distinct: de-duplicating
    # each side before the fan-out gives exactly the DISTINCT of the whole
    # row, without hashing the fanned-out rows.  Nor are these sorted: the sort
    # is by the loan side alone, so a loan row meets its client's outcomes in
    # packs of at most PACK and the packs are opened after it, in its order.
    outcome_side = dedup(
        cao.join(sma, F.col("__sma") == F.col("logical_record_id"), "left")
           .join(smr, F.col("__smr") == F.col("logical_record_id"), "left")
           .join(gd, F.col("__gd") == F.col("logical_record_id"), "left")
           .select("__cao_cif", F.col("clienttype").alias("client_type"),
                   F.col("loanpurpose").alias("loan_purpose"),
                   F.col("retailername").alias("retailer_name"),
                   F.col("privatesector").alias("mie"), F.col("score_mi").alias("prism_score")))
    shown = [c for c in outcome_side.columns if c in OUTPUT]
    packed = number_rows(outcome_side, ["__cao_cif"], shown, ties=[], name="__n", balanced=False) \
        .groupBy("__cao_cif", F.ceil(F.col("__n") / PACK).alias("__pack")) \
        .agg(F.collect_list(F.struct(*shown)).alias("__outcomes"))
    out = loan_side.join(packed, F.col("cif_check_digit") == F.col("__cao_cif"))
    out = out.orderBy(F.col("id_number").desc_nulls_last())
    return out.withColumn("__o", F.explode("__outcomes")) \
              .select(*[F.col(f"__o.{c}").alias(c) if c in shown else F.col(c) for c in OUTPUT])
