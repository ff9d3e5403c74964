"""The ten report keys on the derived views: each keeps its report's shape
(joins, newest-row rule, filters, dedup and labels) with fewer columns than
the full layouts in ``plans/reports`` (those are checked by golden tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import (decode, dedup, first_per_key, flagged_accounts, latest_per_key,
                                latest_snapshot, number_rows, scd2_current, semi_join_keys,
                                union_all)
from fincrime.operators.clients import clients_of_accounts, stopped_card_activity
from fincrime.operators.matching import contra_entry_match
from fincrime.plans.context import Ctx, d, ts_lit

REPORT_KEYS: dict[str, callable] = {}

# Search inputs: whole segments derived from the tables (the reports take a
# list or a DataFrame of any size), a day, a period and an instant.
SEARCH_STATUS = "P"            # accounts searched: every account with this status
EMPLOYER_NAME = "MACHINERY"
CASE_SEGMENT = "AUTOMOBILE"    # case folders of every client in this segment
CARD_SEGMENT = "FURNITURE"     # cards of every client in this segment
FRAUD_DAY = "1998-09-30"
CASE_AFTER = "1998-02-15 06:00:00"
ARREARS_FROM, ARREARS_TO = "1998-04-04", "1998-06-04"
DEVICE_TYPES = {"view": "NAD", "purchase": "POS"}
_DAILY_TIES = ["currentbalanceamount", "stopsonaccountcount"]


def _searched_accounts(c: Ctx) -> DataFrame:
    return c.fx.fx_account.filter(F.col("accountstatusname") == SEARCH_STATUS)


def _segment(c: Ctx, segment: str) -> DataFrame:
    return c.t.customer.filter(F.col("c_mktsegment") == segment).select("c_custkey")


def report(name: str):
    def reg(f):
        REPORT_KEYS[name] = f
        return f
    return reg


def _newest_daily(c: Ctx) -> DataFrame:
    return latest_per_key(c.fx.fx_daily, ["accountkey"], ["coveragedatekey"], ties=_DAILY_TIES)


def _current_clients(c: Ctx) -> DataFrame:
    return scd2_current(c.fx.fx_client)


def _address_by_cif(c: Ctx) -> DataFrame:
    a = c.fx.fx_addr
    return a.withColumn("__cif", F.lpad(F.col("addresskey").cast("string"), 8, "0"))


@report("report_aml")
def report_aml(c: Ctx) -> DataFrame:
    acc = c.fx.fx_account
    clients = clients_of_accounts(acc, _searched_accounts(c).select("accountkey"))
    mine = acc.join(clients, "clientnumber", "left_semi")
    # DISTINCT before the newest-row pick is not needed: with a total tie
    # order duplicates cannot change the rn = 1 row
    daily = c.fx.fx_daily.select(F.col("accountkey").alias("__a"), "coveragedatekey",
                                 "currentbalanceamount")
    dep = mine.filter(F.col("accountstatusname") == "F")
    dep = dep.join(daily, daily["__a"] == dep["accountkey"]).select(
        "clientnumber", "accountnumber", "currentbalanceamount", "coveragedatekey",
        F.lit("Deposit").alias("grp"))
    loan = mine.filter(F.col("accountstatusname") != "F")
    loan = loan.join(daily, daily["__a"] == loan["accountkey"], "left").select(
        "clientnumber", "accountnumber",
        F.coalesce(F.col("currentbalanceamount"), F.lit(0).cast("decimal(18,2)"))
         .alias("currentbalanceamount"),
        "coveragedatekey", F.lit("Loan").alias("grp"))
    newest = latest_per_key(union_all(dep, loan), ["accountnumber"], ["coveragedatekey"],
                            ties=["currentbalanceamount"])
    cl = _current_clients(c).select("cifnumber", "cifwithcheckdigit", "firstname")
    ad = _address_by_cif(c)
    out = (newest.join(cl, cl["cifnumber"] == newest["clientnumber"])
                 .join(ad, ad["__cif"] == cl["cifnumber"])
                 .select("accountnumber", "grp", "currentbalanceamount", "cifwithcheckdigit",
                         "firstname", fn.cat(F.col("l1"), ", ", F.col("city")).alias("home_address")))
    return dedup(out)


@report("report_employer")
def report_employer(c: Ctx) -> DataFrame:
    cl = _current_clients(c).select("cifnumber", "cifwithcheckdigit", "lastname")
    acc = scd2_current(c.fx.fx_account).select("accountkey", "accountnumber", "clientnumber",
                                               "accountstatusname")
    daily = latest_snapshot(c.fx.fx_daily, "coveragedatekey").select(
        F.col("accountkey").alias("__a"), "currentbalanceamount")
    ad = _address_by_cif(c).select("__cif", "l1")
    j = (cl.join(acc, acc["clientnumber"] == cl["cifnumber"])
           .join(daily, daily["__a"] == acc["accountkey"], "left")
           .join(ad, ad["__cif"] == cl["cifnumber"]))
    # snapshot AND (employer OR account): the intended reading of the source.
    # The account test is a left join with the distinct searched numbers (1:1,
    # so no row is repeated) and a marker, so the OR stays one pass.
    searched = _searched_accounts(c).select(F.col("accountnumber").alias("__hit")).distinct()
    j = j.join(searched, F.col("accountnumber") == F.col("__hit"), "left")
    j = j.filter((F.col("lastname") == EMPLOYER_NAME) | F.col("__hit").isNotNull())
    st, an = "accountstatusname", "accountnumber"
    return dedup(j.select(
        an, "cifwithcheckdigit",
        fn.route_by_group(st, an, ["F", "O"], negate=True).alias("savings_account"),
        fn.route_by_group(st, an, ["F", "O"]).alias("loan_contract"),
        "currentbalanceamount", F.lit("").alias("case_nr"), F.col("l1").alias("home_address_1")))


@report("report_contra")
def report_contra(c: Ctx) -> DataFrame:
    lg = c.fx.fx_ledger
    pairs = contra_entry_match(lg, flagged_accounts(lg, [50, 73]))
    names = c.fx.fx_client.select(F.col("clientkey").alias("__ck"), F.col("firstname").alias("debit_name"))
    m = pairs.join(names, names["__ck"] == F.col("debit_client") * 10 + 1).select(
        "credit_client", "credit_account", "debit_account", "debit_client", "debit_name",
        "transactiondate", "timekey", "journalnumber",
        F.col("credit_amount").alias("credit"), F.col("debit_amount").alias("debit"))
    # de-duplicate first, then number (numbering over duplicates removes nothing)
    m = number_rows(dedup(m), ["credit_client"], ["transactiondate", "timekey"],
                    ties=[F.col(x).asc_nulls_last() for x in ("debit_account", "journalnumber", "credit")],
                    balanced=False)  # only rn = 1 is kept
    # the name test changes which row is first, so it stays above the window
    return m.filter((F.col("rn") == 1) & F.col("debit_name").contains("1"))


@report("report_missed_fraud")
def report_missed_fraud(c: Ctx) -> DataFrame:
    lg = c.fx.fx_ledger.filter((F.col("transactionamount") < 0) &
                               (F.col("transactiondate") == F.lit(d(FRAUD_DAY))))
    acc = scd2_current(c.fx.fx_account).filter(F.lower("accountstatusname") == "f") \
        .select(F.col("accountkey").alias("__a"), "accountnumber", "clientnumber")
    cl = _current_clients(c).filter(~F.lower("lastname").contains("build") &
                                    F.col("middlefirstname").isNotNull()) \
        .select("cifnumber", "cifwithcheckdigit")
    j = lg.join(acc, acc["__a"] == lg["accountkey"]).join(cl, cl["cifnumber"] == acc["clientnumber"])
    return j.select("accountkey", "transactionamount", "transactiondate",
                    fn.card_bin("accountnumber").alias("bin"), "cifwithcheckdigit") \
        .orderBy(F.col("transactiondate").asc_nulls_last(), F.col("transactionamount").asc_nulls_last())


@report("report_client_lookup")
def report_client_lookup(c: Ctx) -> DataFrame:
    acc = semi_join_keys(scd2_current(c.fx.fx_account), "accountnumber",
                         _searched_accounts(c).select("accountnumber"))
    cl = _current_clients(c)
    daily = _newest_daily(c).select(F.col("accountkey").alias("__a"), "currentbalanceamount",
                                    "stopsonaccountcount")
    ad = _address_by_cif(c)
    j = (cl.join(acc, acc["clientnumber"] == cl["cifnumber"])
           .join(daily, daily["__a"] == acc["accountkey"])
           .join(ad, ad["__cif"] == cl["cifnumber"]))
    return j.select(
        "cifwithcheckdigit",
        fn.full_name("firstname", "middlefirstname", "middlesecondname").alias("full_name"),
        "accountnumber", "accountopendate", "currentbalanceamount",
        fn.flag_yes_no("stopsonaccountcount").alias("account_stopped"),
        fn.address_line("l1", "l2", "l3", "city").alias("home_address"))


@report("report_case_lookup")
def report_case_lookup(c: Ctx) -> DataFrame:
    o = c.t.orders
    o = o.filter(F.col("o_orderdate") > ts_lit(CASE_AFTER))
    return semi_join_keys(o, "o_custkey", _segment(c, CASE_SEGMENT)) \
        .select("o_orderkey", "o_orderdate", "o_orderstatus")


@report("report_arrears")
def report_arrears(c: Ctx) -> DataFrame:
    lo, hi = d(ARREARS_FROM), d(ARREARS_TO)
    acc = scd2_current(c.fx.fx_account).filter(F.col("accountopendate").between(lo, hi)) \
        .select(F.col("accountkey").alias("__a"), "accountnumber", "clientnumber")
    cl = _current_clients(c).select("cifnumber", "cifwithcheckdigit")
    legs = dedup(c.fx.fx_legs.select(F.col("l_orderkey").alias("__f"),
                                     F.col("l_suppkey").alias("__teller"), F.col("d").alias("dd")))
    first_teller = first_per_key(legs, ["__f"], ["dd"], ties=[F.col("__teller").asc_nulls_last()])
    tel = c.fx.fx_teller
    dly = _newest_daily(c)
    j = (dly.join(acc, acc["__a"] == dly["accountkey"])
            .join(cl, cl["cifnumber"] == acc["clientnumber"])
            .join(first_teller, first_teller["__f"] == dly["accountkey"])
            .join(tel, tel["tellerkey"] == F.col("__teller"), "left"))
    rate = F.round(F.col("stopsonaccountcount").cast("decimal(18,2)") / 4, 2).cast("decimal(18,2)")
    out = dedup(j.select("cifwithcheckdigit", "accountnumber",
                         fn.teller_label("tellernumber", "tellername").alias("create_teller"),
                         "currentbalanceamount", rate.alias("arrears_rate")))
    return out.orderBy(F.col("cifwithcheckdigit").desc_nulls_last())


@report("report_card_search")
def report_card_search(c: Ctx) -> DataFrame:
    k = semi_join_keys(c.fx.fx_card, "cardno", _segment(c, CARD_SEGMENT)).withColumn(
        "__cif", F.lpad(F.col("cardno").cast("string"), 8, "0"))
    cl = _current_clients(c).withColumn("__base", fn.strip_check_digit("cifwithcheckdigit", 8))
    acc = scd2_current(c.fx.fx_account).select("accountkey", "accountnumber", "clientnumber")
    dly = _newest_daily(c).select(F.col("accountkey").alias("__a"), "currentbalanceamount")
    j = (k.join(cl, cl["cifnumber"] == k["__cif"])
          .join(acc, acc["clientnumber"] == cl["__base"])
          .join(dly, dly["__a"] == acc["accountkey"]))
    return j.select("cardno", "accountnumber", "currentbalanceamount", "cifwithcheckdigit",
                    fn.full_name("firstname", "middlefirstname", "middlesecondname").alias("first_name"),
                    "stopdate")


@report("report_incidents")
def report_incidents(c: Ctx) -> DataFrame:
    e = c.t.events.withColumn("__cif", F.lpad(F.col("user_id").cast("string"), 8, "0"))
    cl = _current_clients(c).select("cifnumber", "cifwithcheckdigit")
    j = e.join(cl, cl["cifnumber"] == e["__cif"]).select(
        (F.col("user_id") * 10 + F.length("event_type")).alias("incident_number"),
        "cifwithcheckdigit", F.to_date("ts").alias("created"), F.col("event_type").alias("category"),
        "ts", "event_id")
    return latest_per_key(j, ["incident_number"], ["ts"], ties=[F.col("event_id").asc_nulls_last()],
                          keep_rn=True).drop("ts", "event_id")


@report("report_tollgate")
def report_tollgate(c: Ctx) -> DataFrame:
    t = c.fx.fx_auth.filter(F.col("tran_type") != "error")
    t = decode(t, "tran_type", DEVICE_TYPES, "device")
    j = stopped_card_activity(t, c.fx.fx_card)
    j = j.withColumn("__cif", F.lpad(F.col("cardno").cast("string"), 8, "0"))
    cl = _current_clients(c).select("cifnumber", "cifwithcheckdigit")
    j = j.join(cl, cl["cifnumber"] == j["__cif"])
    out = dedup(j.select("event_id", "datetime_req", F.to_date("datetime_req").alias("d"), "device",
                         "stopdate", fn.minor_units("tran_amount_req").alias("amount"),
                         "cifwithcheckdigit"))
    return out.orderBy("datetime_req")
