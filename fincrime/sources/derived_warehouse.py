"""A warehouse-shaped catalogue derived from the driver's TPC-H-like tables.

Every relation the ten reports read is derived, over whole tables, with plain
column expressions, so the full report pipelines run at the driver's scale
(bench) and not only on the tiny golden frames of the tests.

Mapping (one line each):
  customer  -> dimclient (with history rows), factclient (two snapshots), dimcard,
               dimaddress, d_client, factclientdailysummary
  orders    -> dimaccount, factcapout, dbo_incident, dbo_unathorisedtransactiondisputes,
               case_folder, creditapplicationoutcome, dbo_sm*/dbo_gd*
  lineitem  -> factdepositaccountdailycoverage, factloanaccountdailycoverage,
               factcreditcardaccountdailycoverage, facttransaction (contra pairs),
               dbo_utdaccounttransactions, dimdate, dimtime
  supplier  -> dimteller, d_teller, staff accounts in dimaccount
  nation    -> dimbranch, dimemployer, vwdimtransactionclassification; region ->
               dimclientcollections; part -> dimproduct
  events    -> vwpost_tran_leg_internal, dimcardtransactionindicators, dimmerchantcategory
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fincrime.sources.catalog import Warehouse
from fincrime.sources.driver import DriverTables

STAFF_ACCOUNT_BASE = 1_000_000_000
CLOSING_KEY = 20011231          # closing snapshot: every account present
CLOSING_DAY = "2001-12-31"


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _cif(k: Column) -> Column:
    return _pad(k, 8)


def _cwc(k: Column) -> Column:
    return F.concat(_pad(k, 8), (k % 10).cast("string"))


def _key(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def _money(c: Column) -> Column:
    return c.cast("decimal(23,2)")


def _share(amount: Column, rate: Column) -> Column:
    """A part of an amount, exact in decimals and rounded half up to cents."""
    return _money(_money(amount) * rate.cast("decimal(4,2)"))


def _card(k: Column) -> Column:
    return F.concat(F.lit("4"), _pad(k, 9))


def _client_key(custkey: Column) -> Column:
    return custkey * 10 + 1  # key of the current client version


class DerivedWarehouse:
    def __init__(self, t: DriverTables):
        self.t = t

    # -------------------------------------------------------------- dimensions
    def dimclient(self) -> DataFrame:
        c = self.t.customer
        k = F.col("c_custkey")

        def version(v: int) -> DataFrame:
            return c.select(
                (k * 10 + v).alias("clientkey"), _cif(k).alias("cifnumber"),
                _cwc(k).alias("cifwithcheckdigit"),
                F.when(k % 2 == 0, "MR").otherwise("MS").alias("titlename"),
                F.substring("c_name", 1, 1).alias("initials"),
                F.col("c_name").alias("firstname"),
                F.when(k % 4 == 0, " ").when(k % 11 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("c_mktsegment")).alias("middlefirstname"),
                F.when(k % 3 == 0, "").otherwise("M").alias("middlesecondname"),
                F.lit("").alias("middlethirdname"),
                F.col("c_mktsegment").alias("lastname"),
                F.date_add(F.lit("1950-01-01").cast("date"), (k * 37 % 18000).cast("int")).alias("birthdate"),
                F.make_timestamp_ntz(F.lit(2010) + (k % 10).cast("int"), F.lit(1) + (k % 12).cast("int"),
                                     F.lit(1), F.lit(9), F.lit(0), F.lit(0)).alias("clientcreatedate"),
                F.concat(F.lit("ID"), _pad(k, 10)).alias("partyidentifiertypenumber"),
                F.lit("NATIONAL ID").alias("partyidentifiertypename"),
                F.concat(F.lit("021"), _pad(k, 7)).alias("homephonenumber"),
                F.concat(F.lit("011"), _pad(k, 7)).alias("workphonenumber"),
                F.concat(F.lit("07"), _pad(k, 8)).alias("mobilephonenumber"),
                F.lit(v).alias("rowiscurrent"))
        return version(1).unionByName(version(0).filter(k % 3 == 0))

    def dimaccount(self) -> DataFrame:
        o = self.t.orders
        k, st = F.col("o_orderkey"), F.col("o_orderstatus")
        customer_accounts = o.select(
            k.alias("accountkey"), _pad(k, 9).alias("accountnumber"),
            F.concat(_pad(k, 9), (k % 10).cast("string")).alias("accountnumberwithcheckdigit"),
            st.alias("accountstatusname"), F.col("o_orderdate").alias("accountopendate"),
            F.when(st == "F", "SAV").when(st == "O", "LN").otherwise("CC").alias("accounttypecode"),
            F.lit("01").alias("accountcategorycode"),
            _cif(F.col("o_custkey")).alias("clientnumber"),
            F.when(k % 9 == 0, 0).otherwise(1).alias("rowiscurrent"))
        s = F.col("s_suppkey")
        staff_accounts = self.t.supplier.select(
            (s + STAFF_ACCOUNT_BASE).alias("accountkey"), _pad(s + STAFF_ACCOUNT_BASE, 10).alias("accountnumber"),
            F.concat(_pad(s + STAFF_ACCOUNT_BASE, 10), (s % 10).cast("string")).alias("accountnumberwithcheckdigit"),
            F.lit("F").alias("accountstatusname"),
            F.lit("2015-01-01 00:00:00").cast("timestamp_ntz").alias("accountopendate"),
            F.lit("SAV").alias("accounttypecode"), F.lit("01").alias("accountcategorycode"),
            _cif(s).alias("clientnumber"), F.lit(1).alias("rowiscurrent"))
        return customer_accounts.unionByName(staff_accounts)

    def dimproduct(self) -> DataFrame:
        st = self.t.orders.select("o_orderstatus").distinct()
        s = F.col("o_orderstatus")
        code = F.when(s == "F", "SAV").when(s == "O", "LN").otherwise("CC")
        return st.select(F.ascii(s).cast("bigint").alias("productkey"),
                         F.concat(code, F.lit("|01")).alias("productcode"),
                         F.concat(F.lit("Product "), s).alias("productname"),
                         F.when(s == "F", "Deposit").when(s == "O", "Loan").otherwise("Credit Card")
                          .alias("productgroupname"),
                         F.lit(1).alias("rowiscurrent"))

    def dimbranch(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
            F.col("n_nationkey").cast("bigint").alias("branchkey"),
            F.concat(F.lit("B"), _pad(F.col("n_nationkey"), 3)).alias("branchcode"),
            F.col("n_name").alias("branchname"), F.col("r_name").alias("provincename"),
            F.lit(1).alias("rowiscurrent"))

    def dimaddress(self) -> DataFrame:
        c = self.t.customer
        n = self.t.nation.select("n_nationkey", "n_name")
        k = F.col("c_custkey")
        return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
            k.alias("addresskey"), F.col("c_name").alias("addressline1text"),
            F.when(k % 2 == 0, "").otherwise(F.col("c_mktsegment")).alias("addressline2text"),
            F.when(k % 4 == 0, "").otherwise("L3").alias("addressline3text"),
            F.col("n_name").alias("addresscityname"), _pad(k % 10000, 4).alias("addresspostcode"),
            F.lit(1).alias("rowiscurrent"))

    def dimemployer(self) -> DataFrame:
        n, r = self.t.nation, self.t.region
        return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
            F.col("n_nationkey").cast("bigint").alias("employerkey"),
            F.concat(F.col("n_name"), F.lit(" STAFF")).alias("employername"),
            F.concat(F.lit("E"), _pad(F.col("n_nationkey"), 6)).alias("employernumberwithcheckdigit"),
            F.col("r_name").alias("employerindustrytypename"), F.lit(1).alias("rowiscurrent"))

    def dimteller(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.t.supplier.select(s.alias("tellerkey"), _pad(s, 6).alias("tellernumber"),
                                      F.col("s_name").alias("tellername"), F.lit(1).alias("rowiscurrent"))

    def dimclientcollections(self) -> DataFrame:
        return self.t.region.select(F.col("r_regionkey").cast("bigint").alias("clientcollectionskey"),
                                    F.col("r_name").alias("clientstatusname"), F.lit(1).alias("rowiscurrent"))

    def dimdate(self) -> DataFrame:
        d = self.t.lineitem.select(F.to_date("l_shipdate").alias("fulldate")).distinct()
        return d.select(_key(F.col("fulldate")).alias("datekey"), "fulldate", F.lit(1).alias("rowiscurrent"))

    def dimtime(self) -> DataFrame:
        ln = self.t.lineitem.select("l_linenumber").distinct()
        n = F.col("l_linenumber")
        return ln.select(n.cast("bigint").alias("timekey"),
                         F.make_timestamp_ntz(F.lit(2000), F.lit(1), F.lit(1), n + 7, (n * 7) % 60, F.lit(0))
                          .alias("fulltime"))

    def vwdimtransactionclassification(self) -> DataFrame:
        return self.t.nation.select(
            F.col("n_nationkey").cast("bigint").alias("transactionclassificationkey"),
            F.concat(F.lit("T"), _pad(F.col("n_nationkey"), 2)).alias("transactioncode"),
            F.col("n_name").alias("transactionclassificationname"), F.lit(1).alias("rowiscurrent"))

    def dimcard(self) -> DataFrame:
        k = F.col("c_custkey")
        nsup = self.t.supplier.count()  # one number to the driver: size of the teller set
        return self.t.customer.select(
            k.alias("cardkey"), _card(k).alias("cardnumber"), _card(k).alias("primarycardnumber"),
            F.when(k % 6 == 0, "S").otherwise("P").alias("cardholdertypecode"),
            F.when(k % 6 == 0, "Secondary").otherwise("Primary").alias("cardholdertypename"),
            F.lit("ACTIVE").alias("cardstatusname"), F.col("c_name").alias("embossedname"),
            F.concat(F.lit("ID"), _pad(k, 10)).alias("partyidentifiernumber"),
            F.lit("2021-02-03 10:00:00").cast("timestamp_ntz").alias("cardcreationdate"),
            F.lit("2027-02-28 00:00:00").cast("timestamp_ntz").alias("cardexpirydate"),
            F.lit(None).cast("timestamp_ntz").alias("cardreplacetimestamp"),
            F.when(k % 5 == 0, F.lit(None).cast("timestamp_ntz"))
             .otherwise(F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")).alias("cardstoptimestamp"),
            F.make_timestamp_ntz(F.lit(2021), F.lit(1) + (k % 12).cast("int"), F.lit(1), F.lit(8), F.lit(0),
                                 F.lit(0)).alias("cardactivetimestamp"),
            (k % nsup).cast("int").alias("cardactivatedtellernumber"),
            _cwc(k).alias("clientnumber"), F.lit(1).alias("rowiscurrent"))

    def _event_codes(self) -> DataFrame:
        e = self.t.events
        i = F.col("event_id")
        return e.select(
            F.col("event_type").alias("tran_type"),
            F.when(i % 10 == 0, "05").otherwise("00").alias("rsp_code_req"),
            F.when(F.col("event_type") == "purchase", "5999").otherwise("4829").alias("merchant_type"),
            F.when(i % 2 == 0, "05").otherwise("90").alias("pos_entry_mode"),
            F.when(i % 4 == 0, "0200").otherwise("0100").alias("message_type"))

    def dimcardtransactionindicators(self) -> DataFrame:
        c = self._event_codes()
        r = F.col("rsp_code_req")
        return c.select(
            F.col("tran_type").alias("cardtransactiontypecode"),
            F.upper("tran_type").alias("cardtransactiontypename"),
            F.lit("00").alias("extendedtransactiontypecode"), F.lit("None").alias("extendedtransactiontypename"),
            F.lit("00").alias("messagereasoncode"), F.lit("None").alias("messagereasonname"),
            r.alias("cardresponsecode"),
            F.when(r == "00", "Approved").otherwise("Do not honour").alias("cardresponsename"),
            F.col("pos_entry_mode").alias("pointofserviceentrymodecode"),
            F.when(F.col("pos_entry_mode") == "05", "Chip").otherwise("Contactless")
             .alias("pointofserviceentrymodename"),
            F.lit("00").alias("pointofserviceconditioncode"), F.lit("Normal").alias("pointofserviceconditionname"),
            F.col("message_type").alias("messagetypecode"),
            F.when(F.col("message_type") == "0100", "Authorisation").otherwise("Financial")
             .alias("messagetypename"),
            F.lit(1).alias("rowiscurrent"))  # one row per event: codes repeat, lookups de-duplicate

    def dimmerchantcategory(self) -> DataFrame:
        c = self._event_codes().select("merchant_type").distinct()
        return c.select(F.col("merchant_type").alias("merchantcategorycode"),
                        F.concat(F.lit("MCC "), F.col("merchant_type")).alias("merchantcategoryname"),
                        F.lit(1).alias("rowiscurrent"))

    def vwdimcurrency(self) -> DataFrame:
        return self.t.nation.select(F.col("n_name").alias("currencyalphacode"),
                                    _pad(F.col("n_nationkey"), 3).alias("currencynumericcode"),
                                    F.lit(1).alias("rowiscurrent"))

    # -------------------------------------------------------------- facts
    def factclient(self) -> DataFrame:
        c = self.t.customer.select("c_custkey", "c_nationkey")
        newest_acc = self.t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("__pa"))
        j = c.join(newest_acc, c["c_custkey"] == newest_acc["o_custkey"], "left")
        k = F.col("c_custkey")

        def snap(day: int, ts: str) -> DataFrame:
            return j.select(
                _client_key(k).alias("clientkey"), _cif(k).alias("cifnumber"),
                F.lit(day).alias("clientsnapshotdatekey"),
                F.lit(ts).cast("timestamp_ntz").alias("clientsnapshottimestamp"),
                _pad(F.col("__pa"), 9).alias("primarydepositaccountnumber"),
                k.alias("residentialaddresskey"), k.alias("postaladdresskey"),
                F.col("c_nationkey").cast("bigint").alias("employerkey"),
                (F.col("c_nationkey") % 5).cast("bigint").alias("clientcollectionskey"))
        # every seventh client is missing from the newest snapshot
        return snap(20240101, "2024-01-01 02:00:00").unionByName(
            snap(20240102, "2024-01-02 02:00:00").filter(k % 7 != 0))

    def factclientdailysummary(self) -> DataFrame:
        return self.t.customer.select(_client_key(F.col("c_custkey")).alias("clientkey"),
                                      F.col("c_nationkey").cast("bigint").alias("lastloanbranchkey"))

    def _lines(self) -> DataFrame:
        li = self.t.lineitem
        o = self.t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
        return li.join(o, li["l_orderkey"] == o["o_orderkey"])

    def factdepositaccountdailycoverage(self) -> DataFrame:
        # one row per line on its ship date, plus a closing snapshot on which
        # every account is present (as a real daily-coverage fact has)
        s = F.col("l_shipdate")
        daily = self.t.lineitem.select(
            F.col("l_orderkey").alias("accountkey"), _pad(F.col("l_orderkey"), 9).alias("accountnumber"),
            _money(F.col("l_extendedprice")).alias("currentbalanceamount"),
            F.lit(ord("F")).cast("bigint").alias("productkey"),
            (F.col("l_suppkey") % 25).alias("homebranchkey"),
            _key(s).alias("coveragedatekey"), F.to_date(s).alias("snapshotdate"),
            F.when(F.col("l_linenumber") == 7, 1).otherwise(0).alias("isfinalload"),
            _key(F.date_sub(F.to_date(s), 3)).alias("lastcusttrandatekey"),
            (F.col("l_linenumber") % 3).alias("stopsonaccountcount"))
        k = F.col("o_orderkey")
        closing = self.t.orders.select(
            k.alias("accountkey"), _pad(k, 9).alias("accountnumber"),
            _money(F.col("o_totalprice")).alias("currentbalanceamount"),
            F.lit(ord("F")).cast("bigint").alias("productkey"), (F.col("o_custkey") % 25).alias("homebranchkey"),
            F.lit(CLOSING_KEY).alias("coveragedatekey"), F.lit(CLOSING_DAY).cast("date").alias("snapshotdate"),
            F.lit(0).alias("isfinalload"), _key(F.col("o_orderdate")).alias("lastcusttrandatekey"),
            (k % 3).cast("int").alias("stopsonaccountcount"))
        return daily.unionByName(closing)

    def factloanaccountdailycoverage(self) -> DataFrame:
        s = F.col("l_shipdate")

        def rows(day: Column) -> DataFrame:
            return self._lines().select(
                F.col("l_orderkey").alias("accountkey"), _pad(F.col("l_orderkey"), 9).alias("accountnumber"),
                _client_key(F.col("o_custkey")).alias("clientkey"),
                F.lit(ord("O")).cast("bigint").alias("productkey"),
                (F.col("l_suppkey") % 25).alias("originatingbranchkey"),
                day.alias("coveragedatekey"), _key(F.col("o_orderdate")).alias("lastadvancedatekey"),
                _key(s).alias("lastarrearsdatekey"), F.col("l_linenumber").alias("arrearsinstallmentcount"),
                _money(F.col("l_extendedprice")).alias("loanbalanceamount"),
                _share(F.col("l_extendedprice"), F.col("l_discount")).alias("loanarrearsamount"),
                F.col("l_suppkey").alias("loanofficertellerkey"),
                (F.col("l_linenumber") % 5).cast("bigint").alias("clientcollectionskey"))
        # daily rows, plus the closing snapshot of every loan line
        return rows(_key(s)).unionByName(rows(F.lit(CLOSING_KEY)))

    def factcreditcardaccountdailycoverage(self) -> DataFrame:
        s = F.col("l_shipdate")
        return self._lines().select(
            _client_key(F.col("o_custkey")).alias("clientkey"), F.col("l_orderkey").alias("accountkey"),
            _pad(F.col("l_orderkey"), 9).alias("accountnumber"),
            _money(F.col("o_totalprice")).alias("creditlimitamount"),
            _money(-F.col("l_extendedprice")).alias("currentbalanceamount"),
            _share(F.col("l_extendedprice"), F.col("l_tax")).alias("arrearsamount"),
            _share(F.col("o_totalprice"), F.lit("0.50")).alias("qualifycreditlimitamount"),
            F.concat(F.lit("D"), (F.col("l_linenumber") % 4).cast("string")).alias("delinquencytext"),
            (F.col("l_linenumber") % 4).alias("delinquentlevelnumber"),
            (F.col("l_linenumber") * 30).alias("daysinarrearsnumber"),
            (F.col("l_linenumber") % 3).alias("stopsonaccountcount"),
            _key(s).alias("coveragedatekey"), F.to_date(s).alias("coveragedate"),
            _key(F.col("o_orderdate")).alias("accountopendatekey"),
            (F.col("l_suppkey") % 25).alias("openingbranchkey"))

    def factcapout(self) -> DataFrame:
        return self.t.orders.select(F.col("o_orderkey").alias("accountkey"),
                                    _money(F.col("o_totalprice")).alias("advanceamount"),
                                    (F.col("o_custkey") % 25).alias("transactionbranchkey"))

    def facttransaction(self) -> DataFrame:
        # every line is a debit on the customer's account; every line with status
        # 'F' also pays the same amount, same date/time/journal, into the staff
        # account of client number = supplier key (a contra pair)
        li = self._lines().select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                                  "l_linestatus", "l_extendedprice", "l_shipdate", "o_custkey")
        amt = _money(F.col("l_extendedprice"))
        day = _key(F.col("l_shipdate"))
        cls = (F.col("l_partkey") % 25)
        debit = F.struct(
            F.col("l_orderkey").alias("accountkey"), _client_key(F.col("o_custkey")).alias("clientkey"),
            (-amt).alias("transactionamount"), day.alias("transactiondatekey"),
            F.when(F.col("l_returnflag") == "R", 50).when(F.col("l_returnflag") == "A", 73).otherwise(10)
             .cast("bigint").alias("transactionindicatorskey"),
            cls.alias("transactionclassificationkey"), day.alias("postedtransactiondatekey"),
            F.col("l_linenumber").cast("bigint").alias("postedtransactiontimekey"),
            F.col("l_partkey").cast("string").alias("journalnumber"))
        credit = F.struct(
            (F.col("l_suppkey") + STAFF_ACCOUNT_BASE).alias("accountkey"),
            _client_key(F.col("l_suppkey")).alias("clientkey"),
            amt.alias("transactionamount"), day.alias("transactiondatekey"),
            F.lit(10).cast("bigint").alias("transactionindicatorskey"),
            cls.alias("transactionclassificationkey"), day.alias("postedtransactiondatekey"),
            F.col("l_linenumber").cast("bigint").alias("postedtransactiontimekey"),
            F.col("l_partkey").cast("string").alias("journalnumber"))
        roles = F.when(F.col("l_linestatus") == "F", F.array(debit, credit)).otherwise(F.array(debit))
        return li.select(F.explode(roles).alias("e")).select("e.*").withColumn(
            "postedmonth", F.expr("cast(postedtransactiondatekey div 100 as int)"))

    def vwpost_tran_leg_internal(self) -> DataFrame:
        e = self.t.events
        i = F.col("event_id")
        amount = F.when(i % 7 == 0, "").when(i % 5 == 0, "0").when(i % 13 == 0, F.lit(None).cast("string")) \
            .otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
        return e.select(
            F.col("ts").alias("datetime_req"), F.col("ts").alias("datetime_tran_local"),
            _card(F.col("user_id")).alias("pan"), _card(F.col("user_id")).alias("card_no_id"),
            amount.alias("tran_amount_req"), amount.alias("settle_amount_req"),
            F.col("event_type").alias("tran_type"), F.lit("00").alias("extended_tran_type"),
            F.when(i % 4 == 0, "0200").otherwise("0100").alias("message_type"),
            F.lit("00").alias("message_reason_code"),
            F.when(i % 10 == 0, "05").otherwise("00").alias("rsp_code_req"),
            F.when(i % 9 == 0, "114").otherwise("000").alias("hold_response_key"),
            F.when(i % 2 == 0, "05").otherwise("90").alias("pos_entry_mode"),
            F.lit("00").alias("pos_condition_code"),
            F.when(i % 3 == 0, "00").when(i % 3 == 1, "01").otherwise("99").alias("pos_terminal_type"),
            F.lit("5").alias("pos_card_data_input_ability"), F.lit("1").alias("pos_card_data_input_mode"),
            F.lit("0").alias("pos_cardholder_present"),
            F.concat(F.lit(" M"), (i % 500).cast("string"), F.lit(" ")).alias("card_acceptor_id_code"),
            F.concat(F.lit("SHOP "), (i % 500).cast("string")).alias("card_acceptor_name_loc"),
            F.when(F.col("event_type") == "purchase", "5999").otherwise("4829").alias("merchant_type"),
            F.concat(F.lit("T"), (i % 97).cast("string")).alias("terminal_id"),
            F.lit("400000").alias("acquiring_inst_id_code"), F.lit("710").alias("tran_currency_code"),
            F.when(i % 11 == 0, 1).otherwise(0).alias("tran_postilion_originated"),
            F.lit(1).alias("rowiscurrent"))

    # -------------------------------------------------------------- case, incident, credit systems
    def dbo_incident(self) -> DataFrame:
        o = self.t.orders
        return o.select(
            F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("recid"),
            F.concat(F.lit("INC"), F.col("o_custkey").cast("string"), F.lit("-"),
                     F.year("o_orderdate").cast("string")).alias("incidentnumber"),
            F.col("o_orderdate").alias("createddatetime"),
            F.when(F.col("o_orderstatus") == "F", "Closed").otherwise("Open").alias("status"),
            _cwc(F.col("o_custkey")).alias("clientcif"),
            F.lit(None).cast("string").alias("noncbclientidnumber"),
            F.concat(F.lit("AGENT "), (F.col("o_orderkey") % 40).cast("string")).alias("profilefullname"),
            F.col("o_orderpriority").alias("actualcategory"), F.lit("Card").alias("actualsubcategory"),
            F.lit("Dispute").alias("actualissue"), F.lit("Card dispute").alias("subject"),
            F.lit("Unknown debit").alias("symptom"), F.lit("Investigated").alias("resolution"),
            F.lit(1).alias("rowiscurrent"))

    def dbo_unathorisedtransactiondisputes(self) -> DataFrame:
        o = self.t.orders
        k = F.col("o_orderkey").cast("string")
        return o.select(
            F.concat(F.lit("D"), k).alias("recid"), F.concat(F.lit("R"), k).alias("incidentlink_recid"),
            F.concat(F.lit("TD"), k).alias("incidentnumber"), F.col("o_orderpriority").alias("fraudtype"),
            F.lit("Refund").alias("resolution"), F.col("o_orderdate").alias("createddatetime"),
            F.col("o_orderdate").alias("lastmoddatetime"), F.lit(1).alias("rowiscurrent"))

    def dbo_utdaccounttransactions(self) -> DataFrame:
        li = self._lines()
        k = F.col("l_orderkey").cast("string")
        n = F.col("l_linenumber")
        return li.select(
            F.concat(F.lit("D"), k).alias("parentlink_recid"),
            _money(-F.col("l_extendedprice")).alias("amount"), F.col("l_partkey").cast("string").alias("journalnumber"),
            F.concat(F.lit("X"), k, F.lit("-"), n.cast("string")).alias("incxid"),
            F.col("l_shipdate").alias("createddatetime"), _card(F.col("o_custkey")).alias("cardnumber"),
            F.when(n % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("U"), k)).alias("incidentnumber"),
            F.concat(F.lit("TC"), n.cast("string")).alias("trancode"),
            F.when(F.col("l_returnflag") == "R", "FEE").otherwise("POS").alias("trantype"),
            F.when(n % 6 == 0, "Monthly fee").otherwise(F.concat(F.lit("Line "), n.cast("string")))
             .alias("additionaldescription"),
            F.lit("Y").alias("fraud"),
            F.when(F.col("l_linestatus") == "F", "Yes").otherwise("No").alias("disputed"),
            F.lit(1).alias("rowiscurrent"))

    def case_folder(self) -> DataFrame:
        o = self.t.orders
        return o.select(
            F.concat(F.lit("CASE"), F.col("o_orderkey").cast("string")).alias("case_id"),
            F.col("o_orderdate").alias("case_creation_date"),
            F.concat(F.lit("SURNAME"), (F.col("o_custkey") % 100).cast("string")).alias("case_client_surname"),
            F.concat(F.lit("ID"), _pad(F.col("o_custkey"), 10)).alias("case_id_passport_no"),
            F.lit("FIRST").alias("case_client_first_name"),
            F.concat(F.lit("CP"), (F.col("o_orderkey") % 30).cast("string")).alias("serving_consultant_cp_no"))

    def creditapplicationoutcome(self) -> DataFrame:
        o = self.t.orders
        return o.select(
            _cwc(F.col("o_custkey")).alias("cifwithcheckdigit"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "A-NEW").otherwise("B-EXISTING")
             .alias("clienttype"),
            F.to_date("o_orderdate").alias("lrid_date"),
            F.concat(F.lit("LR"), F.col("o_orderkey").cast("string")).alias("logical_record_id"))

    def dbo_smapplication(self) -> DataFrame:
        o = self.t.orders
        return o.select(F.concat(F.lit("LR"), F.col("o_orderkey").cast("string")).alias("logicalrecordid"),
                        F.col("o_orderpriority").alias("loanpurpose"),
                        F.concat(F.lit("SHOP"), (F.col("o_custkey") % 50).cast("string")).alias("retailername"))

    def dbo_smsmresults(self) -> DataFrame:
        o = self.t.orders
        return o.select(F.concat(F.lit("LR"), F.col("o_orderkey").cast("string")).alias("logicalrecordid"),
                        F.col("o_orderstatus").alias("privatesector"))

    def dbo_gdcreditpolicystrategy(self) -> DataFrame:
        o = self.t.orders
        return o.select(F.concat(F.lit("LR"), F.col("o_orderkey").cast("string")).alias("logicalrecordid"),
                        (F.col("o_totalprice") % 1000).cast("int").alias("score_mi"))

    def d_client(self) -> DataFrame:
        nsup = self.t.supplier.count()
        return self.t.customer.select(_cif(F.col("c_custkey")).alias("cif"),
                                      (F.col("c_custkey") % nsup).alias("teller_key"))

    def d_teller(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.t.supplier.select(s.alias("teller_key"), _pad(s, 6).alias("teller_no"),
                                      F.col("s_name").alias("teller_name"))


RELATIONS = [
    "dimclient", "dimaccount", "dimproduct", "dimbranch", "dimaddress", "dimemployer", "dimteller",
    "dimclientcollections", "dimdate", "dimtime", "vwdimtransactionclassification", "dimcard",
    "dimcardtransactionindicators", "dimmerchantcategory", "vwdimcurrency", "factclient",
    "factclientdailysummary", "factdepositaccountdailycoverage", "factloanaccountdailycoverage",
    "factcreditcardaccountdailycoverage", "factcapout", "facttransaction", "vwpost_tran_leg_internal",
    "dbo_incident", "dbo_unathorisedtransactiondisputes", "dbo_utdaccounttransactions", "case_folder",
    "creditapplicationoutcome", "dbo_smapplication", "dbo_smsmresults", "dbo_gdcreditpolicystrategy",
    "d_client", "d_teller",
]

# Columns by which a relation's files are partitioned.
PARTITIONS = {"facttransaction": ["postedmonth"]}


def warehouse_from_driver(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All report relations derived from one folder of driver tables."""
    dw = DerivedWarehouse(DriverTables(spark, sf_dir))
    srcs = {name: getattr(dw, name)() for name in RELATIONS}
    srcs["vwfacttransaction"] = srcs["facttransaction"]
    return Warehouse(spark, srcs)


def materialise(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """Write every derived relation once as parquet under ``root`` (a shared
    folder) and return a catalogue that reads them, as a real warehouse is read."""
    wh = warehouse_from_driver(spark, sf_dir)
    for name in RELATIONS:
        by = PARTITIONS.get(name, [])
        df = wh[name].repartition(*by) if by else wh[name]
        (df.write.partitionBy(*by) if by else df.write).mode("overwrite").parquet(f"{root}/{name}")
    srcs = {name: f"{root}/{name}" for name in RELATIONS}
    srcs["vwfacttransaction"] = srcs["facttransaction"]
    return Warehouse(spark, srcs)
