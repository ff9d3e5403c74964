"""Warehouse-shaped views derived from the driver's TPC-H-like tables.

The driver tables have no history flag, no negative amounts, no blanks and
no padded keys, so these views derive them, over whole tables, with plain
column expressions (the oracle SQL defines the same views for DuckDB).

fx_client   client dimension with history rows, blanks and nulls
fx_account  account dimension (padded numbers, some non-current rows)
fx_daily    daily balance snapshot (yyyymmdd key, decimal money)
fx_legs     distinct ledger legs (helper of fx_ledger)
fx_ledger   transaction ledger with contra pairs
fx_card     cards, some without a stop date
fx_auth     card messages with amounts as text in minor units
fx_teller   tellers with zero-padded numbers
fx_code     code table with duplicate codes and a current flag
fx_addr     addresses with empty lines
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime.sources.driver import DriverTables


def _pad(c, n: int):
    return F.lpad(F.col(c).cast("string"), n, "0") if isinstance(c, str) else F.lpad(c.cast("string"), n, "0")


class Fixtures:
    """Lazily built, memoised derived views over one set of driver tables."""

    def __init__(self, t: DriverTables):
        self.t = t
        self._memo: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if not name.startswith("fx_"):
            raise AttributeError(name)
        if name not in self._memo:
            self._memo[name] = getattr(self, "_" + name)()
        return self._memo[name]

    def _fx_client(self) -> DataFrame:
        c = self.t.customer
        k = F.col("c_custkey")

        def version(v: int) -> DataFrame:
            return c.select(
                (k * 10 + v).alias("clientkey"),
                _pad("c_custkey", 8).alias("cifnumber"),
                F.concat(_pad("c_custkey", 8), (k % 10).cast("string")).alias("cifwithcheckdigit"),
                F.col("c_name").alias("firstname"),
                F.when(k % 4 == 0, F.lit(" ")).when(k % 11 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("c_mktsegment")).alias("middlefirstname"),
                F.when(k % 3 == 0, F.lit("")).otherwise(F.lit("M")).alias("middlesecondname"),
                F.lit("").alias("middlethirdname"),
                F.col("c_mktsegment").alias("lastname"),
                F.lit(v).alias("rowiscurrent"))

        # every customer has a current version; every third also an old one
        return version(1).unionByName(version(0).filter(k % 3 == 0))

    def _fx_account(self) -> DataFrame:
        o = self.t.orders
        return o.select(
            F.col("o_orderkey").alias("accountkey"),
            _pad("o_orderkey", 9).alias("accountnumber"),
            _pad("o_custkey", 8).alias("clientnumber"),
            F.to_date("o_orderdate").alias("accountopendate"),
            F.col("o_orderstatus").alias("accountstatusname"),
            F.when(F.col("o_orderkey") % 9 == 0, 0).otherwise(1).alias("rowiscurrent"))

    def _fx_daily(self) -> DataFrame:
        s = F.col("l_shipdate")
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("accountkey"),
            (F.year(s) * 10000 + F.month(s) * 100 + F.dayofmonth(s)).alias("coveragedatekey"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("currentbalanceamount"),
            (F.col("l_linenumber") % 3).alias("stopsonaccountcount"))

    def _fx_legs(self) -> DataFrame:
        li = self.t.lineitem
        o = self.t.orders.select("o_orderkey", "o_custkey")
        return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
                  .select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber",
                          F.to_date("l_shipdate").alias("d"),
                          F.col("l_extendedprice").cast("decimal(18,2)").alias("amt"),
                          "l_returnflag", "l_linestatus", "o_custkey")
                  .dropDuplicates())

    def _fx_ledger(self) -> DataFrame:
        # Each leg becomes one debit entry and, when its line status is 'F',
        # also one credit entry on a supplier account.  Built with explode
        # rather than UNION ALL so that every read of the ledger shares one
        # de-duplicated leg set (the same subplan, so its exchange is reused).
        legs = self.fx_legs
        debit = F.struct(
            F.col("l_orderkey").alias("accountkey"),
            F.col("o_custkey").alias("clientkey"),
            (-F.col("amt")).alias("transactionamount"),
            F.col("d").alias("transactiondate"),
            F.col("l_linenumber").alias("timekey"),
            F.col("l_partkey").alias("journalnumber"),
            F.when(F.col("l_returnflag") == "R", 50).when(F.col("l_returnflag") == "A", 73)
             .otherwise(10).alias("transactionindicatorskey"))
        supplier = F.col("l_suppkey") + 1000000000
        credit = F.struct(
            supplier.alias("accountkey"),
            supplier.alias("clientkey"),
            F.col("amt").alias("transactionamount"),
            F.col("d").alias("transactiondate"),
            F.col("l_linenumber").alias("timekey"),
            F.col("l_partkey").alias("journalnumber"),
            F.lit(10).alias("transactionindicatorskey"))
        roles = F.when(F.col("l_linestatus") == "F", F.array(debit, credit)).otherwise(F.array(debit))
        return legs.select(F.explode(roles).alias("e")).select("e.*")

    def _fx_card(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.t.customer.select(
            k.alias("cardno"),
            F.when(k % 5 == 0, F.lit(None).cast("date"))
             .otherwise(F.lit(_dt.date(2024, 1, 5))).alias("stopdate"))

    def _fx_auth(self) -> DataFrame:
        e = F.col("event_id")
        minor = F.round(F.col("value") * 100).cast("bigint").cast("string")
        return self.t.events.select(
            "event_id",
            F.col("user_id").alias("cardno"),
            F.col("ts").alias("datetime_req"),
            F.col("event_type").alias("tran_type"),
            F.when(e % 7 == 0, F.lit("")).when(e % 5 == 0, F.lit("0"))
             .when(e % 13 == 0, F.lit(None).cast("string")).otherwise(minor)
             .alias("tran_amount_req"))

    def _fx_teller(self) -> DataFrame:
        return self.t.supplier.select(
            F.col("s_suppkey").alias("tellerkey"),
            _pad("s_suppkey", 6).alias("tellernumber"),
            F.col("s_name").alias("tellername"))

    def _fx_code(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_brand").alias("code"), F.col("p_type").alias("name"),
            (F.col("p_size") % 2).alias("rowiscurrent"))

    def _fx_addr(self) -> DataFrame:
        c = self.t.customer
        n = self.t.nation.select("n_nationkey", "n_name")
        k = F.col("c_custkey")
        return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
                 .select(k.alias("addresskey"), F.col("c_name").alias("l1"),
                         F.when(k % 2 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("l2"),
                         F.when(k % 4 == 0, F.lit("")).otherwise(F.lit("L3")).alias("l3"),
                         F.col("n_name").alias("city"),
                         F.lpad((k % 10000).cast("string"), 4, "0").alias("postcode")))
