"""One keyed query per operator, on the driver tables and derived views.

Each function takes a ``Ctx`` and returns a DataFrame; ``registry`` wraps
them as ``(spark, sf_dir) -> DataFrame``.  Column names match the oracle
SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import (code_lookup, decode, dedup, first_per_key, flagged_accounts,
                                key_frame, latest_per_key, latest_snapshot, number_rows,
                                scd2_current, semi_join_keys, union_all)
from fincrime.operators.clients import accounts_of_client, cards_of_client, stopped_card_activity
from fincrime.operators.matching import contra_entry_match, recent_ledger
from fincrime.operators.numbering import global_rank
from fincrime.plans.context import Ctx, d, ts_lit
from fincrime.session import new_shared_path
from fincrime.sources.catalog import Warehouse
from fincrime.sources.derived_warehouse import DerivedWarehouse
from fincrime.sources.sinks import write_report

OPERATOR_KEYS: dict[str, callable] = {}

# Fixed search inputs and thresholds of the fixtures (invented values).
SEARCH_CUSTOMERS = [1, 7, 42]
AS_OF = "2024-07-15"
FLAG_CODES = [50, 73]


def key(name: str):
    def reg(f):
        OPERATOR_KEYS[name] = f
        return f
    return reg


# ---------------------------------------------------------------- scans, sources
@key("scan_base")
def scan_base(c: Ctx) -> DataFrame:
    return c.t.customer


@key("scan_view")
def scan_view(c: Ctx) -> DataFrame:
    # a name of its own: views belong to the session, and another folder's query may be open in it
    name = f"fx_final_orders_{uuid.uuid4().hex}"
    c.t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey").createTempView(name)
    return c.spark.table(name)


@key("multi_schema_catalogue")
def multi_schema_catalogue(c: Ctx) -> DataFrame:
    # one short name in two schemas: a qualified name says which, in any case; a short name that only one has needs no schema
    t = c.t
    wh = Warehouse(c.spark, {
        "core.dimparty": t.customer.select(F.col("c_custkey").alias("PartyKey"), F.col("c_nationkey").alias("NationKey")),
        "mis.dimparty": t.supplier.select(F.col("s_suppkey").alias("partykey"), F.col("s_name").alias("agentname")),
        "core.dimnation": t.nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nationname"))})
    return wh["CORE.DimParty"].join(wh["mis.DIMPARTY"], "partykey", "left").join(wh["dimnation"], "nationkey") \
        .select("partykey", "agentname", "nationname")


@key("report_output")
def report_output(c: Ctx) -> DataFrame:
    # a committed, partitioned write, and what a consumer of one partition and of all reads back
    o = c.t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    path = new_shared_path(c.spark, "report-output")
    write_report(o, path, partition_by=["o_orderstatus"])
    written = c.spark.read.parquet(path)
    return written.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", F.lit("partition").alias("read")) \
        .unionByName(written.select("o_orderkey", "o_custkey", F.lit("whole").alias("read")))


@key("inline_relation")
def inline_relation(c: Ctx) -> DataFrame:
    o = c.t.orders.select("o_orderkey", "o_orderstatus")
    return decode(o, "o_orderstatus", {"F": "Final", "O": "Open"}, "label") \
        .select("o_orderkey", "label")


@key("search_keys")
def search_keys(c: Ctx) -> DataFrame:
    keys = key_frame(c.spark, SEARCH_CUSTOMERS, "k", "bigint")
    return semi_join_keys(c.t.customer, "c_custkey", keys).select("c_custkey", "c_name")


# ---------------------------------------------------------------- projections
@key("project_rename")
def project_rename(c: Ctx) -> DataFrame:
    return c.t.customer.select(F.col("c_custkey").alias("client_key"),
                               F.col("c_name").alias("full_name"))


@key("select_star")
def select_star(c: Ctx) -> DataFrame:
    return c.t.region.select("*")


@key("constant_columns")
def constant_columns(c: Ctx) -> DataFrame:
    return c.t.customer.select("c_custkey", F.lit("").alias("ref"), F.lit("X").alias("tag"))


@key("quoted_names")
def quoted_names(c: Ctx) -> DataFrame:
    return c.t.customer.select("c_custkey", F.col("c_name").alias("E-mail"))


@key("alias_reuse")
def alias_reuse(c: Ctx) -> DataFrame:
    o = c.t.orders.withColumn("y", F.year("o_orderdate"))
    return dedup(o.filter(F.col("y") >= 1999).select("y", "o_orderstatus"))


@key("derived_projection")
def derived_projection(c: Ctx) -> DataFrame:
    a = c.t.orders.select("o_orderkey", "o_custkey")
    b = c.t.customer.select("c_custkey", "c_name")
    return a.join(b, b["c_custkey"] == a["o_custkey"]).select("o_orderkey", "c_name")


def _final_orders(c: Ctx) -> DataFrame:
    return c.t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


def _with_nation(df: DataFrame, c: Ctx) -> DataFrame:
    n = c.t.nation.select("n_nationkey", "n_name")
    return df.join(n, n["n_nationkey"] == df["c_nationkey"])


@key("cte_chain")
def cte_chain(c: Ctx) -> DataFrame:
    a = _final_orders(c)
    cu = c.t.customer.select("c_custkey", "c_nationkey")
    b = a.join(cu, cu["c_custkey"] == a["o_custkey"]).select("o_orderkey", "c_nationkey")
    return _with_nation(b, c).select("o_orderkey", "n_name")


@key("nested_cte")
def nested_cte(c: Ctx) -> DataFrame:
    def inner() -> DataFrame:
        def b() -> DataFrame:
            return c.t.customer.filter(F.col("c_acctbal") > 0).select("c_custkey", "c_nationkey")
        return b().select("c_custkey", "c_nationkey")
    return _with_nation(inner(), c).select("c_custkey", "n_name")


@key("arith_projection")
def arith_projection(c: Ctx) -> DataFrame:
    return c.t.orders.select(
        "o_orderkey",
        fn.credit_available(F.col("o_totalprice").cast("decimal(18,2)"),
                            F.lit(1000).cast("decimal(18,2)")).alias("available"))


# ---------------------------------------------------------------- filters
@key("filter_eq")
def filter_eq(c: Ctx) -> DataFrame:
    return c.t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")


@key("filter_cmp")
def filter_cmp(c: Ctx) -> DataFrame:
    return c.t.customer.filter((F.col("c_acctbal") < 0) & (F.col("c_nationkey") != 3)) \
        .select("c_custkey")


@key("filter_in_list")
def filter_in_list(c: Ctx) -> DataFrame:
    return c.t.orders.filter(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey")


@key("filter_not_in_list")
def filter_not_in_list(c: Ctx) -> DataFrame:
    return c.t.orders.filter(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")) \
        .select("o_orderkey")


@key("filter_in_subquery")
def filter_in_subquery(c: Ctx) -> DataFrame:
    big = c.t.orders.filter(F.col("o_totalprice") > 400000).select("o_custkey")
    return semi_join_keys(c.t.customer, "c_custkey", big).select("c_custkey")


@key("filter_scalar_subquery")
def filter_scalar_subquery(c: Ctx) -> DataFrame:
    return latest_snapshot(c.t.orders, "o_custkey").select("o_orderkey")


@key("latest_snapshot")
def latest_snapshot_key(c: Ctx) -> DataFrame:
    return latest_snapshot(c.fx.fx_daily, "coveragedatekey")


@key("filter_between")
def filter_between(c: Ctx) -> DataFrame:
    # inclusive on dates, written on the raw timestamp so it stays sargable
    ts = F.col("o_orderdate")
    return c.t.orders.filter((ts >= ts_lit("1997-01-01 00:00:00")) &
                             (ts < ts_lit("1997-07-01 00:00:00"))).select("o_orderkey")


@key("filter_like")
def filter_like(c: Ctx) -> DataFrame:
    return c.t.part.filter(F.col("p_name").contains("widget")).select("p_partkey")


@key("filter_not_like_ci")
def filter_not_like_ci(c: Ctx) -> DataFrame:
    return c.t.part.filter(~F.lower("p_name").contains("bolt")).select("p_partkey")


@key("filter_eq_ci")
def filter_eq_ci(c: Ctx) -> DataFrame:
    return c.t.orders.filter(F.lower("o_orderstatus") == "f").select("o_orderkey")


@key("filter_not_null")
def filter_not_null(c: Ctx) -> DataFrame:
    return c.fx.fx_auth.filter(F.col("tran_amount_req").isNotNull()).select("event_id")


@key("filter_day")
def filter_day(c: Ctx) -> DataFrame:
    return c.t.events.filter(fn.day_filter("ts", "2024-01-10")).select("event_id")


@key("filter_ts_after")
def filter_ts_after(c: Ctx) -> DataFrame:
    return c.t.events.filter(F.col("ts") > ts_lit("2024-01-15 06:00:00")).select("event_id")


@key("filter_col_vs_col")
def filter_col_vs_col(c: Ctx) -> DataFrame:
    a = c.fx.fx_auth
    return stopped_card_activity(a, c.fx.fx_card).select("event_id", a["cardno"])


@key("filter_year_month")
def filter_year_month(c: Ctx) -> DataFrame:
    # month floor of (as_of - 30 days) with as_of = 2001-07-01 -> 2001-06-01
    return c.t.orders.filter(fn.month_floor_filter("o_orderdate", "2001-07-01", 30)) \
        .select("o_orderkey")


@key("filter_or_across_tables")
def filter_or_across_tables(c: Ctx) -> DataFrame:
    o = c.t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    cu = c.t.customer.select("c_custkey", "c_mktsegment")
    j = o.join(cu, cu["c_custkey"] == o["o_custkey"])
    cond = ((F.col("o_orderstatus") == "F") & (F.col("c_mktsegment") == "MACHINERY")) | \
           (F.col("c_custkey") == 7)
    return j.filter(cond).select("o_orderkey")


@key("filter_blank")
def filter_blank(c: Ctx) -> DataFrame:
    return c.fx.fx_client.filter(F.trim("middlefirstname") == "").select("clientkey")


@key("filter_typed_literal")
def filter_typed_literal(c: Ctx) -> DataFrame:
    # slash-form literal parsed explicitly (an ANSI cast would raise)
    return c.t.orders.filter(fn.day_filter("o_orderdate", "1997/04/04")).select("o_orderkey")


# ---------------------------------------------------------------- joins
@key("join_inner")
def join_inner(c: Ctx) -> DataFrame:
    o, cu = c.t.orders, c.t.customer
    return o.join(cu, cu["c_custkey"] == o["o_custkey"]).select("o_orderkey", "c_name")


@key("join_left")
def join_left(c: Ctx) -> DataFrame:
    cu = c.t.customer
    o = c.t.orders.filter(F.col("o_totalprice") > 450000)
    return cu.join(o, o["o_custkey"] == cu["c_custkey"], "left").select("c_custkey", "o_orderkey")


@key("join_left_on_filter")
def join_left_on_filter(c: Ctx) -> DataFrame:
    cu = c.t.customer
    o = c.t.orders.filter(F.col("o_orderstatus") == "F")
    return cu.join(o, o["o_custkey"] == cu["c_custkey"], "left").select("c_custkey", "o_orderkey")


@key("join_left_on_or")
def join_left_on_or(c: Ctx) -> DataFrame:
    o, cu = c.t.orders, c.t.customer
    top = cu.select(F.max("c_acctbal")).scalar()
    right = cu.filter((F.col("c_acctbal") == top) | (F.col("c_nationkey") == 1))
    return o.join(right, right["c_custkey"] == o["o_custkey"], "left") \
        .select("o_orderkey", "c_custkey")


@key("join_inner_on_filter")
def join_inner_on_filter(c: Ctx) -> DataFrame:
    o = c.t.orders
    cu = c.t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return o.join(cu, cu["c_custkey"] == o["o_custkey"]).select("o_orderkey")


@key("join_nested_tree")
def join_nested_tree(c: Ctx) -> DataFrame:
    # A left join (B inner join C): the right side is built first, so an
    # order is padded unless BOTH its customer and that customer's nation match.
    o = c.t.orders
    n = c.t.nation.filter(F.col("n_nationkey") < 5).select("n_nationkey", "n_name")
    bc = c.t.customer.join(n, n["n_nationkey"] == F.col("c_nationkey")).select("c_custkey", "n_name")
    return o.join(bc, bc["c_custkey"] == o["o_custkey"], "left").select("o_orderkey", "n_name")


@key("join_prefix_key")
def join_prefix_key(c: Ctx) -> DataFrame:
    a = c.fx.fx_account
    cl = scd2_current(c.fx.fx_client).select(
        "clientkey", fn.strip_check_digit("cifwithcheckdigit", 8).alias("__base"))
    return a.join(cl, a["clientnumber"] == cl["__base"]).select("accountkey", "clientkey")


@key("join_cast_key")
def join_cast_key(c: Ctx) -> DataFrame:
    t = c.fx.fx_teller.withColumn("__n", fn.try_long("tellernumber"))
    cu = c.t.customer.select("c_custkey")
    return t.join(cu, cu["c_custkey"] == t["__n"]).select("tellerkey", "c_custkey")


@key("join_composite_key")
def join_composite_key(c: Ctx) -> DataFrame:
    p = c.t.part
    dd = p.groupBy(fn.composite_key("p_brand", "p_type").alias("code")).agg(F.max("p_size").alias("n"))
    a = p.withColumn("__code", fn.composite_key("p_brand", "p_type"))
    return a.join(dd, dd["code"] == a["__code"]).select("p_partkey", "n")


@key("join_role_playing")
def join_role_playing(c: Ctx) -> DataFrame:
    li = c.t.lineitem.select("l_orderkey", "l_suppkey")
    o = c.t.orders.select("o_orderkey", "o_custkey")
    cu = c.t.customer.select("c_custkey", "c_nationkey")
    s = c.t.supplier.select("s_suppkey", "s_nationkey")
    n = c.t.nation.select("n_nationkey", "n_name")
    client_nation = n.select(F.col("n_nationkey").alias("__cn"), F.col("n_name").alias("client_nation"))
    supp_nation = n.select(F.col("n_nationkey").alias("__sn"), F.col("n_name").alias("supp_nation"))
    j = (li.join(o, o["o_orderkey"] == li["l_orderkey"])
           .join(cu, cu["c_custkey"] == o["o_custkey"])
           .join(s, s["s_suppkey"] == li["l_suppkey"])
           .join(client_nation, F.col("__cn") == F.col("c_nationkey"))
           .join(supp_nation, F.col("__sn") == F.col("s_nationkey")))
    return j.select("l_orderkey", "client_nation", "supp_nation")


@key("join_scd2_current")
def join_scd2_current(c: Ctx) -> DataFrame:
    a = scd2_current(c.fx.fx_account).select("accountkey", "clientnumber")
    cl = scd2_current(c.fx.fx_client).select("clientkey", "cifnumber")
    return a.join(cl, cl["cifnumber"] == a["clientnumber"]).select("accountkey", "clientkey")


@key("join_history_fanout")
def join_history_fanout(c: Ctx) -> DataFrame:
    a = c.fx.fx_account.select("accountkey", "clientnumber")
    cl = c.fx.fx_client.select("clientkey", "cifnumber")
    return a.join(cl, cl["cifnumber"] == a["clientnumber"]).select("accountkey", "clientkey")


@key("join_dedup_dim")
def join_dedup_dim(c: Ctx) -> DataFrame:
    p = c.t.part.select("p_partkey", "p_brand")
    return code_lookup(p, c.fx.fx_code, "p_brand", "code", ["name"], current_only=True) \
        .select("p_partkey", "name")


def _ledger_roles(c: Ctx):
    lg = c.fx.fx_ledger
    return (lg.filter(F.col("transactionamount") < 0).alias("a"),
            lg.filter(F.col("transactionamount") > 0).alias("b"))


@key("join_multi_key")
def join_multi_key(c: Ctx) -> DataFrame:
    # debit legs joined to credit legs on date + time + journal
    a, b = _ledger_roles(c)
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("transactiondate", "timekey", "journalnumber")]
    return a.join(b, cond).select(F.col("a.accountkey"), F.col("b.accountkey").alias("other"))


@key("join_residual")
def join_residual(c: Ctx) -> DataFrame:
    # equi part (date, journal) is hashed; the two <> tests are a residual
    a, b = _ledger_roles(c)
    cond = [F.col("a.transactiondate") == F.col("b.transactiondate"),
            F.col("a.journalnumber") == F.col("b.journalnumber"),
            F.col("a.accountkey") != F.col("b.accountkey"),
            F.col("a.clientkey") != F.col("b.clientkey")]
    return a.join(b, cond).select(F.col("a.accountkey"), F.col("b.accountkey").alias("other"))


@key("contra_entry")
def contra_entry(c: Ctx) -> DataFrame:
    lg = c.fx.fx_ledger
    pairs = contra_entry_match(lg, flagged_accounts(lg, FLAG_CODES))
    return pairs.select(F.col("credit_account"), F.col("debit_account"), "journalnumber",
                        F.col("credit_amount").alias("credit"), F.col("debit_amount").alias("debit"))


@key("recent_ledger")
def recent_ledger_key(c: Ctx) -> DataFrame:
    # D14 on an integer key with its month beside it, as the partitioned ledger has them
    lg = DerivedWarehouse(c.t).facttransaction()
    return recent_ledger(lg, d("1999-01-31"), date_col="postedtransactiondatekey") \
        .select("accountkey", "transactionamount", "postedtransactiondatekey", "journalnumber")


@key("cards_of_client")
def cards_of_client_key(c: Ctx) -> DataFrame:
    # D27: prefix semi-join, then the newest card key of each set of card attributes
    clients = c.fx.fx_client.filter((F.col("lastname") == "BUILDING") & (F.col("rowiscurrent") == 1)).select("cifnumber")
    return cards_of_client(DerivedWarehouse(c.t).dimcard(), clients) \
        .select("card_clientnumber", "cardnumber", "cardholdertypecode", "embossedname", "cardkey")


@key("join_left_null_rejected")
def join_left_null_rejected(c: Ctx) -> DataFrame:
    # a WHERE on the padded side rejects nulls: written as the inner join it is
    o = c.t.orders.select("o_orderkey", "o_custkey")
    cu = c.t.customer.filter(F.col("c_acctbal") > 0).select("c_custkey")
    return o.join(cu, cu["c_custkey"] == o["o_custkey"]).select("o_orderkey")


@key("join_fact_fact")
def join_fact_fact(c: Ctx) -> DataFrame:
    # collapse the many side before the join (the result is DISTINCT anyway)
    li = dedup(c.t.lineitem.select("l_orderkey", "l_returnflag"))
    o = c.t.orders.select("o_orderkey")
    return li.join(o, o["o_orderkey"] == li["l_orderkey"]).select("o_orderkey", "l_returnflag")


@key("join_existence")
def join_existence(c: Ctx) -> DataFrame:
    # the joined columns are unused: only whether and how often a row matches could matter, and DISTINCT takes that back
    o = c.t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    return dedup(c.t.customer.join(o, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey"))


@key("join_existence_inner")
def join_existence_inner(c: Ctx) -> DataFrame:
    # the inner form keeps the keys that match at all: a semi-join
    return dedup(c.t.customer.join(c.t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey"))


@key("join_on_scalar_subquery")
def join_on_scalar_subquery(c: Ctx) -> DataFrame:
    a = c.fx.fx_account.select("accountkey")
    dd = latest_snapshot(c.fx.fx_daily, "coveragedatekey").select(
        F.col("accountkey").alias("__a"), "currentbalanceamount")
    return a.join(dd, dd["__a"] == a["accountkey"]).select("accountkey", "currentbalanceamount")


# ---------------------------------------------------------------- aggregation
@key("agg_distinct")
def agg_distinct(c: Ctx) -> DataFrame:
    return c.t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@key("agg_group_dedup")
def agg_group_dedup(c: Ctx) -> DataFrame:
    return dedup(c.t.customer.select("c_mktsegment", "c_nationkey"))


@key("agg_group_max")
def agg_group_max(c: Ctx) -> DataFrame:
    return c.t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("max_key"))


@key("agg_global_max")
def agg_global_max(c: Ctx) -> DataFrame:
    return c.fx.fx_daily.agg(F.max("coveragedatekey").alias("m"))


@key("agg_group_ordinal")
def agg_group_ordinal(c: Ctx) -> DataFrame:
    return dedup(c.t.part.select("p_brand", "p_type"))


@key("agg_group_expr")
def agg_group_expr(c: Ctx) -> DataFrame:
    return c.t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.max("o_orderkey").alias("m"))


@key("dedup_then_number")
def dedup_then_number(c: Ctx) -> DataFrame:
    q = dedup(c.t.customer.select("c_nationkey", "c_mktsegment"))
    return number_rows(q, ["c_nationkey"], ["c_mktsegment"], ties=[], ascending=True)


# ---------------------------------------------------------------- windows
def _orders_rn(c: Ctx, parts, ascending: bool) -> DataFrame:
    o = c.t.orders
    return number_rows(o, parts, ["o_orderdate"], ties=[("o_orderkey", True)], ascending=ascending).select("o_orderkey", "rn")


@key("win_rownum_desc")
def win_rownum_desc(c: Ctx) -> DataFrame:
    return _orders_rn(c, ["o_custkey"], False)


@key("win_rownum_multi_part")
def win_rownum_multi_part(c: Ctx) -> DataFrame:
    return _orders_rn(c, ["o_custkey", "o_orderstatus"], False)


@key("win_rownum_asc")
def win_rownum_asc(c: Ctx) -> DataFrame:
    return _orders_rn(c, ["o_custkey"], True)


@key("win_rownum_multi_order")
def win_rownum_multi_order(c: Ctx) -> DataFrame:
    e = c.t.events
    return number_rows(e, ["user_id"], [(F.to_date("ts"), False), ("ts", False)],
                       ties=[("event_id", True)]).select("event_id", "rn")


_DAILY_TIES = ["currentbalanceamount", "stopsonaccountcount"]


@key("win_after_dedup")
def win_after_dedup(c: Ctx) -> DataFrame:
    q = dedup(c.fx.fx_daily)
    # the sample may see repeats
    return number_rows(q, ["accountkey"], ["coveragedatekey"], ties=_DAILY_TIES, sample_of=c.fx.fx_daily)


@key("latest_per_key")
def latest_per_key_key(c: Ctx) -> DataFrame:
    return latest_per_key(c.fx.fx_daily, ["accountkey"], ["coveragedatekey"], ties=_DAILY_TIES) \
        .select("accountkey", "coveragedatekey", "currentbalanceamount")


@key("first_per_key")
def first_per_key_key(c: Ctx) -> DataFrame:
    return first_per_key(c.fx.fx_daily, ["accountkey"], ["coveragedatekey"], ties=_DAILY_TIES) \
        .select("accountkey", "coveragedatekey", "currentbalanceamount")


# ---------------------------------------------------------------- sort, limit, union
@key("sort_multi")
def sort_multi(c: Ctx) -> DataFrame:
    # the order is data too: a rank over the whole table, computed range by range
    e = c.t.events.select("event_id", "ts", "value")
    return global_rank(e, [("ts", True), ("value", True), ("event_id", True)]).orderBy("rank")


@key("sort_desc")
def sort_desc(c: Ctx) -> DataFrame:
    return global_rank(c.t.customer.select("c_custkey"), [("c_custkey", False)]).orderBy("rank")


@key("sort_after_distinct")
def sort_after_distinct(c: Ctx) -> DataFrame:
    q = c.t.events.select(F.to_date("ts").alias("d"), "event_type").distinct()
    return global_rank(q, [("d", True), ("event_type", True)]).orderBy("rank")


@key("limit_preview")
def limit_preview(c: Ctx) -> DataFrame:
    # a preview is the feature here: top-5 by a total order
    return c.t.orders.select("o_orderkey").orderBy("o_orderkey").limit(5)


@key("union_all")
def union_all_key(c: Ctx) -> DataFrame:
    a = c.t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nm"))
    b = c.t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("nm"))
    return union_all(a, b)


# ---------------------------------------------------------------- scalar functions
@key("str_concat")
def str_concat(c: Ctx) -> DataFrame:
    return c.t.customer.select("c_custkey", fn.cat(F.col("c_name"), ", ", F.col("c_mktsegment")).alias("s"))


@key("str_left")
def str_left(c: Ctx) -> DataFrame:
    return c.fx.fx_client.select("clientkey",
                                 fn.strip_check_digit("cifwithcheckdigit", 8).alias("base"),
                                 fn.card_bin("cifwithcheckdigit").alias("bin"))


@key("str_len")
def str_len(c: Ctx) -> DataFrame:
    return c.fx.fx_client.select("clientkey", F.length("middlesecondname").alias("n"))


@key("str_trim")
def str_trim(c: Ctx) -> DataFrame:
    return c.fx.fx_client.select("clientkey", F.trim("middlefirstname").alias("t"))


@key("str_ltrim_zero")
def str_ltrim_zero(c: Ctx) -> DataFrame:
    return c.fx.fx_teller.select("tellerkey", fn.ltrim_zeros("tellernumber").alias("t"))


@key("str_replace")
def str_replace(c: Ctx) -> DataFrame:
    a = c.fx.fx_addr
    joined = fn.cat(F.col("l1"), ", ", F.col("l2"), ", ", F.col("l3"), ", ", F.col("city"))
    sep, one = F.lit(", , "), F.lit(", ")
    return a.select("addresskey", F.replace(F.replace(joined, sep, one), sep, one).alias("a"))


@key("str_lower")
def str_lower(c: Ctx) -> DataFrame:
    return c.t.customer.select("c_custkey", F.lower("c_mktsegment").alias("m"))


@key("null_coalesce")
def null_coalesce(c: Ctx) -> DataFrame:
    return c.fx.fx_auth.select("event_id", F.coalesce(F.col("tran_amount_req"), F.lit("0")).alias("a"))


@key("null_fallback_chain")
def null_fallback_chain(c: Ctx) -> DataFrame:
    return c.fx.fx_client.select(
        "clientkey",
        F.coalesce(F.col("middlefirstname"), F.nullif(F.col("middlesecondname"), F.lit("")),
                   F.col("lastname")).alias("f"))


@key("case_else")
def case_else(c: Ctx) -> DataFrame:
    s, p = F.col("o_orderstatus"), F.col("o_totalprice")
    g = F.when(s.isin("F", "O"), "A").when((p != 0) & (s == "P"), "B").otherwise("C")
    return c.t.orders.select("o_orderkey", g.alias("g"))


@key("case_no_else")
def case_no_else(c: Ctx) -> DataFrame:
    g = F.when(~F.col("o_orderstatus").isin("F", "O"), F.col("o_orderpriority"))
    return c.t.orders.select("o_orderkey", g.alias("g"))


@key("cast_date")
def cast_date(c: Ctx) -> DataFrame:
    return c.t.events.select("event_id", F.to_date("ts").alias("d"))


@key("date_from_key")
def date_from_key(c: Ctx) -> DataFrame:
    return c.fx.fx_daily.select("coveragedatekey").distinct() \
        .select("coveragedatekey", fn.date_from_key("coveragedatekey").alias("d"))


@key("cast_int")
def cast_int(c: Ctx) -> DataFrame:
    return c.fx.fx_teller.select("tellerkey", fn.try_int("tellernumber").alias("n"))


@key("cast_string")
def cast_string(c: Ctx) -> DataFrame:
    return c.t.events.select("event_id", F.col("user_id").cast("string").alias("s"))


@key("cast_decimal")
def cast_decimal(c: Ctx) -> DataFrame:
    return c.fx.fx_auth.select("event_id", fn.try_decimal("tran_amount_req").alias("a"))


@key("date_extract")
def date_extract(c: Ctx) -> DataFrame:
    return c.t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"),
                             F.month("o_orderdate").alias("m"))


@key("time_extract")
def time_extract(c: Ctx) -> DataFrame:
    return c.t.events.select("event_id", F.hour("ts").alias("h"), F.minute("ts").alias("mi"))


@key("date_sub_days")
def date_sub_days(c: Ctx) -> DataFrame:
    return c.t.orders.select("o_orderkey", F.date_sub(F.to_date("o_orderdate"), 30).alias("d"))


@key("date_diff_days")
def date_diff_days(c: Ctx) -> DataFrame:
    return c.fx.fx_account.select("accountkey",
                                  F.datediff(F.lit(d(AS_OF)), F.col("accountopendate")).alias("days"))


@key("int_div")
def int_div_key(c: Ctx) -> DataFrame:
    days = F.datediff(F.lit(d(AS_OF)), F.col("accountopendate"))
    return c.fx.fx_account.select("accountkey", fn.int_div(days, 365).alias("age"))


@key("num_round")
def num_round(c: Ctx) -> DataFrame:
    return c.t.orders.select(
        "o_orderkey", F.round(F.col("o_totalprice").cast("decimal(18,4)") / 7, 2).alias("r"))


@key("num_safe_divide")
def num_safe_divide(c: Ctx) -> DataFrame:
    return c.t.events.select(
        "event_id", fn.safe_divide(F.col("value").cast("decimal(18,2)"),
                                   (F.col("event_id") % 3).cast("decimal(18,2)")).cast("double").alias("r"))


# ---------------------------------------------------------------- business operators
@key("scd2_current")
def scd2_current_key(c: Ctx) -> DataFrame:
    return scd2_current(c.fx.fx_client)


@key("full_name")
def full_name(c: Ctx) -> DataFrame:
    return c.fx.fx_client.select("clientkey", fn.full_name(
        "firstname", "middlefirstname", "middlesecondname", "middlethirdname").alias("full_name"))


@key("full_name_raw")
def full_name_raw(c: Ctx) -> DataFrame:
    return c.fx.fx_client.select("clientkey", fn.full_name_raw(
        "firstname", "middlefirstname", "middlesecondname", "middlethirdname").alias("n"))


@key("home_address")
def home_address(c: Ctx) -> DataFrame:
    r = c.fx.fx_addr
    p = r.select(F.col("addresskey").alias("__pk"), F.col("l1").alias("__pl1"),
                 F.col("city").alias("__pcity"))
    j = r.join(p, p["__pk"] == r["addresskey"])
    return j.select("addresskey", fn.home_address("l1", "l2", "l3", "city", "postcode",
                                                  "__pl1", "__pcity").alias("home_address"))


@key("address_line")
def address_line(c: Ctx) -> DataFrame:
    return c.fx.fx_addr.select("addresskey", fn.address_line("l1", "l2", "l3", "city").alias("a"))


@key("teller_label")
def teller_label(c: Ctx) -> DataFrame:
    return c.fx.fx_teller.select("tellerkey", fn.teller_label("tellernumber", "tellername").alias("t"))


@key("flag_yes_no")
def flag_yes_no(c: Ctx) -> DataFrame:
    return c.fx.fx_daily.select("accountkey", "coveragedatekey",
                                fn.flag_yes_no("stopsonaccountcount").alias("stopped"))


@key("flagged_accounts")
def flagged_accounts_key(c: Ctx) -> DataFrame:
    return flagged_accounts(c.fx.fx_ledger, FLAG_CODES)


@key("route_by_group")
def route_by_group(c: Ctx) -> DataFrame:
    s, k = "o_orderstatus", "o_orderkey"
    return c.t.orders.select(k, fn.route_by_group(s, k, ["F", "O"], negate=True).alias("savings"),
                             fn.route_by_group(s, k, ["F", "O"]).alias("loan"))


@key("minor_units")
def minor_units(c: Ctx) -> DataFrame:
    return c.fx.fx_auth.select("event_id", fn.minor_units("tran_amount_req").alias("amount"))


@key("age_years")
def age_years(c: Ctx) -> DataFrame:
    return c.fx.fx_account.select("accountkey", fn.age_years("accountopendate", AS_OF).alias("age"))


@key("arrears_ratio")
def arrears_ratio(c: Ctx) -> DataFrame:
    q = dedup(c.t.lineitem.select("l_orderkey", "l_linenumber",
                                  F.col("l_discount").cast("decimal(18,2)").alias("x"),
                                  F.col("l_quantity").cast("decimal(18,2)").alias("y")))
    return q.select("l_orderkey", "l_linenumber", fn.arrears_ratio("x", "y").alias("pct"))


@key("hour_label")
def hour_label(c: Ctx) -> DataFrame:
    return c.t.events.select("event_id", fn.hour_label("ts").alias("label"))


@key("accounts_of_client")
def accounts_of_client_key(c: Ctx) -> DataFrame:
    search = c.fx.fx_account.filter(F.col("accountstatusname") == "P").select("accountkey")
    acc = accounts_of_client(c.fx.fx_account, search).select("accountkey", "accountnumber")
    # (DISTINCT before the newest-row pick changes nothing: total tie order)
    newest = latest_per_key(c.fx.fx_daily, ["accountkey"], ["coveragedatekey"],
                            ties=_DAILY_TIES).select(F.col("accountkey").alias("__a"),
                                                     "currentbalanceamount")
    return acc.join(newest, newest["__a"] == acc["accountkey"]) \
        .select("accountkey", "accountnumber", "currentbalanceamount")
