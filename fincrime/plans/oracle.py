"""Independent SQL oracle (DuckDB dialect) for every keyed query.

The driver registers the base tables as views; the derived ``fx_`` views
are put in front of each query as CTEs.  Null order is always written out
(nulls last) and every computed column is aliased to the Spark name.
"""

from __future__ import annotations

import re

from fincrime.plans.full_oracle import full_report_sql

# Derived views, in dependency order.
FX_VIEWS: dict[str, str] = {
    "fx_client": (
        "select c_custkey*10+1 as clientkey, lpad(cast(c_custkey as varchar),8,'0') as cifnumber, "
        "concat(lpad(cast(c_custkey as varchar),8,'0'),cast(c_custkey%10 as varchar)) as cifwithcheckdigit, "
        "c_name as firstname, case when c_custkey%4=0 then ' ' when c_custkey%11=0 then null "
        "else c_mktsegment end as middlefirstname, case when c_custkey%3=0 then '' else 'M' end "
        "as middlesecondname, '' as middlethirdname, c_mktsegment as lastname, 1 as rowiscurrent "
        "from customer union all "
        "select c_custkey*10, lpad(cast(c_custkey as varchar),8,'0'), "
        "concat(lpad(cast(c_custkey as varchar),8,'0'),cast(c_custkey%10 as varchar)), c_name, "
        "case when c_custkey%4=0 then ' ' when c_custkey%11=0 then null else c_mktsegment end, "
        "case when c_custkey%3=0 then '' else 'M' end, '', c_mktsegment, 0 "
        "from customer where c_custkey%3=0"),
    "fx_account": (
        "select o_orderkey as accountkey, lpad(cast(o_orderkey as varchar),9,'0') as accountnumber, "
        "lpad(cast(o_custkey as varchar),8,'0') as clientnumber, cast(o_orderdate as date) as "
        "accountopendate, o_orderstatus as accountstatusname, case when o_orderkey%9=0 then 0 else 1 "
        "end as rowiscurrent from orders"),
    "fx_daily": (
        "select l_orderkey as accountkey, cast(year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) "
        "as integer) as coveragedatekey, cast(l_extendedprice as decimal(18,2)) as currentbalanceamount, "
        "l_linenumber%3 as stopsonaccountcount from lineitem"),
    "fx_legs": (
        "select distinct l_orderkey, l_suppkey, l_partkey, l_linenumber, cast(l_shipdate as date) as d, "
        "cast(l_extendedprice as decimal(18,2)) as amt, l_returnflag, l_linestatus, o_custkey "
        "from lineitem join orders on o_orderkey=l_orderkey"),
    "fx_ledger": (
        "select l_orderkey as accountkey, o_custkey as clientkey, -amt as transactionamount, "
        "d as transactiondate, l_linenumber as timekey, l_partkey as journalnumber, "
        "case l_returnflag when 'R' then 50 when 'A' then 73 else 10 end as transactionindicatorskey "
        "from fx_legs union all select 1000000000+l_suppkey, 1000000000+l_suppkey, amt, d, "
        "l_linenumber, l_partkey, 10 from fx_legs where l_linestatus='F'"),
    "fx_card": (
        "select c_custkey as cardno, case when c_custkey%5=0 then null else date '2024-01-05' end "
        "as stopdate from customer"),
    "fx_auth": (
        "select event_id, user_id as cardno, ts as datetime_req, event_type as tran_type, "
        "case when event_id%7=0 then '' when event_id%5=0 then '0' when event_id%13=0 then null "
        "else cast(cast(round(value*100) as bigint) as varchar) end as tran_amount_req from events"),
    "fx_teller": (
        "select s_suppkey as tellerkey, lpad(cast(s_suppkey as varchar),6,'0') as tellernumber, "
        "s_name as tellername from supplier"),
    "fx_code": "select p_brand as code, p_type as name, p_size%2 as rowiscurrent from part",
    "fx_addr": (
        "select c_custkey as addresskey, c_name as l1, case when c_custkey%2=0 then '' else "
        "c_mktsegment end as l2, case when c_custkey%4=0 then '' else 'L3' end as l3, n_name as city, "
        "lpad(cast(c_custkey%10000 as varchar),4,'0') as postcode from customer join nation on "
        "n_nationkey=c_nationkey"),
}
_FX_DEPS = {"fx_ledger": ["fx_legs"]}
_HEAVY = ("fx_legs", "fx_ledger")      # computed once a query, not once a reference

# Shared fragments
_LATEST_DAILY = ("(select * from (select *, row_number() over(partition by accountkey order by "
                 "coveragedatekey desc nulls last, currentbalanceamount desc nulls last, "
                 "stopsonaccountcount desc nulls last) as rn from fx_daily) z where rn=1)")
_FULL_NAME3 = ("trim(trim(c.firstname)||case when trim(c.middlefirstname)='' then '' else ' '||"
               "trim(c.middlefirstname) end||case when trim(c.middlesecondname)='' then '' else ' '||"
               "trim(c.middlesecondname) end)")
_MINOR = ("cast(case when {t} in ('','0') then 0 else try_cast({t} as decimal(23,2))/100 end "
          "as decimal(23,2))")
_CONTRA_ON = ("a.transactiondate=b.transactiondate and a.timekey=b.timekey and "
              "a.journalnumber=b.journalnumber and b.transactionamount=a.transactionamount*-1 and "
              "a.accountkey<>b.accountkey and a.clientkey<>b.clientkey")
_FLAGGED = "(select accountkey from fx_ledger where transactionindicatorskey in (50,73))"
_DDIFF = "date_diff('day', accountopendate, date '2024-07-15')"

def _by_sign(columns: str, *more: str) -> str:
    """The ledger's debits and credits as tables of their own, each with one text key of date, journal and more."""
    key = "||'|'||".join(f"cast({c} as varchar)" for c in ("transactiondate", "journalnumber", *more))
    return ("with debit as materialized (select " + columns + f", {key} as k from fx_ledger where transactionamount<0), "
            "credit as materialized (select " + columns + f", {key} as k from fx_ledger where transactionamount>0) ")


QUERIES: dict[str, str] = {
    # scans, sources
    "scan_base": "select * from customer",
    "scan_view": "select * from (select o_orderkey,o_custkey from orders where o_orderstatus='F') v",
    "multi_schema_catalogue": ("select c_custkey as partykey, s_name as agentname, n_name as nationname from customer "
                               "left join supplier on s_suppkey=c_custkey join nation on n_nationkey=c_nationkey"),
    "report_output": ("select o_orderkey, o_custkey, 'partition' as read from orders where o_orderstatus='F' union all "
                      "select o_orderkey, o_custkey, 'whole' from orders"),
    "recent_ledger": (
        "with e as (select *, year(l_shipdate)*10000+month(l_shipdate)*100+day(l_shipdate) as k from lineitem) "
        "select l_orderkey as accountkey, -cast(l_extendedprice as decimal(23,2)) as transactionamount, "
        "k as postedtransactiondatekey, cast(l_partkey as varchar) as journalnumber from e where k>=19990101 union all "
        "select 1000000000+l_suppkey, cast(l_extendedprice as decimal(23,2)), k, cast(l_partkey as varchar) from e "
        "where k>=19990101 and l_linestatus='F'"),
    "cards_of_client": (
        "select lpad(cast(c_custkey as varchar),8,'0') as card_clientnumber, '4'||lpad(cast(c_custkey as varchar),9,'0') "
        "as cardnumber, 'P' as cardholdertypecode, c_name as embossedname, c_custkey as cardkey from customer "
        "where c_custkey%6<>0 and c_mktsegment='BUILDING'"),
    "inline_relation": ("select o_orderkey, t.label from orders left join (select 'F' as code,'Final' "
                        "as label union all select 'O','Open') t on t.code=o_orderstatus"),
    "search_keys": ("select c_custkey,c_name from customer where c_custkey in (select k from "
                    "(select 1 as k union all select 7 union all select 42) s)"),
    # projections
    "project_rename": "select c_custkey as client_key, c_name as full_name from customer",
    "select_star": "select * from region",
    "constant_columns": "select c_custkey, '' as ref, 'X' as tag from customer",
    "quoted_names": 'select c_custkey, c_name as "E-mail" from customer',
    "alias_reuse": ("select y, o_orderstatus from (select cast(year(o_orderdate) as integer) as y, o_orderstatus from "
                    "orders) q where y>=1999 group by y, o_orderstatus"),
    "derived_projection": ("select a.o_orderkey, b.c_name from (select o_orderkey,o_custkey from orders) a "
                           "join (select c_custkey,c_name from customer) b on b.c_custkey=a.o_custkey"),
    "cte_chain": ("with a as (select o_orderkey,o_custkey from orders where o_orderstatus='F'), "
                  "b as (select a.o_orderkey,c_nationkey from a join customer on c_custkey=a.o_custkey) "
                  "select b.o_orderkey, n_name from b join nation on n_nationkey=c_nationkey"),
    "nested_cte": ("with a as (with b as (select c_custkey,c_nationkey from customer where c_acctbal>0) "
                   "select c_custkey, c_nationkey from b) select c_custkey, n_name from a join nation "
                   "on n_nationkey=c_nationkey"),
    "arith_projection": ("select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) - cast(1000 as "
                         "decimal(18,2)) * -1 as decimal(21,2)) as available from orders"),
    # filters
    "filter_eq": "select c_custkey from customer where c_mktsegment='MACHINERY'",
    "filter_cmp": "select c_custkey from customer where c_acctbal<0 and c_nationkey<>3",
    "filter_in_list": "select o_orderkey from orders where o_orderstatus in ('F','P')",
    "filter_not_in_list": ("select o_orderkey from orders where o_orderpriority not in "
                           "('1-URGENT','2-HIGH')"),
    "filter_in_subquery": ("select c_custkey from customer where c_custkey in (select o_custkey from "
                           "orders where o_totalprice>400000)"),
    "filter_scalar_subquery": ("select o_orderkey from orders where o_custkey=(select max(o_custkey) "
                               "from orders)"),
    "latest_snapshot": ("select * from fx_daily where coveragedatekey=(select max(coveragedatekey) "
                        "from fx_daily)"),
    "filter_between": ("select o_orderkey from orders where cast(o_orderdate as date) between "
                       "date '1997-01-01' and date '1997-06-30'"),
    "filter_like": "select p_partkey from part where p_name like '%widget%'",
    "filter_not_like_ci": "select p_partkey from part where lower(p_name) not like '%bolt%'",
    "filter_eq_ci": "select o_orderkey from orders where lower(o_orderstatus)='f'",
    "filter_not_null": "select event_id from fx_auth where tran_amount_req is not null",
    "filter_day": "select event_id from events where cast(ts as date)=date '2024-01-10'",
    "filter_ts_after": "select event_id from events where ts > timestamp '2024-01-15 06:00:00'",
    "filter_col_vs_col": ("select event_id, a.cardno from fx_auth a join fx_card c on c.cardno=a.cardno "
                          "where cast(a.datetime_req as date) >= c.stopdate"),
    "filter_year_month": ("select o_orderkey from orders where cast(o_orderdate as date) >= "
                          "date '2001-06-01'"),
    "filter_or_across_tables": ("select o_orderkey from orders join customer on c_custkey=o_custkey "
                                "where (o_orderstatus='F' and c_mktsegment='MACHINERY') or c_custkey=7"),
    "filter_blank": "select clientkey from fx_client where trim(middlefirstname)=''",
    "filter_typed_literal": ("select o_orderkey from orders where cast(o_orderdate as date) = "
                             "date '1997-04-04'"),
    # joins
    "join_inner": "select o_orderkey,c_name from orders join customer on c_custkey=o_custkey",
    "join_left": ("select c_custkey,o_orderkey from customer left join (select * from orders where "
                  "o_totalprice>450000) o on o_custkey=c_custkey"),
    "join_left_on_filter": ("select c_custkey,o_orderkey from customer left join orders on "
                            "o_custkey=c_custkey and o_orderstatus='F'"),
    "join_left_on_or": ("select o_orderkey,c_custkey from orders left join customer on c_custkey=o_custkey "
                        "and (c_acctbal=(select max(c_acctbal) from customer) or c_nationkey=1)"),
    "join_inner_on_filter": ("select o_orderkey from orders join customer on c_custkey=o_custkey and "
                             "c_mktsegment='BUILDING'"),
    "join_nested_tree": ("select o_orderkey, n_name from orders left join (customer join nation on "
                         "n_nationkey=c_nationkey and n_nationkey<5) on c_custkey=o_custkey"),
    "join_prefix_key": ("select a.accountkey,c.clientkey from fx_account a join fx_client c on "
                        "a.clientnumber=substring(c.cifwithcheckdigit,1,8) where c.rowiscurrent=1"),
    "join_cast_key": ("select tellerkey, c_custkey from fx_teller join customer on "
                      "c_custkey=try_cast(tellernumber as bigint)"),
    "join_composite_key": ("select a.p_partkey, d.n from part a join (select concat(p_brand,'|',p_type) "
                           "as code, max(p_size) as n from part group by 1) d on "
                           "d.code=concat(a.p_brand,'|',a.p_type)"),
    "join_role_playing": ("select l.l_orderkey, n1.n_name as client_nation, n2.n_name as supp_nation "
                          "from lineitem l join orders on o_orderkey=l_orderkey join customer on "
                          "c_custkey=o_custkey join supplier on s_suppkey=l_suppkey join nation n1 on "
                          "n1.n_nationkey=c_nationkey join nation n2 on n2.n_nationkey=s_nationkey"),
    "join_scd2_current": ("select a.accountkey,c.clientkey from fx_account a join fx_client c on "
                          "c.cifnumber=a.clientnumber and c.rowiscurrent=1 where a.rowiscurrent=1"),
    "join_history_fanout": ("select a.accountkey,c.clientkey from fx_account a join fx_client c on "
                            "c.cifnumber=a.clientnumber"),
    "join_dedup_dim": ("select p.p_partkey,d.name from part p left join (select code,name from fx_code "
                       "where rowiscurrent=1 group by 1,2) d on d.code=p.p_brand"),
    "join_multi_key": _by_sign("accountkey", "timekey") + (
        "select a.accountkey, b.accountkey as other from debit a join credit b on a.k=b.k"),
    "join_residual": _by_sign("accountkey, clientkey") + (
        "select accountkey, other from (select a.accountkey, b.accountkey as other, a.clientkey, b.clientkey as otherclient "
        "from debit a join credit b on a.k=b.k) p where accountkey<>other and clientkey<>otherclient"),
    "contra_entry": _by_sign("accountkey, clientkey, journalnumber, transactionamount", "timekey", "abs(transactionamount)") + (
        f", flagged as materialized {_FLAGGED} "
        "select credit_account, debit_account, journalnumber, credit, debit from (select a.accountkey as credit_account, "
        "b.accountkey as debit_account, a.journalnumber, a.transactionamount as credit, b.transactionamount as debit, "
        "a.clientkey as c1, b.clientkey as c2 from credit a join debit b on a.k=b.k) p "
        "where credit_account<>debit_account and c1<>c2 and debit_account in (select accountkey from flagged)"),
    "join_left_null_rejected": ("select o_orderkey from orders left join customer on c_custkey=o_custkey "
                                "where c_acctbal>0"),
    "join_fact_fact": ("select distinct o_orderkey,l_returnflag from orders join lineitem on "
                       "l_orderkey=o_orderkey"),
    "join_existence": ("select distinct c_custkey from customer left join (select o_custkey,o_orderstatus "
                       "from orders group by 1,2) o on o_custkey=c_custkey"),
    "join_existence_inner": "select distinct c_custkey from customer join orders on o_custkey=c_custkey",
    "join_on_scalar_subquery": ("select a.accountkey, d.currentbalanceamount from fx_account a join "
                                "fx_daily d on d.accountkey=a.accountkey and d.coveragedatekey=(select "
                                "max(coveragedatekey) from fx_daily)"),
    # aggregation
    "agg_distinct": "select distinct o_orderstatus,o_orderpriority from orders",
    "agg_group_dedup": ("select c_mktsegment,c_nationkey from customer group by c_mktsegment,"
                        "c_nationkey"),
    "agg_group_max": "select o_custkey, max(o_orderkey) as max_key from orders group by o_custkey",
    "agg_global_max": "select max(coveragedatekey) as m from fx_daily",
    "agg_group_ordinal": "select p_brand,p_type from part group by 1,2",
    "agg_group_expr": ("select cast(year(o_orderdate) as integer) as y, max(o_orderkey) as m from orders "
                       "group by year(o_orderdate)"),
    "dedup_then_number": ("select *, cast(row_number() over(partition by c_nationkey order by c_mktsegment "
                          "asc nulls last) as integer) as rn from (select distinct c_nationkey,c_mktsegment from "
                          "customer) q"),
    # windows
    "win_rownum_desc": ("select o_orderkey, cast(row_number() over(partition by o_custkey order by o_orderdate "
                        "desc nulls last, o_orderkey) as integer) as rn from orders"),
    "win_rownum_multi_part": ("select o_orderkey, cast(row_number() over(partition by o_custkey,o_orderstatus "
                              "order by o_orderdate desc nulls last, o_orderkey) as integer) as rn from orders"),
    "win_rownum_asc": ("select o_orderkey, cast(row_number() over(partition by o_custkey order by o_orderdate "
                       "asc nulls last, o_orderkey) as integer) as rn from orders"),
    "win_rownum_multi_order": ("select event_id, cast(row_number() over(partition by user_id order by "
                               "cast(ts as date) desc nulls last, ts desc nulls last, event_id) as integer) as rn "
                               "from events"),
    "win_after_dedup": ("select *, cast(row_number() over(partition by accountkey order by coveragedatekey "
                        "desc nulls last, currentbalanceamount desc nulls last, stopsonaccountcount desc "
                        "nulls last) as integer) as rn from (select distinct * from fx_daily) q"),
    "latest_per_key": ("select accountkey,coveragedatekey,currentbalanceamount from (select *, "
                       "row_number() over(partition by accountkey order by coveragedatekey desc nulls "
                       "last, currentbalanceamount desc nulls last, stopsonaccountcount desc nulls last) "
                       "as rn from fx_daily) q where rn=1"),
    "first_per_key": ("select accountkey,coveragedatekey,currentbalanceamount from (select *, "
                      "row_number() over(partition by accountkey order by coveragedatekey asc nulls "
                      "last, currentbalanceamount asc nulls last, stopsonaccountcount asc nulls last) "
                      "as rn from fx_daily) q where rn=1"),
    # sort, limit, union
    "sort_multi": ("select event_id,ts,value, row_number() over(order by ts asc nulls last, value asc nulls last, event_id) "
                   "as rank from events order by rank"),
    "sort_desc": ("select c_custkey, row_number() over(order by c_custkey desc nulls last) as rank from customer "
                  "order by rank"),
    "sort_after_distinct": ("select d, event_type, row_number() over(order by d asc nulls last, event_type asc nulls last) "
                            "as rank from (select distinct cast(ts as date) as d, event_type from events) q order by rank"),
    "limit_preview": "select o_orderkey from orders order by o_orderkey limit 5",
    "union_all": ("select c_custkey as k, c_name as nm from customer union all select s_suppkey, s_name "
                  "from supplier"),
    # scalar functions
    "str_concat": "select c_custkey, c_name || ', ' || c_mktsegment as s from customer",
    "str_left": ("select clientkey, substring(cifwithcheckdigit,1,8) as base, "
                 "substring(cifwithcheckdigit,1,6) as bin from fx_client"),
    "str_len": "select clientkey, cast(length(middlesecondname) as integer) as n from fx_client",
    "str_trim": "select clientkey, trim(middlefirstname) as t from fx_client",
    "str_ltrim_zero": "select tellerkey, ltrim(tellernumber,'0') as t from fx_teller",
    "str_replace": ("select addresskey, replace(replace(l1||', '||l2||', '||l3||', '||city, ', , ', ', '), "
                    "', , ', ', ') as a from fx_addr"),
    "str_lower": "select c_custkey, lower(c_mktsegment) as m from customer",
    "null_coalesce": "select event_id, coalesce(tran_amount_req,'0') as a from fx_auth",
    "null_fallback_chain": ("select clientkey, coalesce(middlefirstname, nullif(middlesecondname,''), "
                            "lastname) as f from fx_client"),
    "case_else": ("select o_orderkey, case when o_orderstatus in ('F','O') then 'A' when "
                  "o_totalprice<>0 and o_orderstatus='P' then 'B' else 'C' end as g from orders"),
    "case_no_else": ("select o_orderkey, case when o_orderstatus not in ('F','O') then o_orderpriority "
                     "end as g from orders"),
    "cast_date": "select event_id, cast(ts as date) as d from events",
    "date_from_key": ("select distinct coveragedatekey, cast(strptime(cast(coveragedatekey as varchar),"
                      "'%Y%m%d') as date) as d from fx_daily"),
    "cast_int": "select tellerkey, try_cast(tellernumber as int) as n from fx_teller",
    "cast_string": "select event_id, cast(user_id as varchar) as s from events",
    "cast_decimal": "select event_id, try_cast(tran_amount_req as decimal(23,2)) as a from fx_auth",
    "date_extract": "select o_orderkey, cast(year(o_orderdate) as integer) as y, cast(month(o_orderdate) as integer) "
                     "as m from orders",
    "time_extract": "select event_id, cast(hour(ts) as integer) as h, cast(minute(ts) as integer) as mi from events",
    "date_sub_days": "select o_orderkey, cast(cast(o_orderdate as date) - 30 as date) as d from orders",
    "date_diff_days": f"select accountkey, cast({_DDIFF} as integer) as days from fx_account",
    "int_div": f"select accountkey, {_DDIFF} // 365 as age from fx_account",
    "num_round": ("select o_orderkey, cast(round(cast(o_totalprice as decimal(18,4))/7,2) as decimal(17,2)) as r "
                  "from orders"),
    "num_safe_divide": "select event_id, value / nullif(event_id%3,0) as r from events",
    # business operators
    "scd2_current": "select * from fx_client where rowiscurrent=1",
    "full_name": ("select clientkey, trim(trim(firstname)||case when trim(middlefirstname)='' then '' "
                  "else ' '||trim(middlefirstname) end||case when trim(middlesecondname)='' then '' "
                  "else ' '||trim(middlesecondname) end||case when trim(middlethirdname)='' then '' "
                  "else ' '||trim(middlethirdname) end) as full_name from fx_client"),
    "full_name_raw": ("select clientkey, firstname||' '||middlefirstname||' '||middlesecondname||' '||"
                      "middlethirdname as n from fx_client"),
    "home_address": ("select r.addresskey, case when r.l1=p.l1 and length(r.l2)=0 and length(r.l3)=0 "
                     "then p.l1||', '||p.city else r.l1||', '||r.l2||', '||r.l3||', '||r.city||', '||"
                     "r.postcode end as home_address from fx_addr r join fx_addr p on "
                     "p.addresskey=r.addresskey"),
    "address_line": ("select addresskey, replace(replace(trim(l1)||', '||trim(l2)||', '||trim(l3)||', '||"
                     "trim(city), ', , ', ', '), ', , ', ', ') as a from fx_addr"),
    "teller_label": "select tellerkey, ltrim(tellernumber,'0')||' - '||tellername as t from fx_teller",
    "flag_yes_no": ("select accountkey, coveragedatekey, case when stopsonaccountcount>0 then 'Yes' "
                    "else 'No' end as stopped from fx_daily"),
    "flagged_accounts": ("select distinct accountkey from fx_ledger where transactionindicatorskey in "
                         "(50,73)"),
    "route_by_group": ("select o_orderkey, case when o_orderstatus not in ('F','O') then o_orderkey end "
                       "as savings, case when o_orderstatus in ('F','O') then o_orderkey end as loan "
                       "from orders"),
    "minor_units": f"select event_id, {_MINOR.format(t='tran_amount_req')} as amount from fx_auth",
    "age_years": f"select accountkey, {_DDIFF} // 365 as age from fx_account",
    "arrears_ratio": ("select l_orderkey, l_linenumber, printf('%.2f %%', 100*round(cast(x as double)/"
                      "nullif(cast(y as double),0),2)) as pct from (select distinct l_orderkey, "
                      "l_linenumber, cast(l_discount as decimal(18,2)) as x, cast(l_quantity as "
                      "decimal(18,2)) as y from lineitem) q"),
    "hour_label": ("select event_id, cast(hour(ts) as varchar)||'h'||cast(minute(ts) as varchar) as label "
                   "from events"),
    "accounts_of_client": ("select a.accountkey, a.accountnumber, d.currentbalanceamount from fx_account a "
                           "join (select * from (select accountkey,coveragedatekey,currentbalanceamount "
                           "from (select *, row_number() over(partition by accountkey order by "
                           "coveragedatekey desc nulls last, currentbalanceamount desc nulls last, "
                           "stopsonaccountcount desc nulls last) as rn from (select distinct * from "
                           "fx_daily) z) q where rn=1) w) d on d.accountkey=a.accountkey where "
                           "a.clientnumber in (select clientnumber from fx_account where accountstatusname='P')"),
    # ------------------------------------------------------------ reports
    "report_aml": (
        "with key_client as (select distinct clientnumber from fx_account where accountstatusname='P'), "
        "acc as (select a.clientnumber, a.accountnumber, d.currentbalanceamount, "
        "d.coveragedatekey, 'Deposit' as grp from fx_account a join (select distinct * from fx_daily) d "
        "on d.accountkey=a.accountkey where a.accountstatusname='F' and a.clientnumber in (select "
        "clientnumber from key_client) union all select a.clientnumber, a.accountnumber, "
        "coalesce(d.currentbalanceamount,0), d.coveragedatekey, 'Loan' from fx_account a left join "
        "(select distinct * from fx_daily) d on d.accountkey=a.accountkey where a.accountstatusname<>'F' "
        "and a.clientnumber in (select clientnumber from key_client)), newest as (select * from (select *, "
        "row_number() over(partition by accountnumber order by coveragedatekey desc nulls last, "
        "currentbalanceamount desc nulls last) as rn from acc) z where rn=1) select distinct "
        "n.accountnumber, n.grp, n.currentbalanceamount, c.cifwithcheckdigit, c.firstname, "
        "ad.l1||', '||ad.city as home_address from newest n join fx_client c on c.cifnumber=n.clientnumber "
        "and c.rowiscurrent=1 join fx_addr ad on lpad(cast(ad.addresskey as varchar),8,'0')=c.cifnumber"),
    "report_employer": (
        "select distinct a.accountnumber, c.cifwithcheckdigit, case when a.accountstatusname not in "
        "('F','O') then a.accountnumber end as savings_account, case when a.accountstatusname in "
        "('F','O') then a.accountnumber end as loan_contract, d.currentbalanceamount, '' as case_nr, "
        "ad.l1 as home_address_1 from fx_client c join fx_account a on a.clientnumber=c.cifnumber and "
        "a.rowiscurrent=1 left join fx_daily d on d.accountkey=a.accountkey and d.coveragedatekey=(select "
        "max(coveragedatekey) from fx_daily) join fx_addr ad on lpad(cast(ad.addresskey as varchar),8,'0')"
        "=c.cifnumber where c.rowiscurrent=1 and (c.lastname='MACHINERY' or a.accountnumber in "
        "(select accountnumber from fx_account where accountstatusname='P'))"),
    "report_contra": (
        "select * from (select m.*, cast(row_number() over(partition by credit_client order by transactiondate "
        "desc nulls last, timekey desc nulls last, debit_account, journalnumber, credit) as integer) as rn from (select "
        "distinct a.clientkey as credit_client, a.accountkey as credit_account, b.accountkey as "
        "debit_account, b.clientkey as debit_client, c.firstname as debit_name, a.transactiondate, "
        "a.timekey, a.journalnumber, a.transactionamount as credit, b.transactionamount as debit from "
        f"fx_ledger a join fx_ledger b on {_CONTRA_ON} join fx_client c on c.clientkey=b.clientkey*10+1 "
        f"where a.transactionamount>0 and b.accountkey in {_FLAGGED}) m) z where rn=1 and debit_name "
        "like '%1%'"),
    "report_missed_fraud": (
        "select l.accountkey, l.transactionamount, l.transactiondate, substring(a.accountnumber,1,6) as bin, "
        "c.cifwithcheckdigit from fx_ledger l join fx_account a on a.accountkey=l.accountkey and "
        "a.rowiscurrent=1 join fx_client c on c.cifnumber=a.clientnumber and c.rowiscurrent=1 where "
        "lower(a.accountstatusname)='f' and l.transactionamount<0 and l.transactiondate=date '1998-09-30' "
        "and lower(c.lastname) not like '%build%' and c.middlefirstname is not null order by "
        "l.transactiondate asc nulls last, l.transactionamount asc nulls last"),
    "report_client_lookup": (
        f"select c.cifwithcheckdigit, {_FULL_NAME3} as full_name, a.accountnumber, a.accountopendate, "
        "d.currentbalanceamount, case when d.stopsonaccountcount>0 then 'Yes' else 'No' end as "
        "account_stopped, replace(replace(trim(ad.l1)||', '||trim(ad.l2)||', '||trim(ad.l3)||', '||"
        "trim(ad.city), ', , ', ', '), ', , ', ', ') as home_address from fx_client c join fx_account a on "
        f"a.clientnumber=c.cifnumber and a.rowiscurrent=1 join {_LATEST_DAILY} d on "
        "d.accountkey=a.accountkey join fx_addr ad on lpad(cast(ad.addresskey as varchar),8,'0')="
        "c.cifnumber where c.rowiscurrent=1 and a.accountnumber in (select accountnumber from fx_account "
        "where accountstatusname='P')"),
    "report_case_lookup": (
        "select o_orderkey, o_orderdate, o_orderstatus from orders where o_orderdate > timestamp "
        "'1998-02-15 06:00:00' and o_custkey in (select c_custkey from customer where "
        "c_mktsegment='AUTOMOBILE')"),
    "report_arrears": (
        "select distinct c.cifwithcheckdigit, a.accountnumber, ltrim(tellernumber,'0')||' - '||tellername "
        "as create_teller, d.currentbalanceamount, cast(round(cast(d.stopsonaccountcount as decimal(18,2))"
        f"/4,2) as decimal(18,2)) as arrears_rate from {_LATEST_DAILY} d join fx_account a on "
        "a.accountkey=d.accountkey and a.rowiscurrent=1 join fx_client c on c.cifnumber=a.clientnumber and "
        "c.rowiscurrent=1 join (select * from (select accountkey, l_suppkey, row_number() over(partition by "
        "accountkey order by dd asc nulls last, l_suppkey) as rn from (select distinct l_orderkey as "
        "accountkey, l_suppkey, d as dd from fx_legs) y) z where rn=1) f on f.accountkey=d.accountkey "
        "left join fx_teller on tellerkey=f.l_suppkey where a.accountopendate between date '1998-04-04' "
        "and date '1998-06-04' order by c.cifwithcheckdigit desc nulls last"),
    "report_card_search": (
        f"select k.cardno, a.accountnumber, d.currentbalanceamount, c.cifwithcheckdigit, {_FULL_NAME3} as "
        "first_name, k.stopdate from fx_card k join fx_client c on c.cifnumber=lpad(cast(k.cardno as "
        "varchar),8,'0') and c.rowiscurrent=1 join fx_account a on a.clientnumber=substring("
        f"c.cifwithcheckdigit,1,8) and a.rowiscurrent=1 join {_LATEST_DAILY} d on d.accountkey=a.accountkey "
        "where k.cardno in (select c_custkey from customer where c_mktsegment='FURNITURE')"),
    "report_incidents": (
        "select * from (select e.user_id*10+length(e.event_type) as incident_number, c.cifwithcheckdigit, "
        "cast(e.ts as date) as created, e.event_type as category, cast(row_number() over(partition by "
        "e.user_id*10+length(e.event_type) order by e.ts desc nulls last, e.event_id) as integer) as rn from events e "
        "join fx_client c on c.cifnumber=lpad(cast(e.user_id as varchar),8,'0') where c.rowiscurrent=1) z "
        "where rn=1"),
    "report_tollgate": (
        "select distinct t.event_id, t.datetime_req, cast(t.datetime_req as date) as d, dt.device, "
        f"k.stopdate, {_MINOR.format(t='t.tran_amount_req')} as amount, c.cifwithcheckdigit from fx_auth t "
        "left join (select 'view' as code, 'NAD' as device union all select 'purchase','POS') dt on "
        "dt.code=t.tran_type join fx_card k on k.cardno=t.cardno join fx_client c on c.cifnumber="
        "lpad(cast(k.cardno as varchar),8,'0') and c.rowiscurrent=1 where t.tran_type<>'error' and "
        "cast(t.datetime_req as date)>=k.stopdate order by t.datetime_req"),
}


def _needed(sql: str) -> list[str]:
    names = [v for v in FX_VIEWS if re.search(rf"\b{v}\b", sql)]
    for v in list(names):
        for dep in _FX_DEPS.get(v, []):
            if dep not in names:
                names.append(dep)
    return [v for v in FX_VIEWS if v in names]  # dependency order


def with_views(sql: str) -> str:
    """Prefix the derived views the query uses as CTEs."""
    names = _needed(sql)
    if not names:
        return sql
    ctes = ", ".join(f"{v} as {'materialized ' if v in _HEAVY else ''}({FX_VIEWS[v]})" for v in names)
    body = sql.strip()
    if body[:5].lower() == "with ":
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"


def oracle_sql() -> dict[str, str]:
    return {k: with_views(v) for k, v in QUERIES.items()} | full_report_sql()
