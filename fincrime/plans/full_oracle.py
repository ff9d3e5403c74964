"""SQL oracle (DuckDB dialect) of the ten full reports on the derived warehouse.

Each relation of ``sources/derived_warehouse.py`` that these reports read is a
CTE; the report's SQL reads the CTEs by the relations' names and returns all of
the report's columns.
"""

from __future__ import annotations

_DAY = "(year({0})*10000+month({0})*100+day({0}))"
_SHARE = "({0}::decimal(23,2)*{1}::decimal(4,2))::decimal(23,2)"

RELATIONS: dict[str, str] = {
    "dimclient": (
        "select c_custkey*10+v as clientkey, lpad(c_custkey::varchar,8,'0') as cifnumber, "
        "lpad(c_custkey::varchar,8,'0')||(c_custkey%10)::varchar as cifwithcheckdigit, "
        "case when c_custkey%2=0 then 'MR' else 'MS' end as titlename, substr(c_name,1,1) as initials, c_name as firstname, "
        "case when c_custkey%4=0 then ' ' when c_custkey%11=0 then null else c_mktsegment end as middlefirstname, "
        "case when c_custkey%3=0 then '' else 'M' end as middlesecondname, '' as middlethirdname, "
        "c_mktsegment as lastname, "
        "make_timestamp(2010+c_custkey%10, 1+c_custkey%12, 1, 9, 0, 0) as clientcreatedate, "
        "(date '1950-01-01' + (c_custkey*37%18000)::int)::date as birthdate, "
        "'ID'||lpad(c_custkey::varchar,10,'0') as partyidentifiertypenumber, "
        "'NATIONAL ID' as partyidentifiertypename, '021'||lpad(c_custkey::varchar,7,'0') as homephonenumber, "
        "'011'||lpad(c_custkey::varchar,7,'0') as workphonenumber, "
        "'07'||lpad(c_custkey::varchar,8,'0') as mobilephonenumber, v as rowiscurrent "
        "from customer, (values (0),(1)) t(v) where v=1 or c_custkey%3=0"),
    "dimaccount": (
        "select lpad(o_orderkey::varchar,9,'0') as accountnumber, "
        "lpad(o_orderkey::varchar,9,'0')||(o_orderkey%10)::varchar as accountnumberwithcheckdigit, "
        "o_orderkey as accountkey, o_orderdate::timestamp as accountopendate, "
        "lpad(o_custkey::varchar,8,'0') as clientnumber, "
        "case when o_orderkey%9=0 then 0 else 1 end as rowiscurrent, o_orderstatus as accountstatusname, "
        "case o_orderstatus when 'F' then 'SAV' when 'O' then 'LN' else 'CC' end as accounttypecode, "
        "'01' as accountcategorycode from orders union all "
        "select lpad((1000000000+s_suppkey)::varchar,10,'0'), "
        "lpad((1000000000+s_suppkey)::varchar,10,'0')||(s_suppkey%10)::varchar, 1000000000+s_suppkey, "
        "timestamp '2015-01-01', lpad(s_suppkey::varchar,8,'0'), 1, 'F', 'SAV', '01' from supplier"),
    "dimaddress": (
        "select c_custkey as addresskey, c_name as l1, case when c_custkey%2=0 then '' else c_mktsegment end as l2, "
        "case when c_custkey%4=0 then '' else 'L3' end as l3, n_name as city, "
        "lpad((c_custkey%10000)::varchar,4,'0') as postcode "
        "from customer join nation on c_nationkey=n_nationkey"),
    "dimemployer": "select n_nationkey as employerkey, n_name||' STAFF' as employername, "
                   "'E'||lpad(n_nationkey::varchar,6,'0') as employernumber, r_name as industry from nation "
                   "join region on n_regionkey=r_regionkey",
    "dimproduct": (
        "select distinct ascii(o_orderstatus) as productkey, case o_orderstatus when 'F' then 'SAV' "
        "when 'O' then 'LN' else 'CC' end||'|01' as productcode, 'Product '||o_orderstatus as productname, "
        "case o_orderstatus when 'F' then 'Deposit' when 'O' then 'Loan' else 'Credit Card' end as productgroupname "
        "from orders"),
    "dimbranch": "select n_nationkey as branchkey, 'B'||lpad(n_nationkey::varchar,3,'0') as branchcode, "
                 "n_name as branchname, r_name as provincename from nation join region on n_regionkey=r_regionkey",
    "dimteller": "select s_suppkey as tellerkey, lpad(s_suppkey::varchar,6,'0') as tellernumber, s_name as tellername "
                 "from supplier",
    "dimclientcollections": "select r_regionkey as clientcollectionskey, r_name as clientstatusname from region",
    "dimdate": f"select distinct {_DAY.format('l_shipdate')} as datekey, l_shipdate::date as fulldate from lineitem",
    "dimtime": "select distinct l_linenumber as timekey, l_linenumber+7 as h, (l_linenumber*7)%60 as m from lineitem",
    "classification": "select n_nationkey as classkey, 'T'||lpad(n_nationkey::varchar,2,'0') as transactioncode, "
                      "n_name as classname from nation",
    "dimcard": (
        "select '4'||lpad(c_custkey::varchar,9,'0') as cardnumber, c_name as embossedname, "
        "case when c_custkey%6=0 then 'S' else 'P' end as cardholdertypecode, "
        "lpad(c_custkey::varchar,8,'0')||(c_custkey%10)::varchar as clientnumber, c_custkey as cardkey, "
        "case when c_custkey%6=0 then 'Secondary' else 'Primary' end as cardholdertypename, "
        "case when c_custkey%5<>0 then timestamp '2024-01-05 12:00:00' end as cardstoptimestamp, "
        "make_timestamp(2021, 1+c_custkey%12, 1, 8, 0, 0) as cardactivetimestamp, "
        "c_custkey % (select count(*) from supplier) as cardactivatedtellernumber from customer"),
    "factclient_all": (
        "select c_custkey*10+1 as clientkey, lpad(c_custkey::varchar,8,'0') as cifnumber, d as snap, "
        "lpad(pa::varchar,9,'0') as primarydepositaccountnumber, c_custkey as residentialaddresskey, "
        "c_nationkey as employerkey, c_nationkey%5 as clientcollectionskey from customer left join (select o_custkey, max(o_orderkey) as pa from orders "
        "group by o_custkey) a on a.o_custkey=c_custkey, (values (20240101),(20240102)) t(d) "
        "where d=20240101 or c_custkey%7<>0"),
    "factclient": "select * from factclient_all where snap=(select max(snap) from factclient_all)",
    "deposit_all": (
        "select l_orderkey as accountkey, lpad(l_orderkey::varchar,9,'0') as accountnumber, "
        "l_extendedprice::decimal(23,2) as currentbalanceamount, l_shipdate::date as snapshotdate, "
        "(l_shipdate::date - 3) as lastcust, l_linenumber%3 as stopsonaccountcount, 70 as productkey, "
        f"l_suppkey%25 as homebranchkey, {_DAY.format('l_shipdate')} as coveragedatekey, "
        "case when l_linenumber=7 then 1 else 0 end as isfinalload from lineitem union all "
        "select o_orderkey, lpad(o_orderkey::varchar,9,'0'), o_totalprice::decimal(23,2), date '2001-12-31', "
        "o_orderdate::date, o_orderkey%3, 70, o_custkey%25, 20011231, 0 from orders"),
    "line": "select * from lineitem join orders on o_orderkey=l_orderkey",
    "loan_all": (
        "select l_orderkey as accountkey, lpad(l_orderkey::varchar,9,'0') as accountnumber, o_custkey*10+1 as clientkey, "
        "79 as productkey, l_suppkey%25 as originatingbranchkey, d as coveragedatekey, "
        f"{_DAY.format('o_orderdate')} as lastadvancedatekey, {_DAY.format('l_shipdate')} as lastarrearsdatekey, "
        "l_linenumber as arrearsinstallmentcount, l_extendedprice::decimal(23,2) as loanbalanceamount, "
        f"{_SHARE.format('l_extendedprice', 'l_discount')} as loanarrearsamount, "
        "l_suppkey as loanofficertellerkey, l_linenumber%5 as clientcollectionskey from "
        f"(select *, {_DAY.format('l_shipdate')} as d from line union all select *, 20011231 from line)"),
    "credit_card": (
        "select o_custkey*10+1 as clientkey, l_orderkey as accountkey, o_totalprice::decimal(23,2) as creditlimitamount, "
        "(-l_extendedprice)::decimal(23,2) as currentbalanceamount, "
        f"{_SHARE.format('l_extendedprice', 'l_tax')} as arrearsamount, "
        f"{_SHARE.format('o_totalprice', '0.5')} as qualifycreditlimitamount, l_linenumber%4 as delinquentlevelnumber, "
        f"l_linenumber*30 as daysinarrearsnumber, {_DAY.format('l_shipdate')} as coveragedatekey, "
        f"{_DAY.format('o_orderdate')} as accountopendatekey, l_suppkey%25 as openingbranchkey from line"),
    "capout": "select o_orderkey as accountkey, o_totalprice::decimal(23,2) as advanceamount, "
              "o_custkey%25 as transactionbranchkey from orders",
    "ledger": (
        "select l_orderkey as accountkey, o_custkey*10+1 as clientkey, -(l_extendedprice::decimal(23,2)) as amount, "
        f"{_DAY.format('l_shipdate')} as datekey, "
        "case l_returnflag when 'R' then 50 when 'A' then 73 else 10 end as indicator, l_partkey%25 as classkey, "
        "l_linenumber as timekey, l_partkey as journal from line union all "
        "select 1000000000+l_suppkey, l_suppkey*10+1, l_extendedprice::decimal(23,2), "
        f"{_DAY.format('l_shipdate')}, 10, l_partkey%25, l_linenumber, l_partkey from line where l_linestatus='F'"),
    "message": (
        "select ts as datetime_req, '4'||lpad(user_id::varchar,9,'0') as pan, case when event_id%7=0 then '' "
        "when event_id%5=0 then '0' when event_id%13=0 then null else round(value*100)::bigint::varchar end as amount, "
        "event_type as tran_type, case when event_id%4=0 then '0200' else '0100' end as message_type, "
        "case when event_id%10=0 then '05' else '00' end as rsp_code_req, "
        "case when event_id%9=0 then '114' else '000' end as hold_response_key, "
        "case when event_id%2=0 then '05' else '90' end as pos_entry_mode, "
        "case event_id%3 when 0 then '00' when 1 then '01' else '99' end as pos_terminal_type, "
        "' M'||(event_id%500)::varchar||' ' as acceptor, 'SHOP '||(event_id%500)::varchar as acceptor_name, "
        "case when event_type='purchase' then '5999' else '4829' end as merchant_type, "
        "'T'||(event_id%97)::varchar as terminal_id, case when event_id%11=0 then 1 else 0 end as originated from events"),
    "merchant": "select distinct merchant_type as code, 'MCC '||merchant_type as name from message",
    "outcome": (
        "select lpad(o_custkey::varchar,8,'0')||(o_custkey%10)::varchar as cif, "
        "case when o_orderpriority in ('1-URGENT','2-HIGH') then 'A-NEW' else 'B-EXISTING' end as clienttype, "
        "o_orderdate::date as lrid_date, o_orderpriority as loanpurpose, 'SHOP'||(o_custkey%50)::varchar as retailername, "
        "o_orderstatus as privatesector, floor(o_totalprice::decimal(23,2)%1000)::int as score_mi, "
        "o_orderkey as record from orders"),
    "mis_client": "select lpad(c_custkey::varchar,8,'0') as cif, c_custkey % (select count(*) from supplier) as teller_key "
                  "from customer",
    "deposit": "select * from deposit_all where snapshotdate=(select max(snapshotdate) from deposit_all)",
    "incident": (
        "select 'R'||o_orderkey::varchar as recid, 'INC'||o_custkey::varchar||'-'||year(o_orderdate)::varchar "
        "as incidentnumber, o_orderdate as createddatetime, case when o_orderstatus='F' then 'Closed' else 'Open' end "
        "as status, lpad(o_custkey::varchar,8,'0')||(o_custkey%10)::varchar as clientcif, "
        "'AGENT '||(o_orderkey%40)::varchar as profilefullname, o_orderpriority as actualcategory from orders"),
    "dispute": (
        "select 'D'||o_orderkey::varchar as recid, 'R'||o_orderkey::varchar as incidentlink_recid, "
        "'TD'||o_orderkey::varchar as incidentnumber, o_orderpriority as fraudtype, o_orderdate as createddatetime "
        "from orders"),
    "disputed_line": (
        "select 'D'||l_orderkey::varchar as parentlink_recid, -(l_extendedprice::decimal(23,2)) as amount, "
        "l_shipdate as createddatetime, '4'||lpad(o_custkey::varchar,9,'0') as cardnumber, "
        "case when l_linenumber%4=0 then null else 'U'||l_orderkey::varchar end as incidentnumber, "
        "'TC'||l_linenumber::varchar as trancode, case when l_returnflag='R' then 'FEE' else 'POS' end as trantype, "
        "case when l_linenumber%6=0 then 'Monthly fee' else 'Line '||l_linenumber::varchar end as description, "
        "case when l_linestatus='F' then 'Yes' else 'No' end as disputed "
        "from lineitem join orders on o_orderkey=l_orderkey"),
    "case_folder": (
        "select 'CASE'||o_orderkey::varchar as case_id, o_orderdate as case_creation_date, "
        "'SURNAME'||(o_custkey%100)::varchar as case_client_surname, "
        "'ID'||lpad(o_custkey::varchar,10,'0') as case_id_passport_no, 'FIRST' as case_client_first_name, "
        "'CP'||(o_orderkey%30)::varchar as serving_consultant_cp_no from orders"),
}
_NEEDS = {"factclient": ["factclient_all"], "deposit": ["deposit_all"], "loan_all": ["line"], "credit_card": ["line"],
          "ledger": ["line"], "merchant": ["message"]}


def _part(c: str) -> str:
    return f"case when trim({c})='' then '' else ' '||trim({c}) end"


_MIDDLE = "||".join(_part(f"dc.{c}") for c in ("middlefirstname", "middlesecondname", "middlethirdname"))

_RAW_NAME = "{0}.firstname||' '||{0}.middlefirstname||' '||{0}.middlesecondname||' '||{0}.middlethirdname"
_KEY_DAY = "try_strptime({}::varchar, '%Y%m%d')::date"
_MAJOR = "(case when amount in ('','0') then 0 else try_cast(amount as decimal(23,2))/100 end)::decimal(23,2)"


def _blanks(names: str) -> str:
    return "".join(f"'' as \"{n}\", " for n in names.split())


def _codes(column: str, code: str, name: str) -> str:
    """Distinct (code, name) pairs of the indicator table, a row of which each event leaves."""
    return f"(select distinct {column} as {code}, {name} from message)"


REPORTS: dict[str, tuple[list[str], str]] = {
    "full_arrears": (
        ["dimclient", "dimaccount", "dimcard", "dimteller", "factclient", "deposit", "loan_all", "capout", "dimemployer",
         "dimproduct", "dimbranch", "dimclientcollections", "outcome"], (
        "accounts as (select a.accountnumber, a.accountnumberwithcheckdigit as k from dimaccount a where rowiscurrent=1 and "
        "accountnumber in (select f.primarydepositaccountnumber from factclient f join dimclient d on d.cifnumber=f.cifnumber "
        "and d.rowiscurrent=1 where d.lastname='HOUSEHOLD')), "
        "first_teller as (select * from (select ca.clientnumber, t.tellerkey, row_number() over (partition by ca.clientnumber "
        "order by ca.cardactivetimestamp, t.tellerkey, ca.cardactivatedtellernumber) as rn from dimcard ca join dimteller t "
        "on t.tellernumber::int=ca.cardactivatedtellernumber) where rn=1), "
        "awt as (select d.cifnumber as cif, ft.tellerkey, a.k from factclient f join dimclient d on d.clientkey=f.clientkey "
        "and d.rowiscurrent=1 join accounts a on a.accountnumber=f.primarydepositaccountnumber "
        "join first_teller ft on ft.clientnumber=d.cifwithcheckdigit) "
        "select distinct dc.partyidentifiertypenumber as id_number, dc.cifwithcheckdigit as cif_check_digit, "
        "dc.clientcreatedate as client_create_date, ltrim(t.tellernumber,'0')||' - '||t.tellername as create_teller, "
        "a2.accountnumberwithcheckdigit as primary_deposit_account, fd.currentbalanceamount as dep_bal, "
        "case when fd.stopsonaccountcount>0 then 'Yes' else 'No' end as account_stopped, "
        f"da.accountnumberwithcheckdigit as loan_contract, {_KEY_DAY.format('fl.lastadvancedatekey')} as application_date, "
        f"o.clienttype as client_type, {_KEY_DAY.format('fl.lastarrearsdatekey')} as default_date, "
        "fl.arrearsinstallmentcount as num_arrears_installments, o.loanpurpose as loan_purpose, "
        "o.retailername as retailer_name, o.privatesector as mie, fl.loanbalanceamount as loan_bal, "
        "fl.loanarrearsamount as loan_arrears, dp.productname as product_desc, "
        "case when dp.productgroupname in ('Loan','Facility','Credit Card') then ltrim(t2.tellernumber,'0')||' - '||t2.tellername "
        "end as loan_teller, db.branchname as branch_name, db.provincename as province, "
        "cc.clientstatusname as client_handed_over_status, de.employernumber as employer_no, "
        "de.employername as employer_name, de.industry as industry, ca.advanceamount as capout, o.score_mi as prism_score, "
        "case when fl.loanbalanceamount<>0 then printf('%.2f %%', "
        "100*round(fl.loanarrearsamount::double/fl.loanbalanceamount::double, 2)) end as client_arrears_ratio "
        "from loan_all fl join dimaccount da on da.accountkey=fl.accountkey and da.rowiscurrent=1 "
        "left join capout ca on ca.accountkey=fl.accountkey join dimclient dc on dc.clientkey=fl.clientkey and dc.rowiscurrent=1 "
        "join awt on awt.cif=dc.cifnumber join factclient fc on fc.clientkey=dc.clientkey "
        "join dimemployer de on de.employerkey=fc.employerkey join dimproduct dp on dp.productkey=fl.productkey "
        "join dimteller t on t.tellerkey=awt.tellerkey "
        "join dimaccount a2 on a2.accountnumber=fc.primarydepositaccountnumber and a2.rowiscurrent=1 "
        "join deposit fd on fd.accountkey=a2.accountkey left join dimbranch db on db.branchkey=ca.transactionbranchkey "
        "left join dimteller t2 on t2.tellerkey=fl.loanofficertellerkey "
        "left join dimclientcollections cc on cc.clientcollectionskey=fl.clientcollectionskey "
        "join outcome o on o.cif=dc.cifwithcheckdigit and o.clienttype in ('A-NEW','B-EXISTING') "
        "and o.lrid_date between date '1995-01-01' and date '2001-12-31' "
        "where fl.coveragedatekey=(select max(coveragedatekey) from loan_all) "
        f"and {_KEY_DAY.format('fl.lastadvancedatekey')} between date '1995-01-01' and date '2001-12-31' "
        "and a2.accountnumberwithcheckdigit in (select k from awt)")),
    "full_contra": (
        ["dimclient", "dimaccount", "dimemployer", "factclient", "ledger", "classification", "dimdate", "dimtime"], (
        "recent as (select l.accountkey, l.clientkey, l.amount, l.datekey, l.timekey, l.journal, c.transactioncode from ledger l "
        "join classification c on c.classkey=l.classkey join dimtime ti on ti.timekey=l.timekey "
        "join dimdate di on di.datekey=l.datekey where l.datekey>=19990101), "
        "flagged as (select distinct accountkey from ledger where indicator in (50,73)), "
        "credit as (select * from recent where amount>0), "
        "debit as (select r.*, -amount as matched from recent r where amount<0 and accountkey in (select accountkey from flagged)), "
        "pairs as (select a.accountkey as ca, a.clientkey as cc, a.amount as camt, a.transactioncode as ccode, "
        "b.accountkey as da, b.clientkey as dc, b.amount as damt, b.transactioncode as dcode, a.datekey, a.timekey, a.journal "
        "from credit a join debit b on a.datekey=b.datekey and a.timekey=b.timekey and a.journal=b.journal "
        "and b.matched=a.amount where a.accountkey<>b.accountkey and a.clientkey<>b.clientkey), "
        f"found as (select distinct m.cifwithcheckdigit as cif_check_digit, {_RAW_NAME.format('m')} as main_first_name, "
        "m.lastname as main_last_name, e.employername as main_employer_name, sa.accountnumberwithcheckdigit as staff_account, "
        "mc.transactioncode as main_tran_code, mc.classname as main_tran_desc, p.camt as main_amount, "
        f"st.accountnumberwithcheckdigit as stopped_account, {_RAW_NAME.format('b')} as balance_first_name, "
        "b.lastname as balance_last_name, e.employername as balance_employer_name, d.fulldate as tran_date, "
        "ti.h::varchar||'h'||ti.m::varchar as tran_time, bc.transactioncode as balance_tran_code, "
        "bc.classname as balance_tran_desc, p.damt as balance_amount, p.journal::varchar as journalnumber, ti.h, ti.m "
        "from pairs p join factclient f on f.clientkey=p.cc join dimclient m on m.clientkey=f.clientkey and m.rowiscurrent=1 "
        "join dimemployer e on e.employerkey=f.employerkey join dimaccount sa on sa.accountkey=p.ca and sa.rowiscurrent=1 "
        "join classification mc on mc.transactioncode=p.ccode join dimaccount st on st.accountkey=p.da and st.rowiscurrent=1 "
        "join dimdate d on d.datekey=p.datekey join dimtime ti on ti.timekey=p.timekey "
        "join classification bc on bc.transactioncode=p.dcode join dimclient b on b.clientkey=p.dc and b.rowiscurrent=1) "
        "select * exclude (h, m) from (select * from found qualify row_number() over (partition by cif_check_digit order by "
        "tran_date desc, h desc, m desc, main_first_name nulls last, main_last_name, main_employer_name, staff_account, "
        "main_tran_code, main_tran_desc, main_amount, stopped_account, balance_first_name nulls last, balance_last_name, "
        "balance_employer_name, tran_time, balance_tran_code, balance_tran_desc, balance_amount, journalnumber)=1) "
        "where contains(balance_employer_name, 'STAFF')")),
    "full_tollgate": (
        ["dimclient", "dimaccount", "dimcard", "credit_card", "message", "merchant"], (
        "newest as (select c.*, d.cifwithcheckdigit, a.accountnumberwithcheckdigit as account from credit_card c "
        "join dimclient d on d.clientkey=c.clientkey and d.rowiscurrent=1 "
        "join dimaccount a on a.accountkey=c.accountkey and a.rowiscurrent=1 and a.accountstatusname='P' "
        "qualify row_number() over (partition by c.accountkey order by coveragedatekey desc, creditlimitamount, "
        "currentbalanceamount, arrearsamount, qualifycreditlimitamount, delinquentlevelnumber, daysinarrearsnumber)=1) "
        "select distinct p.datetime_req as tran_date, p.datetime_req::date as date, "
        "case p.pos_terminal_type when '00' then 'NAD' when '01' then 'POS' end as device_type, p.pan as card_no, "
        "ca.cardstoptimestamp::date as card_stop_date, n.account, p.hold_response_key, "
        "n.qualifycreditlimitamount as initial_cred_lim, n.creditlimitamount as current_cred_lim, "
        "n.currentbalanceamount as credit_used, n.arrearsamount as arrears_amount, n.delinquentlevelnumber as delinquent_level, "
        "n.daysinarrearsnumber as aging_days_key, n.currentbalanceamount+n.creditlimitamount as credit_available, "
        f"{_MAJOR} as tran_amount_req, {_MAJOR} as settle_amount_req, tt.tc as tran_type, tt.tn as tran_type_desc, "
        "rc.rc as response_code, rc.rn as response_code_desc, trim(p.acceptor) as merchant_id, p.acceptor_name as merchant_name, "
        "p.merchant_type, mt.name as merchant_type_desc, p.terminal_id, em.ec as pos_entry_mode, ms.mc as message_type, "
        "ms.mn as message_type_desc, '400000' as acquiring_inst_id_code, '5' as pos_card_data_input_ability, "
        "'1' as pos_card_data_input_mode, '0' as pos_cardholder_present from message p "
        f"left join {_codes('tran_type', 'tc', 'upper(tran_type) as tn')} tt on tt.tc=p.tran_type "
        "left join "
        + _codes("rsp_code_req", "rc", "case when rsp_code_req='00' then 'Approved' else 'Do not honour' end as rn")
        + " rc on rc.rc=p.rsp_code_req left join "
        + _codes("pos_entry_mode", "ec", "case when pos_entry_mode='05' then 'Chip' else 'Contactless' end as en")
        + " em on em.ec=p.pos_entry_mode left join "
        + _codes("message_type", "mc", "case when message_type='0100' then 'Authorisation' else 'Financial' end as mn")
        + " ms on ms.mc=p.message_type left join merchant mt on mt.code=p.merchant_type "
        "join dimcard ca on ca.cardnumber=p.pan join newest n on n.cifwithcheckdigit=ca.clientnumber "
        "where p.originated=0 and p.hold_response_key<>'114' and p.merchant_type='5999' "
        "and p.datetime_req::date>=ca.cardstoptimestamp::date")),
    "full_aml": (
        ["dimclient", "dimaccount", "dimcard", "dimproduct", "dimbranch", "dimaddress", "dimemployer", "factclient_all",
         "deposit_all", "loan_all"], (
        "client as (select distinct clientnumber from dimaccount where accountnumberwithcheckdigit in "
        "(select a.accountnumberwithcheckdigit from dimaccount a join dimclient d on d.cifnumber=a.clientnumber "
        "and d.rowiscurrent=1 where a.rowiscurrent=1 and d.lastname='MACHINERY' and a.accountstatusname='F')), "
        "own as (select * from dimaccount where rowiscurrent=1 and clientnumber in (select clientnumber from client)), "
        "dep as (select o.*, f.currentbalanceamount as bal, p.productgroupname, p.productname, b.branchcode, b.branchname, "
        "f.productkey from own o join deposit_all f on f.accountnumber=o.accountnumber left join dimproduct p "
        "on p.productkey=f.productkey join dimbranch b on b.branchkey=f.homebranchkey qualify row_number() over "
        "(partition by o.accountnumber, o.accountnumberwithcheckdigit order by f.coveragedatekey desc, o.clientnumber, "
        "bal, o.accountstatusname, f.productkey, p.productgroupname, p.productname, o.accountopendate, b.branchcode, "
        "b.branchname)=1), "
        "loan as (select o.*, coalesce(f.currentbalanceamount, 0)::decimal(23,2) as bal, p.productgroupname, p.productname, "
        "b.branchcode, b.branchname, l.productkey from own o join loan_all l on l.accountnumber=o.accountnumber "
        "left join deposit_all f on f.accountnumber=l.accountnumber and (f.coveragedatekey=(select max(coveragedatekey) "
        "from deposit_all) or f.isfinalload=1) left join dimproduct p on p.productkey=l.productkey "
        "join dimbranch b on b.branchkey=l.originatingbranchkey qualify row_number() over "
        "(partition by o.accountnumber, o.accountnumberwithcheckdigit order by l.coveragedatekey desc, "
        "f.coveragedatekey desc nulls last, o.clientnumber, bal, o.accountstatusname, l.productkey, p.productgroupname, "
        "p.productname, o.accountopendate, b.branchcode, b.branchname)=1), "
        "acc as (select * from dep union all select * from loan), "
        "snap as (select * from factclient_all where cifnumber in (select clientnumber from client) qualify row_number() "
        "over (partition by cifnumber order by snap desc, residentialaddresskey, employerkey, primarydepositaccountnumber nulls last)=1), "
        "details as (select distinct s.cifnumber, case when r.l1=q.l1 and length(r.l2)=0 and length(r.l3)=0 then q.l1||', '||q.city "
        "else r.l1||', '||r.l2||', '||r.l3||', '||r.city||', '||r.postcode end as home_address, "
        "a.accountnumberwithcheckdigit, e.employername from snap s join dimaccount a "
        "on a.accountnumber=s.primarydepositaccountnumber join dimemployer e on e.employerkey=s.employerkey "
        "join dimaddress r on r.addresskey=s.residentialaddresskey join dimaddress q on q.addresskey=s.residentialaddresskey) "
        "select distinct a.accountnumberwithcheckdigit as account_number_check_digit, dc.cifwithcheckdigit as cif_number, "
        "a.productgroupname as product_group, a.productname as product_desc, dc.titlename as title, dc.firstname as first_name, "
        "dc.lastname as last_name, dc.birthdate as date_of_birth, "
        "date_diff('day', dc.birthdate, date '2024-07-15')//365 as age, dc.clientcreatedate as first_client_contact_date, "
        "a.accountopendate as date_opened, a.branchcode as home_branch_code, a.branchname as home_branch_name, "
        "k.cardnumber as card_prim_no, 'ACTIVE' as card_status, k.cardholdertypename as card_type, k.embossedname as card_name, "
        "timestamp '2021-02-03 10:00:00' as card_allocated_date, dc.partyidentifiertypenumber as id_number, "
        "dc.partyidentifiertypename as id_type, d.employername as employer_name, d.home_address, "
        "dc.homephonenumber as phone_home, dc.workphonenumber as phone_work, dc.mobilephonenumber as phone_cell, "
        "a.bal as balance_on_account, a.accountstatusname as account_status from dimclient dc "
        "join dimcard k on substr(k.clientnumber,1,8)=dc.cifnumber and k.cardholdertypecode='P' "
        "join acc a on a.clientnumber=dc.cifnumber join details d on d.cifnumber=dc.cifnumber "
        "where dc.cifnumber in (select clientnumber from client)")),
    "full_employer": (
        ["dimclient", "dimaccount", "dimaddress", "dimemployer", "dimclientcollections", "dimproduct", "dimbranch", "dimteller",
         "factclient", "deposit_all", "loan_all", "credit_card", "capout", "mis_client"], (
        "search as (select employernumber as k from dimemployer where industry='EUROPE' union select "
        "accountnumberwithcheckdigit from dimaccount where rowiscurrent=1 and accountstatusname='P' "
        "and accountopendate>=timestamp '2001-06-01 00:00:00'), "
        "deposit_key as (select accountkey, homebranchkey from deposit_all where coveragedatekey=(select max(coveragedatekey) "
        "from deposit_all)), "
        "loan as (select distinct l.accountkey, l.lastadvancedatekey, c.advanceamount, b.branchname, b.branchcode "
        "from loan_all l join capout c on c.accountkey=l.accountkey left join (select c_custkey*10+1 as clientkey, "
        "c_nationkey as lastloanbranchkey from customer) s on s.clientkey=l.clientkey "
        "left join dimbranch b on b.branchkey=s.lastloanbranchkey), "
        "card as (select distinct c.accountkey, c.creditlimitamount, c.accountopendatekey, b.branchname, b.branchcode "
        "from credit_card c left join dimbranch b on b.branchkey=c.openingbranchkey) "
        "select distinct a2.accountnumberwithcheckdigit as primary_deposit_account, "
        "coalesce(l.branchname, b2.branchname, c.branchname) as branch_name, '' as branch_street_address, "
        "coalesce(l.branchcode, b2.branchcode, c.branchcode) as branch_code, "
        "case when p.productgroupname not in ('Loan','Credit Card') then a.accountnumberwithcheckdigit end as savings_account, "
        "case when p.productgroupname in ('Loan','Credit Card') then a.accountnumberwithcheckdigit end as loan_contract, "
        "case p.productgroupname when 'Loan' then l.advanceamount when 'Credit Card' then c.creditlimitamount end as amount_lost, "
        + _blanks("amount_prevented forensics_case_nr saps_case_nr") +
        "dc.titlename, dc.initials, dc.lastname, dc.partyidentifiertypenumber as id_number, "
        + _blanks("postal_address_1 postal_address_2 postal_address_3 postal_code") +
        "ad.l1 as home_address_1, ad.l2 as home_address_2, ad.l3 as home_address_3, ad.postcode as post_code, "
        + _blanks("application_no") +
        f"case p.productgroupname when 'Loan' then {_KEY_DAY.format('l.lastadvancedatekey')} "
        f"when 'Credit Card' then {_KEY_DAY.format('c.accountopendatekey')} end as application_date, "
        + _blanks("application_company status decline_reason_code if_07_details") +
        "dc.homephonenumber as phone_home, dc.mobilephonenumber as phone_cell, de.employername, "
        + _blanks("gross_salary") + "dc.workphonenumber as phone_work, "
        + _blanks("e-mail ref_title ref_initials ref_surname ref_home_telephone ref_work_telephone ref_telephone fam_title "
                  "fam_initials fam_surname fam_home_telephone fam_work_telephone fam_telephone credit_card_number bank_name "
                  "branch_number bank_account_number bank_account_type") +
        "dc.clientcreatedate::date as clientcreatedate, ltrim(t.tellernumber,'0')||' - '||t.tellername as create_teller, "
        "a.accountstatusname as account_status, cc.clientstatusname as client_handed_over_status, "
        "case when p.productgroupname<>'Loan' then a.accountopendate end as savings_account_open_date "
        "from factclient f join dimclient dc on dc.clientkey=f.clientkey and dc.rowiscurrent=1 "
        "join mis_client mc on mc.cif=dc.cifnumber join dimteller t on t.tellerkey=mc.teller_key "
        "join dimaddress ad on ad.addresskey=f.residentialaddresskey join dimemployer de on de.employerkey=f.employerkey "
        "join dimaccount a on a.clientnumber=dc.cifnumber and a.rowiscurrent=1 "
        "join dimaccount a2 on a2.accountnumber=f.primarydepositaccountnumber and a2.rowiscurrent=1 "
        "join dimclientcollections cc on cc.clientcollectionskey=f.clientcollectionskey "
        "left join deposit_key fd on fd.accountkey=a.accountkey left join dimbranch b2 on b2.branchkey=fd.homebranchkey "
        "join dimproduct p on p.productcode=a.accounttypecode||'|'||a.accountcategorycode "
        "left join loan l on l.accountkey=a.accountkey left join card c on c.accountkey=a.accountkey "
        "where de.employernumber in (select k from search) or a.accountnumberwithcheckdigit in (select k from search)")),
    "full_case_lookup": (["dimclient", "case_folder"], (
        "select * from case_folder where case_creation_date > timestamp '1998-01-01' and case_id_passport_no in "
        "(select partyidentifiertypenumber from dimclient where rowiscurrent=1 and lastname='AUTOMOBILE')")),
    "full_client_lookup": (["dimclient", "dimaccount", "dimaddress", "dimemployer", "factclient", "deposit"], (
        "select dc.partyidentifiertypenumber as id_number, dc.cifwithcheckdigit as cif_number, "
        f"trim(trim(dc.titlename)||' '||trim(dc.firstname)||{_MIDDLE}||{_part('dc.lastname')}) "
        "as title_firstnames_lastname, dc.mobilephonenumber as phone_cell, dc.workphonenumber as phone_work, "
        "dc.clientcreatedate::date as client_create_date, "
        "da.accountnumberwithcheckdigit as primary_deposit_account, da.accountopendate::date as account_open_date, "
        "fd.lastcust as last_cust_tran_date, fd.currentbalanceamount as account_balance, "
        "case when fd.stopsonaccountcount>0 then 'Yes' else 'No' end as account_stopped, "
        "replace(replace(trim(ad.l1)||', '||trim(ad.l2)||', '||trim(ad.l3)||', '||trim(ad.city), ', , ', ', '), "
        "', , ', ', ') as home_address, de.employername as employer_name "
        "from factclient fc join dimclient dc on dc.cifnumber=fc.cifnumber and dc.rowiscurrent=1 "
        "join dimaccount da on da.accountnumber=fc.primarydepositaccountnumber and da.rowiscurrent=1 "
        "join deposit fd on fd.accountkey=da.accountkey "
        "join dimaddress ad on ad.addresskey=fc.residentialaddresskey "
        "join dimemployer de on de.employerkey=fc.employerkey "
        "where fc.primarydepositaccountnumber in (select f.primarydepositaccountnumber from factclient f "
        "join dimclient d on d.cifnumber=f.cifnumber and d.rowiscurrent=1 where d.lastname='BUILDING')")),
    "full_card_search": (["dimclient", "dimaccount", "dimcard", "deposit"], (
        "select da.accountnumberwithcheckdigit as account_number_check_digit, fd.currentbalanceamount as dep_bal, "
        f"dc.cifwithcheckdigit as cif_check_digit, trim(trim(dc.firstname)||{_MIDDLE}) as first_name, "
        "dc.lastname as last_name, dc.partyidentifiertypenumber as id_number, ca.cardnumber as card_no, "
        "ca.embossedname as card_name, ca.cardholdertypecode as card_holder_type, "
        "date '2027-02-28' as expiry_dates, date '2021-02-03' as create_date, null::date as replacement_date, "
        "'ACTIVE' as card_status from dimcard ca "
        "join dimaccount da on da.clientnumber=substr(ca.clientnumber,1,8) and da.rowiscurrent=1 "
        "join dimclient dc on dc.cifwithcheckdigit=ca.clientnumber and dc.rowiscurrent=1 "
        "join deposit fd on fd.accountnumber=da.accountnumber where ca.cardnumber in "
        "(select x.cardnumber from dimcard x join dimclient d on d.cifwithcheckdigit=x.clientnumber "
        "and d.rowiscurrent=1 where d.lastname='FURNITURE')")),
    "full_incidents": (["dimclient", "factclient", "incident"], (
        "select incidentnumber as incident_number, cifwithcheckdigit as cif_check_digit, "
        "partyidentifiertypenumber as id_number, firstname as first_name, lastname as last_name, "
        "primarydepositaccountnumber as primary_deposit_account, null::varchar as non_cb_client_id_number, "
        "createddatetime::date as incident_create_date, profilefullname as owner_full_name, "
        "actualcategory as actual_category, 'Card' as actual_sub_category, 'Dispute' as actual_issue, "
        "'Card dispute' as subject, 'Unknown debit' as symptom, 'Investigated' as resolution "
        "from factclient fc join dimclient dc on dc.clientkey=fc.clientkey and dc.rowiscurrent=1 "
        "join incident i on i.clientcif=dc.cifwithcheckdigit qualify row_number() over (partition by incidentnumber "
        "order by createddatetime desc nulls last, profilefullname nulls last, actualcategory nulls last)=1")),
    "full_missed_fraud": (["dimclient", "incident", "dispute", "disputed_line"], (
        "select dc.clientkey, i.incidentnumber as csi_incident_number, u.incidentnumber as incidentnumber_utd, "
        "t.incidentnumber as incidentnumber_td, '' as strack_ref, u.cardnumber as card_no, "
        "substr(u.cardnumber,1,6) as bin, u.trancode as tran_code, u.trantype as tran_desc, "
        "i.createddatetime::date as incident_date, t.createddatetime as createddatetime_td, "
        "t.createddatetime as lastmoddatetime_td, '' as tran_id, u.description, u.amount, "
        "u.createddatetime as csi_log_date, substr(t.fraudtype,1,1) as fruad_code, "
        "t.fraudtype as fruad_description, 'Refund' as summary_resolution "
        "from disputed_line u join dispute t on t.recid=u.parentlink_recid "
        "join incident i on i.recid=t.incidentlink_recid and lower(i.status)='closed' "
        "join dimclient dc on dc.cifwithcheckdigit=i.clientcif and dc.rowiscurrent=1 "
        "where u.createddatetime::date=date '1998-09-30' and u.amount<0 and u.incidentnumber is not null "
        "and lower(u.description) not like '%fee%' and lower(u.trantype) not like '%fee%' "
        "and lower(u.disputed)='yes' order by csi_log_date, amount")),
}


def full_report_sql() -> dict[str, str]:
    out = {}
    for name, (relations, sql) in REPORTS.items():
        need = dict.fromkeys(x for r in relations for x in [*_NEEDS.get(r, []), r])
        own = ", " if sql.split(" ", 2)[1] == "as" else " "      # CTEs of the report itself come after the relations
        out[name] = "with " + ", ".join(f"{r} as ({RELATIONS[r]})" for r in need) + own + sql
    return out
