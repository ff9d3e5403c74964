"""Golden cases for the contra, evidence-pack, arrears, tollgate and
employer reports (invented values)."""

import datetime as dt

from wh import D, M, T, rows, warehouse

from fincrime.functions import month_floor_filter
from fincrime.plans.reports import (aml_evidence, arrears, employer_accounts, staff_from_stopped,
                                    tollgate)


# ------------------------------------------------------------------ contra
def _leg(acc, cli, amt, date, time, journal, ind=10, cls=1):
    return dict(accountkey=acc, clientkey=cli, transactionamount=M(amt), transactiondatekey=date,
                transactionindicatorskey=ind, transactionclassificationkey=cls,
                postedtransactiondatekey=date, postedtransactiontimekey=time, journalnumber=journal)


def _contra_wh(spark):
    ledger = [
        _leg(301, 3, 100, 20240610, 905, "J1"), _leg(401, 4, -100, 20240610, 905, "J1", 50, 2),
        _leg(301, 3, 70, 20240610, 1030, "J2"), _leg(401, 4, -70, 20240610, 1030, "J2", 50, 2),
        _leg(301, 3, 55, 20240610, 905, "J3"), _leg(401, 4, -55, 20240610, 905, "J4", 50, 2),
        _leg(401, 4, 30, 20240610, 905, "J5"), _leg(401, 4, -30, 20240610, 905, "J5", 50, 2),
        _leg(402, 4, 40, 20240610, 905, "J6"), _leg(401, 4, -40, 20240610, 905, "J6", 50, 2),
        _leg(301, 3, 25, 20240610, 905, "J7"), _leg(501, 5, -25, 20240610, 905, "J7", 10, 2),
        _leg(301, 3, 10, 20240501, 905, "J8"), _leg(401, 4, -10, 20240501, 905, "J8", 50, 2),
        _leg(401, 4, -1, 20240602, 905, "JX", 73, 2),
    ]
    return warehouse(spark, {
        "facttransaction": ledger,
        "vwdimtransactionclassification": [
            dict(transactionclassificationkey=1, transactioncode="CR",
                 transactionclassificationname="Credit transfer", rowiscurrent=1),
            dict(transactionclassificationkey=2, transactioncode="DR",
                 transactionclassificationname="Debit transfer", rowiscurrent=1)],
        "dimtime": [dict(timekey=905, fulltime=T("2000-01-01 09:05:00")),
                    dict(timekey=1030, fulltime=T("2000-01-01 10:30:00"))],
        "dimdate": [dict(datekey=k, fulldate=D(f"{str(k)[:4]}-{str(k)[4:6]}-{str(k)[6:]}"))
                    for k in (20240610, 20240602, 20240501)],
        "factclient": [dict(clientkey=3, employerkey=7, clientsnapshotdatekey=20240701),
                       dict(clientkey=3, employerkey=8, clientsnapshotdatekey=20240601)],
        "dimclient": [
            dict(clientkey=3, cifwithcheckdigit="300000039", firstname="CAROL", middlefirstname="A",
                 middlesecondname="B", middlethirdname="C", lastname="STAFF", rowiscurrent=1),
            dict(clientkey=4, cifwithcheckdigit="400000043", firstname="DAVE", middlefirstname="",
                 middlesecondname="", middlethirdname="", lastname="PAYER", rowiscurrent=1),
            dict(clientkey=5, cifwithcheckdigit="500000051", firstname="ERIN", middlefirstname="",
                 middlesecondname="", middlethirdname="", lastname="OTHER", rowiscurrent=1)],
        "dimemployer": [dict(employerkey=7, employername="BIGBANK STAFF", rowiscurrent=1),
                        dict(employerkey=8, employername="OTHER", rowiscurrent=1)],
        "dimaccount": [dict(accountkey=k, accountnumberwithcheckdigit=f"{k}0000001", rowiscurrent=1)
                       for k in (301, 401, 402, 501)],
    })


def test_contra_newest_pair_by_real_time(spark):
    w = _contra_wh(spark)
    out = staff_from_stopped(w, "BANK", as_of=dt.date(2024, 7, 15))
    assert len(out.columns) == 18
    got = [tuple(r) for r in out.collect()]
    assert got == [(
        "300000039", "CAROL A B C", "STAFF", "BIGBANK STAFF", "3010000001", "CR", "Credit transfer",
        M(70), "4010000001", "DAVE   ", "PAYER", "BIGBANK STAFF", D("2024-06-10"), "10h30", "DR",
        "Debit transfer", M(-70), "J2")]


def test_contra_pairs_rules(spark):
    from fincrime.operators import contra_entry_match, flagged_accounts
    from fincrime.plans.reports.contra import recent_transactions
    w = _contra_wh(spark)
    led = recent_transactions(w, dt.date(2024, 7, 15))
    fl = flagged_accounts(w["facttransaction"], [50, 73])
    assert rows(fl, "accountkey") == [(401,)]  # both codes: listed once
    pairs = contra_entry_match(led, fl, keys=("transactiondatekey", "timekey", "journalnumber"))
    got = rows(pairs, "journalnumber", "credit_account", "debit_account", "credit_amount",
               "debit_amount")
    assert got == [("J1", 301, 401, M(100), M(-100)), ("J2", 301, 401, M(70), M(-70))]
    for r in pairs.collect():  # property: pairs sum to zero, never share account or client
        assert r.credit_amount + r.debit_amount == 0
        assert r.credit_account != r.debit_account and r.credit_client != r.debit_client


def test_contra_filters(spark):
    w = _contra_wh(spark)
    assert staff_from_stopped(w, "NOPE", as_of="2024-07-15").count() == 0
    assert staff_from_stopped(w, "bank", as_of="2024-07-15").count() == 0  # LIKE is case-sensitive
    assert staff_from_stopped(w, "BANK", as_of="2024-07-15", clients=["999"]).count() == 0
    assert staff_from_stopped(w, "BANK", as_of="2024-07-15", clients=["300000039"]).count() == 1


def test_month_floor_january(spark):
    df = spark.createDataFrame([(D("2023-11-30"),), (D("2023-12-01"),), (D("2024-01-10"),)], "d date")
    intended = rows(df.filter(month_floor_filter("d", "2024-01-15", 30)), "d")
    faithful = rows(df.filter(month_floor_filter("d", "2024-01-15", 30, faithful=True)), "d")
    assert intended == [(D("2023-12-01"),), (D("2024-01-10"),)]
    assert faithful == [(D("2023-12-01"),)]  # the source's year/month test loses January


# ------------------------------------------------------------------ AML
def _aml_wh(spark):
    acc = dict(accountstatusname="OPEN", accountopendate=T("2020-01-01 00:00:00"), clientnumber="C0000001",
               rowiscurrent=1)
    card = dict(cardnumber="K1", primarycardnumber="K1", cardholdertypecode="P",
                cardholdertypename="Primary", cardstatusname="ACTIVE", embossedname="A LEE",
                partyidentifiernumber="ID-A", cardcreationdate=T("2021-02-03 00:00:00"),
                clientnumber="C00000019", rowiscurrent=1)
    return warehouse(spark, {
        "dimaccount": [
            {**acc, "accountnumber": "D0000001", "accountnumberwithcheckdigit": "D00000015"},
            {**acc, "accountnumber": "L0000001", "accountnumberwithcheckdigit": "L00000013"},
            {**acc, "accountnumber": "L0000002", "accountnumberwithcheckdigit": "L00000021"},
            {**acc, "accountnumber": "X0000009", "accountnumberwithcheckdigit": "X00000099",
             "clientnumber": "C0000009"},
        ],
        "factdepositaccountdailycoverage": [
            dict(accountnumber="D0000001", currentbalanceamount=M(100), productkey=1, homebranchkey=1,
                 coveragedatekey=20240101, isfinalload=0),
            dict(accountnumber="D0000001", currentbalanceamount=M(150), productkey=1, homebranchkey=1,
                 coveragedatekey=20240102, isfinalload=0),
            dict(accountnumber="L0000001", currentbalanceamount=M(900), productkey=2, homebranchkey=2,
                 coveragedatekey=20240102, isfinalload=0),
            dict(accountnumber="L0000001", currentbalanceamount=M(800), productkey=2, homebranchkey=2,
                 coveragedatekey=20231201, isfinalload=1),
        ],
        "factloanaccountdailycoverage": [
            dict(accountnumber="L0000001", productkey=2, originatingbranchkey=2, coveragedatekey=20240101),
            dict(accountnumber="L0000001", productkey=2, originatingbranchkey=2, coveragedatekey=20240102),
            dict(accountnumber="L0000002", productkey=2, originatingbranchkey=2, coveragedatekey=20240102),
        ],
        "dimproduct": [dict(productkey=1, productgroupname="Deposit", productname="Savings"),
                       dict(productkey=2, productgroupname="Loan", productname="Personal loan")],
        "dimbranch": [dict(branchkey=1, branchcode="B1", branchname="North"),
                      dict(branchkey=2, branchcode="B2", branchname="South")],
        "dimcard": [{**card, "cardkey": 11}, {**card, "cardkey": 12},
                    {**card, "cardkey": 13, "cardnumber": "K2", "cardholdertypecode": "S"},
                    {**card, "cardkey": 14, "cardnumber": "K3", "rowiscurrent": 0}],
        "factclient": [
            dict(cifnumber="C0000001", residentialaddresskey=10, postaladdresskey=11, employerkey=5,
                 primarydepositaccountnumber="D0000001", clientsnapshottimestamp=T("2024-01-01 00:00:00")),
            dict(cifnumber="C0000001", residentialaddresskey=20, postaladdresskey=21, employerkey=5,
                 primarydepositaccountnumber="D0000001", clientsnapshottimestamp=T("2024-01-02 00:00:00")),
        ],
        "dimemployer": [dict(employerkey=5, employername="ACME")],
        "dimaddress": [
            dict(addresskey=10, addressline1text="OLD", addressline2text="x", addressline3text="y",
                 addresscityname="Q", addresspostcode="1"),
            dict(addresskey=11, addressline1text="OLD", addresscityname="Q"),
            dict(addresskey=20, addressline1text="5 OAK ST", addressline2text="", addressline3text="",
                 addresscityname="PAARL", addresspostcode="7646"),
            dict(addresskey=21, addressline1text="5 OAK ST", addresscityname="PAARL"),
        ],
        "dimclient": [dict(cifnumber="C0000001", cifwithcheckdigit="C00000019", titlename="MS",
                           firstname="ANN", lastname="LEE", birthdate=D("2000-07-16"),
                           clientcreatedate=T("2010-01-01 00:00:00"), partyidentifiertypenumber="ID-A")],
    })


def test_aml_cards_times_accounts(spark):
    out = aml_evidence(_aml_wh(spark), ["D00000015"], as_of=dt.date(2024, 7, 15))
    assert len(out.columns) == 27
    got = rows(out, "account_number_check_digit", "product_group", "balance_on_account",
               "home_branch_code", "card_prim_no", "age", "home_address", "employer_name")
    assert got == [
        ("D00000015", "Deposit", M(150), "B1", "K1", 24, "5 OAK ST, PAARL", "ACME"),
        ("L00000013", "Loan", M(900), "B2", "K1", 24, "5 OAK ST, PAARL", "ACME"),
        ("L00000021", "Loan", M(0), "B2", "K1", 24, "5 OAK ST, PAARL", "ACME"),
    ]


# ------------------------------------------------------------------ arrears
def _arrears_wh(spark):
    loan = dict(clientkey=1, productkey=2, coveragedatekey=20240102, lastarrearsdatekey=20230901,
                arrearsinstallmentcount=2, loanofficertellerkey=95, clientcollectionskey=3)
    return warehouse(spark, {
        "factclient": [
            dict(clientkey=1, clientsnapshotdatekey=20240102, primarydepositaccountnumber="P0000001",
                 employerkey=5),
            dict(clientkey=1, clientsnapshotdatekey=20240101, primarydepositaccountnumber="P0000001",
                 employerkey=6)],
        "dimclient": [dict(clientkey=1, cifnumber="C0000001", cifwithcheckdigit="C00000019",
                           partyidentifiertypenumber="ID-1", clientcreatedate=T("2015-01-01 00:00:00"),
                           rowiscurrent=1)],
        "dimaccount": [
            dict(accountkey=50, accountnumber="P0000001", accountnumberwithcheckdigit="P00000011",
                 rowiscurrent=1),
            dict(accountkey=60, accountnumber="L0000001", accountnumberwithcheckdigit="L00000013",
                 rowiscurrent=1),
            dict(accountkey=61, accountnumber="L0000002", accountnumberwithcheckdigit="L00000021",
                 rowiscurrent=1),
            dict(accountkey=62, accountnumber="L0000003", accountnumberwithcheckdigit="L00000039",
                 rowiscurrent=1)],
        "dimcard": [
            dict(clientnumber="C00000019", cardactivatedtellernumber=8,
                 cardactivetimestamp=T("2021-01-01 00:00:00"), rowiscurrent=1),
            dict(clientnumber="C00000019", cardactivatedtellernumber=7,
                 cardactivetimestamp=T("2020-01-01 00:00:00"), rowiscurrent=1)],
        "dimteller": [
            dict(tellerkey=70, tellernumber="000007", tellername="T SEVEN", rowiscurrent=1),
            dict(tellerkey=80, tellernumber="000008", tellername="T EIGHT", rowiscurrent=1),
            dict(tellerkey=90, tellernumber="00A1", tellername="BAD", rowiscurrent=1),
            dict(tellerkey=95, tellernumber="000095", tellername="LOANOFF", rowiscurrent=1)],
        "factloanaccountdailycoverage": [
            {**loan, "accountkey": 60, "lastadvancedatekey": 20230404, "loanbalanceamount": M(40),
             "loanarrearsamount": M(5)},
            {**loan, "accountkey": 61, "lastadvancedatekey": 20230604, "loanbalanceamount": M(0),
             "loanarrearsamount": M(3)},
            {**loan, "accountkey": 62, "lastadvancedatekey": 20230605, "loanbalanceamount": M(10),
             "loanarrearsamount": M(1)},
            {**loan, "accountkey": 60, "coveragedatekey": 20240101, "lastadvancedatekey": 20230404,
             "loanbalanceamount": M(41), "loanarrearsamount": M(5)}],
        "factcapout": [dict(accountkey=60, advanceamount=M(1000), transactionbranchkey=1)],
        "dimemployer": [dict(employerkey=5, employername="ACME", employernumberwithcheckdigit="E5",
                             employerindustrytypename="MINING", rowiscurrent=1),
                        dict(employerkey=6, employername="OLDCO", rowiscurrent=1)],
        "dimproduct": [dict(productkey=2, productname="Personal loan", productgroupname="Loan",
                            rowiscurrent=1)],
        "factdepositaccountdailycoverage": [
            dict(accountkey=50, coveragedatekey=20240102, currentbalanceamount=M("12.34"),
                 stopsonaccountcount=1)],
        "dimbranch": [dict(branchkey=1, branchname="North", provincename="WC")],
        "dimclientcollections": [dict(clientcollectionskey=3, clientstatusname="Handed over",
                                      rowiscurrent=1)],
        "creditapplicationoutcome": [
            dict(cifwithcheckdigit="C00000019", clienttype="A-NEW", lrid_date=D("2023-04-04"),
                 logical_record_id="LR1"),
            dict(cifwithcheckdigit="C00000019", clienttype="Z-OTHER", lrid_date=D("2023-04-05"),
                 logical_record_id="LR2")],
        "dbo_smapplication": [dict(logicalrecordid="LR1", loanpurpose="CAR", retailername="SHOP")],
        "dbo_smsmresults": [dict(logicalrecordid="LR1", privatesector="PRIVATE")],
        "dbo_gdcreditpolicystrategy": [dict(logicalrecordid="LR1", score_mi=612)],
    })


def test_arrears(spark):
    out = arrears(_arrears_wh(spark), ["P00000011"], "2023/04/04", "2023/06/04", ["A-NEW", "B-EXISTING"])
    assert len(out.columns) == 28
    got = rows(out, "loan_contract", "create_teller", "loan_teller", "client_arrears_ratio", "dep_bal",
               "account_stopped", "employer_name", "capout", "prism_score", "application_date")
    assert got == [
        ("L00000013", "7 - T SEVEN", "95 - LOANOFF", "13.00 %", M("12.34"), "Yes", "ACME", M(1000), 612,
         D("2023-04-04")),
        ("L00000021", "7 - T SEVEN", "95 - LOANOFF", None, M("12.34"), "Yes", "ACME", None, 612,
         D("2023-06-04")),
    ]


# ------------------------------------------------------------------ tollgate
def _toll_wh(spark):
    msg = dict(card_no_id="K1", pan="4000111122223333", tran_type="00", rsp_code_req="00",
               hold_response_key="000", pos_entry_mode="05", message_type="0100",
               pos_terminal_type="00", merchant_type="5999", settle_amount_req="0",
               card_acceptor_id_code="  M1 ", tran_postilion_originated=0, rowiscurrent=1)

    def m(ts, amt, **kw):
        return {**msg, "datetime_req": T(ts), "datetime_tran_local": T(ts), "tran_amount_req": amt, **kw}
    ind = dict(cardtransactiontypecode="00", cardtransactiontypename="Purchase", cardresponsecode="00",
               cardresponsename="Approved", pointofserviceentrymodecode="05",
               pointofserviceentrymodename="Chip", messagetypecode="0100", messagetypename="Auth",
               rowiscurrent=1)
    return warehouse(spark, {
        "vwpost_tran_leg_internal": [
            m("2024-03-09 12:00:00", "12345"),
            m("2024-03-10 09:00:00", ""),
            m("2024-03-11 08:00:00", "12345"),
            m("2024-03-11 09:00:00", "0", pos_terminal_type="07"),
            m("2024-03-11 10:00:00", None),
            m("2024-03-11 11:00:00", "5", hold_response_key="999"),
            m("2024-03-11 12:00:00", "6", card_no_id="K2"),
        ],
        "dimcardtransactionindicators": [ind, dict(ind)],
        "dimmerchantcategory": [dict(merchantcategorycode="5999", merchantcategoryname="Misc",
                                     rowiscurrent=1)],
        "dimcard": [dict(cardnumber="K1", clientnumber="C00000019",
                         cardstoptimestamp=T("2024-03-10 15:00:00"), rowiscurrent=1),
                    dict(cardnumber="K2", clientnumber="C00000019", cardstoptimestamp=None,
                         rowiscurrent=1)],
        "factcreditcardaccountdailycoverage": [
            dict(clientkey=1, accountkey=77, coveragedatekey=20240101, creditlimitamount=M(1000),
                 currentbalanceamount=M(-200), qualifycreditlimitamount=M(500)),
            dict(clientkey=1, accountkey=77, coveragedatekey=20240102, creditlimitamount=M(1500),
                 currentbalanceamount=M(-300), qualifycreditlimitamount=M(500))],
        "dimclient": [dict(clientkey=1, cifwithcheckdigit="C00000019", rowiscurrent=1)],
        "dimaccount": [dict(accountkey=77, accountnumberwithcheckdigit="CC0000017", rowiscurrent=1)],
    })


def test_tollgate(spark):
    out = tollgate(_toll_wh(spark), ["CC0000017"], merchant_type="5999", exclude_response="999")
    assert len(out.columns) == 32
    got = [tuple(r) for r in out.select("tran_date", "device_type", "tran_amount_req", "settle_amount_req",
                                        "credit_available", "current_cred_lim", "tran_type_desc",
                                        "merchant_id", "card_stop_date", "account").collect()]
    assert got == [
        (T("2024-03-10 09:00:00"), "NAD", M(0), M(0), M(1200), M(1500), "Purchase", "M1", D("2024-03-10"),
         "CC0000017"),
        (T("2024-03-11 08:00:00"), "NAD", M("123.45"), M(0), M(1200), M(1500), "Purchase", "M1",
         D("2024-03-10"), "CC0000017"),
        (T("2024-03-11 09:00:00"), None, M(0), M(0), M(1200), M(1500), "Purchase", "M1", D("2024-03-10"),
         "CC0000017"),
        (T("2024-03-11 10:00:00"), "NAD", None, M(0), M(1200), M(1500), "Purchase", "M1", D("2024-03-10"),
         "CC0000017"),
    ]


# ------------------------------------------------------------------ employer
def _emp_wh(spark):
    acc = dict(accountstatusname="Open", accountopendate=T("2019-01-01 00:00:00"), accountcategorycode="01",
               rowiscurrent=1)
    return warehouse(spark, {
        "factclient": [
            dict(clientkey=1, clientsnapshotdatekey=20240102, residentialaddresskey=10, employerkey=5,
                 primarydepositaccountnumber="S0000001", clientcollectionskey=3),
            dict(clientkey=2, clientsnapshotdatekey=20240102, residentialaddresskey=10, employerkey=6,
                 primarydepositaccountnumber="S0000002", clientcollectionskey=3),
            dict(clientkey=1, clientsnapshotdatekey=20240101, residentialaddresskey=11, employerkey=5,
                 primarydepositaccountnumber="S0000001", clientcollectionskey=3)],
        "dimclient": [
            dict(clientkey=1, cifnumber="C0000001", titlename="MR", initials="A", lastname="ONE",
                 clientcreatedate=T("2015-05-05 10:00:00"), rowiscurrent=1),
            dict(clientkey=2, cifnumber="C0000002", titlename="MS", initials="B", lastname="TWO",
                 rowiscurrent=1)],
        "d_client": [dict(cif="C0000001", teller_key=9), dict(cif="C0000002", teller_key=9)],
        "d_teller": [dict(teller_key=9, teller_no="000042", teller_name="T FORTYTWO"),
                     dict(teller_key=10, teller_no="000043", teller_name="T OTHER")],
        "dimaddress": [dict(addresskey=10, addressline1text="1 RD", rowiscurrent=1),
                       dict(addresskey=11, addressline1text="OLD RD", rowiscurrent=1)],
        "dimemployer": [dict(employerkey=5, employername="ACME", employernumberwithcheckdigit="E5",
                             rowiscurrent=1),
                        dict(employerkey=6, employername="OTHERCO", employernumberwithcheckdigit="E6",
                             rowiscurrent=1)],
        "dimaccount": [
            {**acc, "accountkey": 101, "accountnumber": "S0000001", "accountnumberwithcheckdigit": "S00000011",
             "clientnumber": "C0000001", "accounttypecode": "SAV"},
            {**acc, "accountkey": 102, "accountnumber": "L0000001", "accountnumberwithcheckdigit": "L00000012",
             "clientnumber": "C0000001", "accounttypecode": "LN"},
            {**acc, "accountkey": 103, "accountnumber": "K0000001", "accountnumberwithcheckdigit": "K00000013",
             "clientnumber": "C0000001", "accounttypecode": "CC"},
            {**acc, "accountkey": 201, "accountnumber": "S0000002", "accountnumberwithcheckdigit": "S00000022",
             "clientnumber": "C0000002", "accounttypecode": "SAV"},
            # a loan whose loan row has no advance: the (loan JOIN advance) side is padded whole
            {**acc, "accountkey": 106, "accountnumber": "L0000006", "accountnumberwithcheckdigit": "L00000066",
             "clientnumber": "C0000001", "accounttypecode": "LN"}],
        "dimclientcollections": [dict(clientcollectionskey=3, clientstatusname="None", rowiscurrent=1)],
        "factdepositaccountdailycoverage": [dict(accountkey=101, coveragedatekey=20240102, homebranchkey=2),
                                            dict(accountkey=101, coveragedatekey=20240101, homebranchkey=1)],
        "dimbranch": [dict(branchkey=1, branchname="LOANBR", branchcode="L1", rowiscurrent=1),
                      dict(branchkey=2, branchname="DEPBR", branchcode="D2", rowiscurrent=1),
                      dict(branchkey=3, branchname="CARDBR", branchcode="C3", rowiscurrent=1)],
        "dimproduct": [dict(productcode="SAV|01", productgroupname="Deposit"),
                       dict(productcode="LN|01", productgroupname="Loan"),
                       dict(productcode="CC|01", productgroupname="Credit Card")],
        "factloanaccountdailycoverage": [dict(accountkey=102, clientkey=1, lastadvancedatekey=20230505),
                                         dict(accountkey=101, clientkey=1, lastadvancedatekey=20230101),
                                         dict(accountkey=106, clientkey=1, lastadvancedatekey=20230606)],
        "factcapout": [dict(accountkey=102, advanceamount=M(5000))],
        "factclientdailysummary": [dict(clientkey=1, lastloanbranchkey=1)],
        "factcreditcardaccountdailycoverage": [dict(accountkey=103, creditlimitamount=M(2000),
                                                    accountopendatekey=20220101, openingbranchkey=3)],
    })


def test_employer_by_employer_number(spark):
    out = employer_accounts(_emp_wh(spark), ["E5"], application_company="BANK")
    assert len(out.columns) == 56
    got = rows(out, "savings_account", "loan_contract", "branch_name", "branch_code", "amount_lost",
               "application_date", "create_teller", "home_address_1", "savings_account_open_date")
    assert got == [
        (None, "K00000013", "CARDBR", "C3", M(2000), D("2022-01-01"), "42 - T FORTYTWO", "1 RD",
         T("2019-01-01 00:00:00")),
        (None, "L00000012", "LOANBR", "L1", M(5000), D("2023-05-05"), "42 - T FORTYTWO", "1 RD", None),
        (None, "L00000066", None, None, None, None, "42 - T FORTYTWO", "1 RD", None),
        ("S00000011", None, "DEPBR", "D2", None, None, "42 - T FORTYTWO", "1 RD", T("2019-01-01 00:00:00")),
    ]


def test_employer_by_account_number(spark):
    out = employer_accounts(_emp_wh(spark), ["S00000022"])
    assert rows(out, "savings_account", "lastname", "primary_deposit_account") == [
        ("S00000022", "TWO", "S00000022")]
