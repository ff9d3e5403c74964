"""Golden cases for the short reports (invented values)."""

from wh import D, M, T, rows, warehouse

from fincrime.plans.reports import (card_search, case_lookup, client_lookup, latest_incidents,
                                    missed_fraud)


def test_case_lookup_strictly_after(spark):
    w = warehouse(spark, {"case_folder": [
        dict(case_id="C1", case_creation_date=T("2023-02-15 06:00:00"), case_id_passport_no="ID1"),
        dict(case_id="C2", case_creation_date=T("2023-02-15 06:00:01"), case_id_passport_no="ID1"),
        dict(case_id="C3", case_creation_date=T("2023-03-01 00:00:00"), case_id_passport_no="ID2"),
    ]})
    out = case_lookup(w, ["ID1"], "2023-02-15 06:00:00")
    assert out.columns == ["case_id", "case_creation_date", "case_client_surname",
                           "case_id_passport_no", "case_client_first_name", "serving_consultant_cp_no"]
    assert rows(out, "case_id") == [("C2",)]
    # a set of keys at once
    assert rows(case_lookup(w, ["ID1", "ID2"], "2023-02-15 06:00:00"), "case_id") == [("C2",), ("C3",)]


def test_latest_incidents(spark):
    w = warehouse(spark, {
        "factclient": [
            dict(clientkey=1, clientsnapshotdatekey=20240101, primarydepositaccountnumber="1111"),
            dict(clientkey=1, clientsnapshotdatekey=20240102, primarydepositaccountnumber="2222"),
            dict(clientkey=100, clientsnapshotdatekey=20240102, primarydepositaccountnumber="9999"),
            dict(clientkey=2, clientsnapshotdatekey=20240101, primarydepositaccountnumber="3333"),
        ],
        "dimclient": [
            dict(clientkey=1, cifwithcheckdigit="100000017", firstname="ANN", lastname="LEE",
                 partyidentifiertypenumber="ID-A", rowiscurrent=1),
            dict(clientkey=100, cifwithcheckdigit="100000017", firstname="OLD", lastname="LEE",
                 rowiscurrent=0),
            dict(clientkey=2, cifwithcheckdigit="200000025", firstname="BOB", rowiscurrent=1),
        ],
        "dbo_incident": [
            dict(incidentnumber="INC1", clientcif="100000017", createddatetime=T("2024-01-01 10:00:00"),
                 subject="old"),
            dict(incidentnumber="INC1", clientcif="100000017", createddatetime=T("2024-01-02 09:00:00"),
                 subject="new"),
            dict(incidentnumber="INC2", clientcif="200000025", createddatetime=T("2024-01-02 09:00:00"),
                 subject="other"),
        ],
    })
    out = latest_incidents(w)
    assert len(out.columns) == 15
    assert rows(out, "incident_number", "cif_check_digit", "first_name", "primary_deposit_account",
                "incident_create_date", "subject") == [
        ("INC1", "100000017", "ANN", "2222", D("2024-01-02"), "new")]


def _client_lookup_wh(spark):
    return warehouse(spark, {
        "factclient": [
            dict(cifnumber="C1", clientsnapshotdatekey=20240102, primarydepositaccountnumber="11111111",
                 residentialaddresskey=10, employerkey=5),
            dict(cifnumber="C2", clientsnapshotdatekey=20240102, primarydepositaccountnumber="22222222",
                 residentialaddresskey=20, employerkey=5),
            dict(cifnumber="C3", clientsnapshotdatekey=20240102, primarydepositaccountnumber="33333333",
                 residentialaddresskey=30, employerkey=5),
            dict(cifnumber="C1", clientsnapshotdatekey=20240101, primarydepositaccountnumber="11111111",
                 residentialaddresskey=30, employerkey=5),
        ],
        "dimclient": [
            dict(cifnumber="C1", cifwithcheckdigit="C17", titlename="MR", firstname="ALICE",
                 middlefirstname="B", middlesecondname="  ", middlethirdname="", lastname="SMITH",
                 partyidentifiertypenumber="ID-A", clientcreatedate=T("2015-03-04 10:00:00"),
                 rowiscurrent=1),
            dict(cifnumber="C2", cifwithcheckdigit="C25", titlename="MR", firstname="BOB",
                 middlefirstname="", middlesecondname="C", middlethirdname=None, lastname="JONES",
                 rowiscurrent=1),
            dict(cifnumber="C3", cifwithcheckdigit="C39", titlename="MS", firstname=" CAROL ",
                 middlefirstname="D", middlesecondname="E", middlethirdname="F", lastname="",
                 rowiscurrent=1),
        ],
        "dimaccount": [
            dict(accountkey=101, accountnumber="11111111", accountnumberwithcheckdigit="111111118",
                 accountopendate=T("2019-05-06 08:00:00"), rowiscurrent=1),
            dict(accountkey=102, accountnumber="22222222", accountnumberwithcheckdigit="222222226",
                 rowiscurrent=1),
            dict(accountkey=103, accountnumber="33333333", accountnumberwithcheckdigit="333333334",
                 rowiscurrent=1),
        ],
        "factdepositaccountdailycoverage": [
            dict(accountkey=101, snapshotdate=D("2024-01-02"), currentbalanceamount=M("100.50"),
                 stopsonaccountcount=0, lastcusttrandatekey=20240101),
            dict(accountkey=101, snapshotdate=D("2024-01-01"), currentbalanceamount=M("99"),
                 stopsonaccountcount=5, lastcusttrandatekey=0),
            dict(accountkey=102, snapshotdate=D("2024-01-02"), currentbalanceamount=M("1"),
                 stopsonaccountcount=2, lastcusttrandatekey=-1),
            dict(accountkey=103, snapshotdate=D("2024-01-02"), currentbalanceamount=M("2"),
                 stopsonaccountcount=None, lastcusttrandatekey=20231231),
        ],
        "dimaddress": [
            dict(addresskey=10, addressline1text="1 MAIN RD", addressline2text="", addressline3text="",
                 addresscityname="CAPE", rowiscurrent=1),
            dict(addresskey=20, addressline1text="A", addressline2text="B", addressline3text="C",
                 addresscityname="", rowiscurrent=1),
            dict(addresskey=30, addressline1text="X", addressline2text=" ", addressline3text="Y",
                 addresscityname="Z", rowiscurrent=1),
        ],
        "dimemployer": [dict(employerkey=5, employername="ACME", rowiscurrent=1)],
    })


def test_client_lookup_names_flags_addresses(spark):
    w = _client_lookup_wh(spark)
    out = client_lookup(w, ["11111111", "22222222", "33333333"])
    assert len(out.columns) == 13
    got = rows(out, "cif_number", "title_firstnames_lastname", "account_stopped", "home_address",
               "account_balance", "last_cust_tran_date", "primary_deposit_account", "account_open_date")
    assert got == [
        ("C17", "MR ALICE B SMITH", "No", "1 MAIN RD, CAPE", M("100.50"), D("2024-01-01"),
         "111111118", D("2019-05-06")),
        ("C25", None, "Yes", "A, B, C, ", M("1"), None, "222222226", None),
        ("C39", "MS CAROL D E F", "No", "X, Y, Z", M("2"), D("2023-12-31"), "333333334", None),
    ]
    # clean=True trims the leftover separator
    clean = client_lookup(w, ["22222222"], clean_address=True)
    assert rows(clean, "home_address") == [("A, B, C",)]


def test_card_search(spark):
    w = warehouse(spark, {
        "dimcard": [
            dict(cardnumber="5550001", clientnumber="100000017", embossedname="A SMITH",
                 cardholdertypecode="P", cardexpirydate=T("2027-01-31 00:00:00"),
                 cardcreationdate=T("2023-01-01 09:30:00"), cardstatusname="ACTIVE", rowiscurrent=1),
            dict(cardnumber="5550001", clientnumber="100000017", cardstatusname="OLD", rowiscurrent=0),
            dict(cardnumber="5550002", clientnumber="100000017", cardstatusname="ACTIVE", rowiscurrent=1),
        ],
        "dimaccount": [
            dict(accountnumber="90000001", accountnumberwithcheckdigit="900000012", clientnumber="10000001",
                 rowiscurrent=1),
            dict(accountnumber="90000002", accountnumberwithcheckdigit="900000020", clientnumber="10000001",
                 rowiscurrent=1),
        ],
        "dimclient": [dict(cifwithcheckdigit="100000017", firstname="ALICE", middlefirstname="B",
                           middlesecondname="", middlethirdname="", lastname="SMITH", rowiscurrent=1)],
        "factdepositaccountdailycoverage": [
            dict(accountnumber="90000001", snapshotdate=D("2024-01-02"), currentbalanceamount=M(10)),
            dict(accountnumber="90000001", snapshotdate=D("2024-01-01"), currentbalanceamount=M(5)),
            dict(accountnumber="90000002", snapshotdate=D("2024-01-02"), currentbalanceamount=M(20)),
        ],
    })
    out = card_search(w, ["5550001"])
    assert len(out.columns) == 13
    assert rows(out, "account_number_check_digit", "dep_bal", "first_name", "card_status",
                "expiry_dates", "create_date") == [
        ("900000012", M(10), "ALICE B", "ACTIVE", D("2027-01-31"), D("2023-01-01")),
        ("900000020", M(20), "ALICE B", "ACTIVE", D("2027-01-31"), D("2023-01-01")),
    ]


def test_missed_fraud(spark):
    base = dict(parentlink_recid="T1", amount=M(-50), createddatetime=T("2023-09-30 10:00:00"),
                cardnumber="4111112222", incidentnumber="I-1", trancode="TC", trantype="POS",
                additionaldescription="Purchase", disputed="YES", rowiscurrent=1)
    utd = [base,
           {**base, "additionaldescription": "Monthly FEE", "incidentnumber": "I-2"},
           {**base, "trantype": "fee reversal", "incidentnumber": "I-3"},
           {**base, "amount": M(20), "incidentnumber": "I-4"},
           {**base, "incidentnumber": None},
           {**base, "incidentnumber": "I-5", "rowiscurrent": 0},
           {**base, "incidentnumber": "I-6", "createddatetime": T("2023-10-01 00:00:00")},
           {**base, "incidentnumber": "I-7", "disputed": "no"}]
    w = warehouse(spark, {
        "dbo_utdaccounttransactions": utd,
        "dbo_unathorisedtransactiondisputes": [
            dict(recid="T1", incidentlink_recid="R1", incidentnumber="TD-1", fraudtype="Card not present",
                 resolution="Refund", rowiscurrent=1),
            dict(recid="T1", incidentlink_recid="R1", incidentnumber="TD-0", rowiscurrent=0)],
        "dbo_incident": [
            dict(recid="R1", incidentnumber="CSI-1", createddatetime=T("2023-09-29 08:00:00"),
                 status="Closed", clientcif="100000017", rowiscurrent=1),
            dict(recid="R1", incidentnumber="CSI-0", status="Closed", clientcif="100000017",
                 rowiscurrent=0)],
        "dimclient": [dict(clientkey=1, cifwithcheckdigit="100000017", rowiscurrent=1),
                      dict(clientkey=100, cifwithcheckdigit="100000017", rowiscurrent=0)],
    })
    out = missed_fraud(w, "2023-09-30")
    assert len(out.columns) == 19
    assert rows(out, "clientkey", "csi_incident_number", "incidentnumber_utd", "incidentnumber_td",
                "bin", "fruad_code", "incident_date", "amount") == [
        (1, "CSI-1", "I-1", "TD-1", "411111", "C", D("2023-09-29"), M(-50))]
