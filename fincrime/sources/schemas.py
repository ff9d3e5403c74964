"""Explicit schemas of the warehouse relations the reports read.

Types are inferred from how the reports use each column: codes and
zero-padded numbers are strings, surrogate keys are longs, ``yyyymmdd`` date
keys are ints, money is decimal(23,2), timestamps carry no zone (NTZ).
Only the columns the reports touch are listed; extra columns are allowed.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "k": T.LongType(),
    "i": T.IntegerType(),
    "dk": T.IntegerType(),
    "d": T.DateType(),
    "t": T.TimestampNTZType(),
    "m": T.DecimalType(23, 2),
}

# relation -> "column:type ..." (type codes above).  rowiscurrent is "i".
_RELATIONS = {
    "dimaccount": "accountkey:k accountnumber:s accountnumberwithcheckdigit:s accountstatusname:s "
                  "accountopendate:t accounttypecode:s accountcategorycode:s clientnumber:s rowiscurrent:i",
    "dimclient": "clientkey:k cifnumber:s cifwithcheckdigit:s titlename:s initials:s firstname:s "
                 "middlefirstname:s middlesecondname:s middlethirdname:s lastname:s birthdate:d "
                 "clientcreatedate:t partyidentifiertypenumber:s partyidentifiertypename:s "
                 "homephonenumber:s workphonenumber:s mobilephonenumber:s rowiscurrent:i",
    "dimcard": "cardkey:k cardnumber:s primarycardnumber:s cardholdertypecode:s cardholdertypename:s "
               "cardstatusname:s embossedname:s partyidentifiernumber:s cardcreationdate:t "
               "cardexpirydate:t cardreplacetimestamp:t cardstoptimestamp:t cardactivetimestamp:t "
               "cardactivatedtellernumber:i clientnumber:s rowiscurrent:i",
    "dimproduct": "productkey:k productcode:s productname:s productgroupname:s rowiscurrent:i",
    "dimbranch": "branchkey:k branchcode:s branchname:s provincename:s rowiscurrent:i",
    "dimaddress": "addresskey:k addressline1text:s addressline2text:s addressline3text:s "
                  "addresscityname:s addresspostcode:s rowiscurrent:i",
    "dimemployer": "employerkey:k employername:s employernumberwithcheckdigit:s "
                   "employerindustrytypename:s rowiscurrent:i",
    "dimteller": "tellerkey:k tellernumber:s tellername:s rowiscurrent:i",
    "dimclientcollections": "clientcollectionskey:k clientstatusname:s rowiscurrent:i",
    "dimdate": "datekey:dk fulldate:d",
    "dimtime": "timekey:k fulltime:t",
    "dimcardtransactionindicators": "cardtransactiontypecode:s cardtransactiontypename:s "
                                    "extendedtransactiontypecode:s extendedtransactiontypename:s "
                                    "messagereasoncode:s messagereasonname:s cardresponsecode:s "
                                    "cardresponsename:s pointofserviceentrymodecode:s "
                                    "pointofserviceentrymodename:s pointofserviceconditioncode:s "
                                    "pointofserviceconditionname:s messagetypecode:s messagetypename:s "
                                    "rowiscurrent:i",
    "vwdimcurrency": "currencyalphacode:s currencynumericcode:s rowiscurrent:i",
    "dimmerchantcategory": "merchantcategorycode:s merchantcategoryname:s rowiscurrent:i",
    "vwdimtransactionclassification": "transactionclassificationkey:k transactioncode:s "
                                      "transactionclassificationname:s rowiscurrent:i",
    "factclient": "clientkey:k cifnumber:s clientsnapshotdatekey:dk clientsnapshottimestamp:t "
                  "primarydepositaccountnumber:s residentialaddresskey:k postaladdresskey:k "
                  "employerkey:k clientcollectionskey:k",
    "factdepositaccountdailycoverage": "accountkey:k accountnumber:s currentbalanceamount:m productkey:k "
                                       "homebranchkey:k coveragedatekey:dk snapshotdate:d isfinalload:i "
                                       "lastcusttrandatekey:dk stopsonaccountcount:i",
    "factloanaccountdailycoverage": "accountkey:k accountnumber:s clientkey:k productkey:k "
                                    "originatingbranchkey:k coveragedatekey:dk lastadvancedatekey:dk "
                                    "lastarrearsdatekey:dk arrearsinstallmentcount:i loanbalanceamount:m "
                                    "loanarrearsamount:m loanofficertellerkey:k clientcollectionskey:k",
    "factcreditcardaccountdailycoverage": "clientkey:k accountkey:k accountnumber:s creditlimitamount:m "
                                          "currentbalanceamount:m arrearsamount:m qualifycreditlimitamount:m "
                                          "delinquencytext:s delinquentlevelnumber:i daysinarrearsnumber:i "
                                          "stopsonaccountcount:i coveragedatekey:dk coveragedate:d "
                                          "accountopendatekey:dk openingbranchkey:k",
    "factcapout": "accountkey:k advanceamount:m transactionbranchkey:k",
    "factclientdailysummary": "clientkey:k lastloanbranchkey:k",
    "facttransaction": "accountkey:k clientkey:k transactionamount:m transactiondatekey:dk "
                       "transactionindicatorskey:k transactionclassificationkey:k "
                       "postedtransactiondatekey:dk postedtransactiontimekey:k journalnumber:s",
    "creditapplicationoutcome": "cifwithcheckdigit:s clienttype:s lrid_date:d logical_record_id:s",
    "dbo_smapplication": "logicalrecordid:s loanpurpose:s retailername:s",
    "dbo_smsmresults": "logicalrecordid:s privatesector:s",
    "dbo_gdcreditpolicystrategy": "logicalrecordid:s score_mi:i",
    "d_client": "cif:s teller_key:k",
    "d_teller": "teller_key:k teller_no:s teller_name:s",
    "dbo_incident": "recid:s incidentnumber:s createddatetime:t status:s clientcif:s "
                    "noncbclientidnumber:s profilefullname:s actualcategory:s actualsubcategory:s "
                    "actualissue:s subject:s symptom:s resolution:s rowiscurrent:i",
    "dbo_unathorisedtransactiondisputes": "recid:s incidentlink_recid:s incidentnumber:s fraudtype:s "
                                          "resolution:s createddatetime:t lastmoddatetime:t rowiscurrent:i",
    "dbo_utdaccounttransactions": "parentlink_recid:s amount:m journalnumber:s incxid:s createddatetime:t "
                                  "cardnumber:s incidentnumber:s trancode:s trantype:s "
                                  "additionaldescription:s fraud:s disputed:s rowiscurrent:i",
    "case_folder": "case_id:s case_creation_date:t case_client_surname:s case_id_passport_no:s "
                   "case_client_first_name:s serving_consultant_cp_no:s",
    "vwpost_tran_leg_internal": "datetime_req:t datetime_tran_local:t pan:s card_no_id:s tran_amount_req:s "
                                "settle_amount_req:s tran_type:s extended_tran_type:s message_type:s "
                                "message_reason_code:s rsp_code_req:s hold_response_key:s pos_entry_mode:s "
                                "pos_condition_code:s pos_terminal_type:s pos_card_data_input_ability:s "
                                "pos_card_data_input_mode:s pos_cardholder_present:s card_acceptor_id_code:s "
                                "card_acceptor_name_loc:s merchant_type:s terminal_id:s "
                                "acquiring_inst_id_code:s tran_currency_code:s tran_postilion_originated:i "
                                "rowiscurrent:i",
}

# Views that read like tables share the schema of their base relation.
_ALIASES = {"vwfacttransaction": "facttransaction"}


def relation_names() -> list[str]:
    return sorted(list(_RELATIONS) + list(_ALIASES))


def schema_of(name: str) -> T.StructType:
    """StructType of a warehouse relation (case-insensitive, schema prefix ignored)."""
    base = name.lower().split(".")[-1]
    base = _ALIASES.get(base, base)
    spec = _RELATIONS[base]
    fields = []
    for item in spec.split():
        col, code = item.split(":")
        fields.append(T.StructField(col, _TYPES[code], True))
    return T.StructType(fields)
