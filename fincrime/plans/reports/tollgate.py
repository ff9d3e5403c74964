"""Card authorisations on or after the card's stop date (tollgate)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import (code_lookup, code_map_lookup, code_maps, decode, dedup, latest_per_key, scd2_current,
                                semi_join_keys)
from fincrime.sources.catalog import Warehouse

# Terminal type code -> device type.
TERMINAL_TYPES = {"00": "NAD", "01": "POS"}

# Columns of a message with a code of the indicator table -> that table's code and name columns.
CODES = {
    "tran_type": ("cardtransactiontypecode", "cardtransactiontypename"),
    "rsp_code_req": ("cardresponsecode", "cardresponsename"),
    "pos_entry_mode": ("pointofserviceentrymodecode", "pointofserviceentrymodename"),
    "message_type": ("messagetypecode", "messagetypename"),
}

REQUIRED = {
    "vwpost_tran_leg_internal": ["datetime_req", "datetime_tran_local", "pan", "card_no_id",
                                 "tran_amount_req", "settle_amount_req", "tran_type", "message_type",
                                 "rsp_code_req", "hold_response_key", "pos_entry_mode",
                                 "pos_terminal_type", "pos_card_data_input_ability",
                                 "pos_card_data_input_mode", "pos_cardholder_present",
                                 "card_acceptor_id_code", "card_acceptor_name_loc", "merchant_type",
                                 "terminal_id", "acquiring_inst_id_code", "tran_postilion_originated",
                                 "rowiscurrent"],
    "dimcardtransactionindicators": ["cardtransactiontypecode", "cardtransactiontypename",
                                     "cardresponsecode", "cardresponsename",
                                     "pointofserviceentrymodecode", "pointofserviceentrymodename",
                                     "messagetypecode", "messagetypename", "rowiscurrent"],
    "dimmerchantcategory": ["merchantcategorycode", "merchantcategoryname", "rowiscurrent"],
    "dimcard": ["cardnumber", "clientnumber", "cardstoptimestamp", "rowiscurrent"],
    "factcreditcardaccountdailycoverage": ["clientkey", "accountkey", "creditlimitamount",
                                           "currentbalanceamount", "arrearsamount", "coveragedatekey",
                                           "qualifycreditlimitamount", "delinquentlevelnumber",
                                           "daysinarrearsnumber"],
    "dimclient": ["clientkey", "cifwithcheckdigit", "rowiscurrent"],
    "dimaccount": ["accountkey", "accountnumberwithcheckdigit", "rowiscurrent"],
}


def tollgate(wh: Warehouse, accounts: Sequence[str] | DataFrame, merchant_type: str,
             exclude_response: str, terminal_types: Mapping[str, str] | None = None) -> DataFrame:
    """Switch messages of cards linked (via the card holder's credit-card
    account) to the searched accounts, at ``merchant_type``, not
    switch-originated, hold response not ``exclude_response``, on or after
    the card's stop date.  Amounts in major units.  Sorted by request time.

    Lookups whose columns are not in the output (extended type, reason,
    condition, currency, calendars) are left out: they are left joins under
    DISTINCT, so they cannot change the result."""
    wh.validate(REQUIRED)
    p = wh["vwpost_tran_leg_internal"].filter(
        (F.col("tran_postilion_originated") == 0) & (F.col("hold_response_key") != exclude_response)
        & (F.col("merchant_type") == merchant_type) & (F.col("rowiscurrent") == 1))
    maps = code_maps(wh["dimcardtransactionindicators"], CODES, current_only=True)
    for column, (code, name) in CODES.items():
        p = code_map_lookup(p, maps, column, column, code, name)
    p = code_lookup(p, wh["dimmerchantcategory"], "merchant_type", "merchantcategorycode",
                    ["merchantcategoryname"], current_only=True)
    p = decode(p, "pos_terminal_type", terminal_types or TERMINAL_TYPES, "device_type")

    # accounts searched -> their keys; the newest-row window then only runs
    # over those accounts' history (the filter is on its partition key)
    acc = semi_join_keys(scd2_current(wh["dimaccount"]), "accountnumberwithcheckdigit", accounts) \
        .select(F.col("accountkey").alias("__ak"), F.col("accountnumberwithcheckdigit").alias("account"))
    cc = wh["factcreditcardaccountdailycoverage"].join(acc, F.col("accountkey") == F.col("__ak"),
                                                       "left_semi")
    dcl = scd2_current(wh["dimclient"]).select(F.col("clientkey").alias("__clk"), "cifwithcheckdigit")
    sub = cc.join(dcl, F.col("clientkey") == F.col("__clk")).select(
        "accountkey", "creditlimitamount", "currentbalanceamount", "arrearsamount", "coveragedatekey",
        "qualifycreditlimitamount", "delinquentlevelnumber", "daysinarrearsnumber",
        "cifwithcheckdigit")
    sub = latest_per_key(sub, ["accountkey"], ["coveragedatekey"],
                         ties=[F.col(c).asc_nulls_last() for c in sub.columns
                               if c not in ("accountkey", "coveragedatekey")])
    sub = sub.join(acc, F.col("__ak") == F.col("accountkey"))
    card = scd2_current(wh["dimcard"]).select(F.col("cardnumber").alias("__cardno"),
                                              F.col("clientnumber").alias("__card_client"),
                                              "cardstoptimestamp")
    j = (p.join(card, F.col("__cardno") == F.col("card_no_id"))
          .filter(F.to_date("datetime_tran_local") >= F.to_date("cardstoptimestamp"))
          .join(sub, F.col("cifwithcheckdigit") == F.col("__card_client")))
    out = j.select(
        F.col("datetime_req").alias("tran_date"),
        F.to_date("datetime_req").alias("date"),
        "device_type",
        F.col("pan").cast("string").alias("card_no"),
        F.to_date("cardstoptimestamp").alias("card_stop_date"),
        "account",
        "hold_response_key",
        F.col("qualifycreditlimitamount").alias("initial_cred_lim"),
        F.col("creditlimitamount").alias("current_cred_lim"),
        F.col("currentbalanceamount").alias("credit_used"),
        F.col("arrearsamount").alias("arrears_amount"),
        F.col("delinquentlevelnumber").alias("delinquent_level"),
        F.col("daysinarrearsnumber").alias("aging_days_key"),
        fn.credit_available("currentbalanceamount", "creditlimitamount").alias("credit_available"),
        fn.minor_units("tran_amount_req").alias("tran_amount_req"),
        fn.minor_units("settle_amount_req").alias("settle_amount_req"),
        F.col("cardtransactiontypecode").alias("tran_type"),
        F.col("cardtransactiontypename").alias("tran_type_desc"),
        F.col("cardresponsecode").alias("response_code"),
        F.col("cardresponsename").alias("response_code_desc"),
        F.trim("card_acceptor_id_code").alias("merchant_id"),
        F.col("card_acceptor_name_loc").alias("merchant_name"),
        "merchant_type",
        F.col("merchantcategoryname").alias("merchant_type_desc"),
        "terminal_id",
        F.col("pointofserviceentrymodecode").alias("pos_entry_mode"),
        F.col("messagetypecode").alias("message_type"),
        F.col("messagetypename").alias("message_type_desc"),
        "acquiring_inst_id_code", "pos_card_data_input_ability", "pos_card_data_input_mode",
        "pos_cardholder_present")
    return dedup(out).orderBy(F.col("tran_date").asc_nulls_last())
