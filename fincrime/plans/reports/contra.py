"""Payments from stopped accounts to staff: contra-entry matching.

Steps: recent ledger (classification, time and date attached) -> accounts
flagged by stop indicators -> credit/debit pairs on (date, time, journal,
amount) between different accounts and clients -> main client (newest
snapshot, employer) and debit side lookups by key -> pairs of the newest time
per main client -> their names -> newest pair per main client -> employer name
and client filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import (contra_entry_match, dedup, flagged_accounts, latest_snapshot,
                                newest_rows, number_rows, recent_ledger, semi_join_keys)
from fincrime.plans.reports.common import current, to_date_value
from fincrime.sources.catalog import Warehouse

REQUIRED = {
    "facttransaction": ["accountkey", "clientkey", "transactionamount", "transactiondatekey",
                        "transactionindicatorskey", "transactionclassificationkey",
                        "postedtransactiondatekey", "postedtransactiontimekey", "journalnumber"],
    "vwdimtransactionclassification": ["transactionclassificationkey", "transactioncode",
                                       "transactionclassificationname", "rowiscurrent"],
    "dimtime": ["timekey", "fulltime"],
    "dimdate": ["datekey", "fulldate"],
    "factclient": ["clientkey", "employerkey", "clientsnapshotdatekey"],
    "dimclient": ["clientkey", "cifwithcheckdigit", "firstname", "middlefirstname",
                  "middlesecondname", "middlethirdname", "lastname", "rowiscurrent"],
    "dimemployer": ["employerkey", "employername", "rowiscurrent"],
    "dimaccount": ["accountkey", "accountnumberwithcheckdigit", "rowiscurrent"],
}

OUTPUT = ["cif_check_digit", "main_first_name", "main_last_name", "main_employer_name",
          "staff_account", "main_tran_code", "main_tran_desc", "main_amount", "stopped_account",
          "balance_first_name", "balance_last_name", "balance_employer_name", "tran_date",
          "tran_time", "balance_tran_code", "balance_tran_desc", "balance_amount", "journalnumber"]


def recent_transactions(wh: Warehouse, as_of=None, days: int = 30, faithful: bool = False,
                        current_only: bool = True) -> DataFrame:
    """Ledger rows posted from the first day of the month holding
    ``as_of - days``, with transaction code, time key and calendar date.

    The date test is on the raw integer key, so it is pushed into the scan; on
    a ledger partitioned by posted month both roles that read it prune the
    partitions (the flagged accounts come from all history).

    Days and times of day are calendars, bounded whatever the ledger's size:
    they are broadcast, so the ledger is not dealt out by a few values."""
    ft = recent_ledger(wh["facttransaction"], to_date_value(as_of), days, "postedtransactiondatekey", faithful)
    cls = current(wh["vwdimtransactionclassification"], current_only).select(
        F.col("transactionclassificationkey").alias("__tck"), "transactioncode")
    ti = F.broadcast(wh["dimtime"].select(F.col("timekey")))
    di = F.broadcast(wh["dimdate"].select(F.col("datekey").alias("__dk")).distinct())
    j = (ft.join(cls, F.col("__tck") == F.col("transactionclassificationkey"))
           .join(ti, F.col("postedtransactiontimekey") == F.col("timekey"))
           .join(di, F.col("postedtransactiondatekey") == F.col("__dk"), "left_semi"))
    return j.select("accountkey", "clientkey", "transactionamount", "transactiondatekey",
                    "timekey", "journalnumber", "transactioncode")


def staff_from_stopped(wh: Warehouse, employer_like: str, as_of=None,
                       codes: Sequence[int] = (50, 73), clients: Sequence[str] | DataFrame | None = None,
                       days: int = 30, faithful: bool = False,
                       current_only: bool = True) -> DataFrame:
    """Newest contra pair per main (credit) client whose debit side is a
    flagged (stopped) account.  ``employer_like`` is a case-sensitive
    substring of the employer name; ``clients`` optionally restricts the
    main clients (CIF with check digit)."""
    wh.validate(REQUIRED)
    ledger = recent_transactions(wh, as_of, days, faithful, current_only)
    cls_all = wh["vwdimtransactionclassification"]
    flagged = flagged_accounts(
        wh["facttransaction"].join(cls_all.select("transactionclassificationkey"),
                                   "transactionclassificationkey", "left_semi"),
        codes)
    # main client: newest snapshot -> client -> employer
    fc = latest_snapshot(wh["factclient"], "clientsnapshotdatekey").select("clientkey", "employerkey")
    dcl = current(wh["dimclient"], current_only)
    main_client = dcl.select(
        "clientkey", F.col("cifwithcheckdigit").alias("cif_check_digit"),
        fn.full_name_raw("firstname", "middlefirstname", "middlesecondname", "middlethirdname")
          .alias("main_first_name"),
        F.col("lastname").alias("main_last_name"))
    if clients is not None:
        # the partition key of the newest-pair window: safe to filter first
        main_client = semi_join_keys(main_client, "cif_check_digit", clients)
    emp = current(wh["dimemployer"], current_only)
    main_emp = emp.select(F.col("employerkey").alias("__e"), F.col("employername").alias("main_employer_name"))
    dc = (fc.join(main_client.select("clientkey", "cif_check_digit"), "clientkey")
            .join(main_emp, F.col("employerkey") == F.col("__e"), "left_semi"))
    acc = wh["dimaccount"]
    staff = current(acc, True).select(F.col("accountkey").alias("__sa"),
                                      F.col("accountnumberwithcheckdigit").alias("staff_account"))
    stopped = current(acc, current_only).select(
        F.col("accountkey").alias("__da"), F.col("accountnumberwithcheckdigit").alias("stopped_account"))
    cls = current(cls_all, current_only)
    main_code = cls.select(F.col("transactioncode").alias("main_tran_code"),
                           F.col("transactionclassificationname").alias("main_tran_desc"))
    bal_code = cls_all.filter(F.col("rowiscurrent") == 1).select(
        F.col("transactioncode").alias("balance_tran_code"),
        F.col("transactionclassificationname").alias("balance_tran_desc"))
    dd = wh["dimdate"].select(F.col("datekey").alias("__ddk"), F.col("fulldate").alias("tran_date"))
    dt = wh["dimtime"].select(F.col("timekey").alias("__tk"),
                              fn.hour_label("fulltime").alias("tran_time"),
                              F.hour("fulltime").alias("__h"), F.minute("fulltime").alias("__m"))
    bal_client = dcl.select(
        F.col("clientkey").alias("__bc"),
        fn.full_name_raw("firstname", "middlefirstname", "middlesecondname", "middlethirdname")
          .alias("balance_first_name"),
        F.col("lastname").alias("balance_last_name"))
    # the "balance" employer is looked up by the MAIN client's employer key
    bal_emp = emp.select(F.col("employerkey").alias("__be"),
                         F.col("employername").alias("balance_employer_name"))
    # only the newest time of a main client can hold its newest pair: the pairs that pass every lookup
    # are narrowed to it by their keys alone, and names are attached to what is left.  Rows are
    # distinct in the end, so a lookup that only has to exist is a semi-join here.
    pairs = contra_entry_match(ledger, flagged.join(stopped, F.col("__da") == F.col("accountkey"), "left_semi"),
                               keys=("transactiondatekey", "timekey", "journalnumber"),
                               carry=("transactioncode",))
    newest = newest_rows(
        pairs.join(main_code, F.col("main_tran_code") == F.col("credit_transactioncode"), "left_semi")
             .join(bal_code, F.col("balance_tran_code") == F.col("debit_transactioncode"), "left_semi")
             .join(F.broadcast(dd.distinct()), F.col("__ddk") == F.col("transactiondatekey"))
             .join(F.broadcast(dt.distinct()), F.col("__tk") == F.col("timekey"))
             .join(staff, F.col("__sa") == F.col("credit_account"), "left_semi")
             .join(bal_client, F.col("__bc") == F.col("debit_client"), "left_semi")
             .join(dc, F.col("clientkey") == F.col("credit_client")),
        ["cif_check_digit"], "tran_date", "__h", "__m").drop("clientkey")
    named = main_client.withColumnRenamed("cif_check_digit", "__cif")
    j = (newest.join(named, (F.col("clientkey") == F.col("credit_client"))
                     & F.col("__cif").eqNullSafe(F.col("cif_check_digit")))
               .join(main_emp, F.col("employerkey") == F.col("__e"))
               .join(staff, F.col("__sa") == F.col("credit_account"))
               .join(main_code, F.col("main_tran_code") == F.col("credit_transactioncode"))
               .join(stopped, F.col("__da") == F.col("debit_account"))
               .join(bal_code, F.col("balance_tran_code") == F.col("debit_transactioncode"))
               .join(bal_client, F.col("__bc") == F.col("debit_client"))
               .join(bal_emp, F.col("__be") == F.col("employerkey")))
    rows = j.select(*[F.col(c) for c in OUTPUT if c not in ("main_amount", "balance_amount")],
                    F.col("credit_amount").alias("main_amount"),
                    F.col("debit_amount").alias("balance_amount"), "__h", "__m")
    # de-duplicate first, then number; order by the real time, not the label
    rows = dedup(rows)
    ties = [F.col(c).asc_nulls_last() for c in OUTPUT if c not in ("cif_check_digit", "tran_date")]
    numbered = number_rows(rows, ["cif_check_digit"], ["tran_date", "__h", "__m"], ties=ties,
                           name="__rn", balanced=False)  # only rn = 1 is kept
    out = numbered.filter((F.col("__rn") == 1) &
                          F.col("balance_employer_name").contains(employer_like))
    return out.select(*OUTPUT)
