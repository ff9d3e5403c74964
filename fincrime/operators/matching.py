"""Contra-entry matching in a transaction ledger.

A credit (amount > 0) is paired with an equal and opposite debit posted on
the same date, time and journal, on another account of another client, where
the debit's account is flagged (e.g. by a stop indicator).

Plan: the ledger is read once per role with the role's filter pushed into the
scan (credit: amount > 0; debit: semi-joined with the flagged accounts).  The
pair join is an equi-join on (date, time, journal, amount) -- the debit side
carries ``-amount`` as its key -- with the two ``<>`` tests as a residual.
Both sides are hash-partitioned on all four keys, so one journal or one
amount alone cannot skew it; a hot full key is split by AQE's skew-join
handling (the skewed side's partition is cut into map-output ranges, each
joined with the matching partition of the other side).  No pair is dropped.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime.functions.semantics import date_from_key, month_floor_filter


def flagged_accounts(ledger: DataFrame, codes: Sequence, account: str = "accountkey",
                     indicator: str = "transactionindicatorskey") -> DataFrame:
    """Distinct accounts with at least one entry whose indicator is in
    ``codes``.  Only the account is kept, so an account with two codes is
    listed once."""
    return ledger.filter(F.col(indicator).isin(list(codes))).select(account).distinct()


def recent_ledger(ledger: DataFrame, as_of: _dt.date, days: int = 30, date_col: str = "transactiondate",
                  faithful: bool = False, month_col: str = "postedmonth") -> DataFrame:
    """Entries from the first day of the month holding ``as_of - days``.

    An integer ``date_col`` is a ``yyyymmdd`` key and is compared as it is, so
    the test reaches the scan.  Where the ledger has the key's month
    (``yyyymm``) as ``month_col``, usually as its partition column, the same
    bound on the month prunes partitions before a file is opened.
    ``faithful=True`` keeps the source's test of year and month one by one."""
    start = as_of - _dt.timedelta(days=days)
    kind = dict(ledger.dtypes)[date_col]
    if kind not in ("int", "bigint"):
        return ledger.filter(month_floor_filter(date_col, as_of, days, faithful))
    by_month = month_col in ledger.columns
    if faithful:
        d = date_from_key(date_col)
        out = ledger.filter((F.year(d) >= start.year) & (F.month(d) >= start.month))
        return out.filter((F.col(month_col) >= start.year * 100 + start.month)
                          & (F.col(month_col) % 100 >= start.month)) if by_month else out
    out = ledger.filter(F.col(date_col) >= start.year * 10000 + start.month * 100 + 1)
    return out.filter(F.col(month_col) >= start.year * 100 + start.month) if by_month else out


def contra_entry_match(ledger: DataFrame, flagged: DataFrame,
                       keys: Sequence[str] = ("transactiondate", "timekey", "journalnumber"),
                       amount: str = "transactionamount", account: str = "accountkey",
                       client: str = "clientkey", carry: Sequence[str] = (),
                       debit_ledger: DataFrame | None = None,
                       flagged_col: str | None = None) -> DataFrame:
    """Pairs of (credit, debit) entries.

    Output columns: the match ``keys``; ``credit_account``,
    ``credit_client``, ``credit_amount``; ``debit_account``,
    ``debit_client``, ``debit_amount``; plus ``credit_<c>`` / ``debit_<c>``
    for each column in ``carry``.  ``debit_ledger`` lets the debit role read
    a different (e.g. wider) ledger slice; by default both roles read
    ``ledger``.
    """
    keys = list(keys)
    debit_src = ledger if debit_ledger is None else debit_ledger
    credit = ledger.filter(F.col(amount) > 0).select(
        *[F.col(k) for k in keys],
        F.col(amount).alias("credit_amount"),
        F.col(account).alias("credit_account"),
        F.col(client).alias("credit_client"),
        *[F.col(c).alias(f"credit_{c}") for c in carry])
    fcol = flagged_col or flagged.columns[0]
    fl = flagged.select(F.col(fcol).alias("__flagged"))
    debit = (debit_src.filter(F.col(amount) < 0)
             .join(fl, F.col(account) == fl["__flagged"], "left_semi")
             .select(*[F.col(k).alias(f"__d_{k}") for k in keys],
                     (-F.col(amount)).alias("__d_match"),  # same decimal type: no cast on the key
                     F.col(amount).alias("debit_amount"),
                     F.col(account).alias("debit_account"),
                     F.col(client).alias("debit_client"),
                     *[F.col(c).alias(f"debit_{c}") for c in carry]))
    cond = [credit[k] == debit[f"__d_{k}"] for k in keys]
    cond.append(credit["credit_amount"] == debit["__d_match"])
    cond.append(credit["credit_account"] != debit["debit_account"])
    cond.append(credit["credit_client"] != debit["debit_client"])
    out = credit.join(debit, cond, "inner")
    return out.drop(*[f"__d_{k}" for k in keys], "__d_match")
