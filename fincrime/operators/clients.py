"""Client-centred lookups: all accounts of a client, its cards, stopped cards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime.operators.lookups import semi_join_keys
from fincrime.operators.snapshots import scd2_current


def clients_of_accounts(accounts: DataFrame, search: Sequence | DataFrame,
                        account_col: str = "accountkey",
                        client_col: str = "clientnumber") -> DataFrame:
    """Distinct client numbers owning any of the searched accounts (every
    historic version counts, so a re-assigned account finds all owners)."""
    return semi_join_keys(accounts, account_col, search).select(client_col).distinct()


def accounts_of_client(accounts: DataFrame, search: Sequence | DataFrame,
                       account_col: str = "accountkey",
                       client_col: str = "clientnumber") -> DataFrame:
    """Every account row of the clients that own the searched accounts.

    Two semi-joins; nothing is collected, so a search set of any size works
    and one key gives the same rows as the scalar form."""
    clients = clients_of_accounts(accounts, search, account_col, client_col)
    return accounts.join(clients, client_col, "left_semi")


CARD_ATTRIBUTES = ("clientnumber", "cardholdertypecode", "cardnumber", "primarycardnumber",
                   "cardstatusname", "cardholdertypename", "embossedname", "partyidentifiernumber",
                   "cardcreationdate")


def cards_of_client(cards: DataFrame, clients: DataFrame, client_col: str | None = None,
                    holder_code: str = "P", base_len: int = 8,
                    attributes: Sequence[str] = CARD_ATTRIBUTES) -> DataFrame:
    """Current cards of a holder type whose client number (first ``base_len``
    characters) is one of ``clients``; the newest card key per set of card
    attributes (``groupBy`` + ``max``: partial aggregation before the shuffle).
    Adds ``card_clientnumber`` (the base client number)."""
    cc = client_col or clients.columns[0]
    keys = clients.select(F.col(cc).alias("__owner"))
    c = scd2_current(cards).filter(F.col("cardholdertypecode") == holder_code) \
        .withColumn("card_clientnumber", F.substring("clientnumber", 1, base_len))
    c = c.join(keys, F.col("card_clientnumber") == F.col("__owner"), "left_semi")
    return c.groupBy(*attributes, "card_clientnumber").agg(F.max("cardkey").alias("cardkey"))


def stopped_card_activity(auths: DataFrame, cards: DataFrame, card_col: str = "cardno",
                          ts_col: str = "datetime_req", stop_col: str = "stopdate") -> DataFrame:
    """Card messages on or after the card's stop date (calendar days).  Cards
    without a stop date drop out (null comparison).  Carries the card's columns."""
    k = cards.withColumnRenamed(card_col, "__card")
    j = auths.join(k, auths[card_col] == k["__card"], "inner").drop("__card")
    return j.filter(F.to_date(F.col(ts_col)) >= F.col(stop_col))
