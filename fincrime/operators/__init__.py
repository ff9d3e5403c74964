"""DataFrame -> DataFrame building blocks shared by the reports."""

from fincrime.operators.lookups import (code_lookup, code_map_lookup, code_maps, decode, flag_keys,
                                        inline_relation, key_frame, semi_join_keys)
from fincrime.operators.matching import contra_entry_match, flagged_accounts, recent_ledger
from fincrime.operators.relational import dedup, union_all
from fincrime.operators.snapshots import (first_per_key, latest_per_key, latest_snapshot,
                                          newest_rows, number_rows, scd2_current)

__all__ = [
    "code_lookup", "code_map_lookup", "code_maps", "decode", "flag_keys", "inline_relation",
    "key_frame", "semi_join_keys",
    "contra_entry_match", "flagged_accounts", "recent_ledger", "dedup", "union_all",
    "first_per_key", "latest_per_key", "latest_snapshot", "newest_rows",
    "number_rows", "scd2_current",
]
