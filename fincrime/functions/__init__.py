"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from fincrime.functions.labels import (address_line, age_years, arrears_ratio, card_bin, composite_key,
                                       credit_available, flag_yes_no, fraud_code, full_name,
                                       full_name_raw, home_address, hour_label, minor_units,
                                       route_by_group, strip_check_digit, teller_label)
from fincrime.functions.semantics import (as_date, cat, date_from_key, day_filter, int_div,
                                          ltrim_zeros, month_floor_filter, safe_divide, to_col,
                                          try_decimal, try_int, try_long)

__all__ = [
    "address_line", "age_years", "arrears_ratio", "card_bin", "composite_key", "credit_available", "flag_yes_no",
    "fraud_code", "full_name", "full_name_raw", "home_address", "hour_label", "minor_units",
    "route_by_group", "strip_check_digit", "teller_label", "as_date", "cat", "date_from_key",
    "day_filter", "int_div", "ltrim_zeros", "month_floor_filter", "safe_divide", "to_col",
    "try_decimal", "try_int", "try_long",
]
