"""Business labels: names, addresses, tellers, flags, amounts.

Every helper returns a Column built from Spark built-ins.  Null handling is
deliberate: a null part makes the whole label null, as ``+`` / ``||`` do in
the source dialect.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from fincrime.functions.semantics import (ColumnOrName, as_date, cat, int_div, ltrim_zeros,
                                          safe_divide, to_col, try_decimal)


def _opt_part(c: ColumnOrName) -> Column:
    """'' when the trimmed part is blank, else ' ' + trimmed part; null stays null."""
    t = F.trim(to_col(c))
    return F.when(t == "", F.lit("")).otherwise(cat(" ", t))


def full_name(first: ColumnOrName, middle1: ColumnOrName, middle2: ColumnOrName,
              middle3: ColumnOrName | None = None, title: ColumnOrName | None = None,
              last: ColumnOrName | None = None) -> Column:
    """Trimmed parts joined by one blank, blank middle/last parts skipped."""
    parts: list[Column] = []
    if title is not None:
        parts += [F.trim(to_col(title)), F.lit(" ")]
    parts.append(F.trim(to_col(first)))
    for m in (middle1, middle2, middle3):
        if m is not None:
            parts.append(_opt_part(m))
    if last is not None:
        parts.append(_opt_part(last))
    return F.trim(F.concat(*parts))


def full_name_raw(first: ColumnOrName, middle1: ColumnOrName, middle2: ColumnOrName,
                  middle3: ColumnOrName) -> Column:
    """Plain join with single blanks; blank parts are kept."""
    return cat(to_col(first), " ", to_col(middle1), " ", to_col(middle2), " ", to_col(middle3))


def home_address(res_l1: ColumnOrName, res_l2: ColumnOrName, res_l3: ColumnOrName,
                 res_city: ColumnOrName, res_postcode: ColumnOrName,
                 postal_l1: ColumnOrName, postal_city: ColumnOrName) -> Column:
    """Short form (postal line 1, city) when the residential line 1 equals
    the postal one and residential lines 2-3 are empty; else five parts."""
    r1, r2, r3 = to_col(res_l1), to_col(res_l2), to_col(res_l3)
    short = (r1 == to_col(postal_l1)) & (F.length(r2) == 0) & (F.length(r3) == 0)
    return F.when(short, cat(to_col(postal_l1), ", ", to_col(postal_city))).otherwise(
        cat(r1, ", ", r2, ", ", r3, ", ", to_col(res_city), ", ", to_col(res_postcode)))


def address_line(l1: ColumnOrName, l2: ColumnOrName, l3: ColumnOrName, city: ColumnOrName,
                 clean: bool = False) -> Column:
    """Trimmed parts joined with ', '; empty parts collapsed by two passes of
    replace.  ``clean=True`` also strips a leftover leading/trailing ', '."""
    joined = cat(F.trim(to_col(l1)), ", ", F.trim(to_col(l2)), ", ", F.trim(to_col(l3)), ", ",
                 F.trim(to_col(city)))
    sep = F.lit(", , ")
    once = F.replace(joined, sep, F.lit(", "))
    out = F.replace(once, sep, F.lit(", "))
    if clean:
        out = F.regexp_replace(F.regexp_replace(out, r"^(, )+", ""), r"(, )+$", "")
    return out


def teller_label(number: ColumnOrName, name: ColumnOrName) -> Column:
    """Teller number without leading zeros, ' - ', teller name."""
    return cat(ltrim_zeros(number), " - ", to_col(name))


def flag_yes_no(count: ColumnOrName) -> Column:
    """'Yes' when the count is positive, else 'No' (null gives 'No')."""
    return F.when(to_col(count) > 0, F.lit("Yes")).otherwise(F.lit("No"))


def strip_check_digit(number: ColumnOrName, n: int = 8) -> Column:
    """Base number: the first ``n`` characters of a number with check digit."""
    return F.substring(to_col(number), 1, n)


def card_bin(pan: ColumnOrName) -> Column:
    return F.substring(to_col(pan), 1, 6)


def fraud_code(text: ColumnOrName) -> Column:
    return F.substring(to_col(text), 1, 1)


def route_by_group(group: ColumnOrName, value: ColumnOrName, groups: list[str],
                   negate: bool = False) -> Column:
    """``value`` when the group is (not) in ``groups``, else null."""
    cond = to_col(group).isin(*groups)
    return F.when(~cond if negate else cond, to_col(value))


def minor_units(text: ColumnOrName) -> Column:
    """Amount text in minor units -> decimal(23,2) major units.

    ``''`` and ``'0'`` give 0, numeric text is divided by 100, null stays
    null and other text gives null (never an error)."""
    t = to_col(text)
    major = (try_decimal(t) / 100).cast("decimal(23,2)")
    return F.when(t.isin("", "0"), F.lit(0).cast("decimal(23,2)")).otherwise(major)


def credit_available(balance: ColumnOrName, limit: ColumnOrName) -> Column:
    """balance - limit * -1, i.e. balance + limit."""
    return to_col(balance) - to_col(limit) * -1


def age_years(birth: ColumnOrName, as_of: ColumnOrName | _dt.date | str | None = None) -> Column:
    """Whole years as days div 365 (not calendar years)."""
    ref = F.current_date() if as_of is None else as_date(as_of)
    return int_div(F.datediff(ref, to_col(birth)), 365)


def arrears_ratio(arrears: ColumnOrName, balance: ColumnOrName) -> Column:
    """round(arrears / balance, 2) * 100 as text with two decimals and ' %';
    a zero balance gives null."""
    r = F.round(safe_divide(arrears, balance), 2) * 100
    return cat(r.cast("decimal(18,2)").cast("string"), " %")


def hour_label(ts: ColumnOrName) -> Column:
    """Unpadded ``<hour>h<minute>`` label, e.g. ``9h5``.  Sort on the real
    timestamp, never on this text."""
    t = to_col(ts)
    return cat(F.hour(t).cast("string"), "h", F.minute(t).cast("string"))


def composite_key(*cols: ColumnOrName, sep: str = "|") -> Column:
    """``a + '|' + b`` key (null in any part gives null, so it never matches)."""
    parts: list = []
    for i, c in enumerate(cols):
        if i:
            parts.append(sep)
        parts.append(to_col(c))
    return cat(*parts)
