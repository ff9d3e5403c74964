"""Pinned semantics: null, cast and arithmetic rules written out once.

The warehouse dialect the reports were written for differs from Spark's
ANSI mode in several places (string ``+``, 2-argument ISNULL, ``yyyymmdd``
keys cast to dates, ``''`` compared with numbers, unguarded division).  Each
rule here is a plain Column expression, so it stays inside whole-stage
codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def to_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cat(*parts: ColumnOrName | object) -> Column:
    """String concatenation that propagates null, like ``+`` / ``||`` in the
    source dialect.  Plain Python strings are literals, Columns are columns.
    (Not ``concat_ws``: that skips nulls.)"""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*cols)


def date_from_key(key: ColumnOrName) -> Column:
    """``yyyymmdd`` integer key -> date; keys such as 0 or -1 give null."""
    return F.try_to_date(to_col(key).cast("string"), "yyyyMMdd")


def as_date(v: ColumnOrName | _dt.date | str) -> Column:
    """A date parameter or column.  Strings must be ISO ``yyyy-mm-dd``;
    slash forms such as ``2023/04/04`` are parsed explicitly (ANSI cast
    would raise on them)."""
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v.date())
    if isinstance(v, _dt.date):
        return F.lit(v)
    if isinstance(v, str) and "/" in v:
        return F.lit(_dt.datetime.strptime(v, "%Y/%m/%d").date())
    if isinstance(v, str):
        return F.lit(_dt.date.fromisoformat(v))
    raise TypeError(f"not a date: {v!r}")


def int_div(a: ColumnOrName, b: ColumnOrName | int) -> Column:
    """Integer division truncating toward zero (``datediff/365`` in the source
    is integer division)."""
    return F.call_function("div", to_col(a), b if isinstance(b, Column) else F.lit(b))


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division by zero gives null instead of an error."""
    return F.try_divide(to_col(a), to_col(b))


def try_decimal(c: ColumnOrName, precision: int = 23, scale: int = 2) -> Column:
    """Text to money; ``''`` and other non-numeric text give null."""
    return to_col(c).try_cast(f"decimal({precision},{scale})")


def try_int(c: ColumnOrName) -> Column:
    return to_col(c).try_cast("int")


def try_long(c: ColumnOrName) -> Column:
    return to_col(c).try_cast("bigint")


def ltrim_zeros(c: ColumnOrName) -> Column:
    """``TRIM(LEADING '0' FROM s)``; ``'000'`` gives ``''``."""
    return F.ltrim(to_col(c), F.lit("0"))


def day_filter(ts: ColumnOrName, day: ColumnOrName | _dt.date | str) -> Column:
    """``cast(ts as date) = day`` written as a half-open range on the raw
    column, so the predicate stays sargable (parquet min/max pruning)."""
    d = as_date(day)
    t = to_col(ts)
    return (t >= d.cast("timestamp_ntz")) & (t < F.date_add(d, 1).cast("timestamp_ntz"))


def month_floor_filter(date_col: ColumnOrName, as_of: ColumnOrName | _dt.date | str,
                       days: int = 30, faithful: bool = False) -> Column:
    """Rows from the start of the month that holds ``as_of - days``.

    ``faithful=True`` keeps the source's literal test (year >= y AND
    month >= m), which drops earlier months of a later year."""
    start = F.date_sub(as_date(as_of), days)
    d = to_col(date_col)
    if faithful:
        return (F.year(d) >= F.year(start)) & (F.month(d) >= F.month(start))
    return d >= F.trunc(start, "MM")
