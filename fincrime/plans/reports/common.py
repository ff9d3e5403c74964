"""Helpers shared by the report pipelines."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fincrime.operators.snapshots import scd2_current


def ties_over(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """Every other column, ascending with nulls last: a total order for
    ``row_number`` so that recomputation after a lost executor gives the
    same rows."""
    skip = set(exclude)
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in skip]


def current(df: DataFrame, on: bool = True) -> DataFrame:
    return scd2_current(df) if on else df


def prefixed(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rename columns with a role prefix (role-playing dimensions)."""
    cols = list(cols) if cols is not None else df.columns
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def to_date_value(v) -> _dt.date:
    if v is None:
        return _dt.date.today()
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    s = str(v)
    if "/" in s:
        return _dt.datetime.strptime(s, "%Y/%m/%d").date()
    return _dt.date.fromisoformat(s)


def date_key(d: _dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def ts_ntz(v) -> Column:
    if isinstance(v, _dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(str(v)).cast("timestamp_ntz")
