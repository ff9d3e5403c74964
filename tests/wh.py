"""Tiny warehouse frames from dict rows, typed by the declared schemas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from fincrime.sources.catalog import Warehouse
from fincrime.sources.schemas import schema_of


def warehouse(spark, tables: dict) -> Warehouse:
    srcs = {}
    for name, rows in tables.items():
        schema = schema_of(name)
        data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
        srcs[name] = spark.createDataFrame(data, schema)
    return Warehouse(spark, srcs)


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def M(s) -> Decimal:
    return Decimal(str(s)).quantize(Decimal("0.01"))


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t))
