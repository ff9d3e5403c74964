"""Spark-vs-DuckDB comparison of keyed queries (order-insensitive).

Usage: python tests/harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        f = round(float(v), 4)
        return 0.0 if f == 0 else f
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _key(row):
    return tuple((x is None, str(type(x).__name__ if x is not None else ""), x if x is not None else 0)
                 if isinstance(x, (int, float)) else (x is None, "s", "" if x is None else str(x))
                 for x in row)


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return names, out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = [c for c in rel.columns]
    drows = rel.fetchall()
    sn, sr = normalise(sdf.columns, srows)
    dn, dr = normalise(dcols, drows)
    ok = sn == dn and sr == dr
    detail = ""
    if sn != dn:
        detail = f"columns {sn} vs {dn}"
    elif len(sr) != len(dr):
        detail = f"rows {len(sr)} vs {len(dr)}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        detail = f"values differ e.g. {diff}"
    return ok, len(sr), t1 - t0, detail


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from fincrime.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, ors = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in ors:
            print(f"{name:28s} NO-ORACLE")
            continue
        try:
            ok, n, sec, detail = compare(spark, con, name, fn, ors[name], sf_dir)
        except Exception as e:  # report and continue
            ok, n, sec, detail = False, -1, 0.0, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={n:<7d} {sec:6.2f}s {detail}", flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
