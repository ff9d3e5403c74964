"""Slowly-changing dimensions and periodic snapshots.

* ``scd2_current``     current version of each dimension row.
* ``latest_snapshot``  rows of the newest global snapshot (scalar subquery:
                       computed once, then pushed into the scan as a runtime
                       filter; on a table partitioned by the snapshot key it
                       prunes whole partitions).
* ``latest_per_key`` / ``first_per_key``  newest / oldest row per key with a
                       required total order.  ``row_number() ... = 1`` makes
                       Spark plan a partial ``WindowGroupLimit`` *before* the
                       shuffle, so each map task sends at most one row per key
                       and a hot key cannot flood one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fincrime.functions.semantics import ColumnOrName, to_col


def scd2_current(df: DataFrame, flag: str = "rowiscurrent", value: int = 1) -> DataFrame:
    return df.filter(F.col(flag) == value)


def latest_snapshot(df: DataFrame, col: str, source: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` whose ``col`` equals the maximum of ``col`` over
    ``source`` (default: ``df`` itself).  No value passes through the driver."""
    src = df if source is None else source
    return df.filter(F.col(col) == src.select(F.max(col)).scalar())


def _sort_cols(cols: Sequence[ColumnOrName], ascending: bool) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, str):
            out.append(F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last())
        elif isinstance(c, tuple):
            out.append(to_col(c[0]).asc_nulls_last() if c[1] else to_col(c[0]).desc_nulls_last())
        else:
            out.append(c)  # a Column carries its own direction
    return out


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName | tuple], *,
                ties: Sequence[ColumnOrName | tuple], ascending: bool = False,
                name: str = "rn", balanced: bool = True, sample_of: DataFrame | None = None) -> DataFrame:
    """``row_number()`` per key.  Names in ``order``/``ties`` sort in the
    given direction with nulls last, pairs (name or Column, ascending) in their
    own; Columns keep the direction they carry.  ``ties`` is required: pass the
    columns that make the order total (or an empty list when ``order`` is
    already unique per key).

    ``balanced=True`` (default) numbers every row without putting a whole hot
    key in one task (see ``operators/numbering.py``); it cuts such a key by the
    leading names and pairs.  Callers that only keep ``rn = 1`` pass
    ``balanced=False``: the window plan then limits each key to one row per map
    task before the shuffle, which is already balanced."""
    full = [*order, *ties]
    sort = _sort_cols(full, ascending)
    if balanced:
        from fincrime.operators.numbering import number_rows_balanced
        cuts = next((i for i, c in enumerate(full) if not isinstance(c, (str, tuple))), len(full))
        pairs = [(to_col(c[0]), c[1]) if isinstance(c, tuple) else (F.col(c), ascending) for c in full[:cuts]]
        return number_rows_balanced(df, list(keys), pairs, sort[cuts:], name=name, sample_of=sample_of)
    w = Window.partitionBy(*[to_col(k) for k in keys]).orderBy(*sort)
    return df.withColumn(name, F.row_number().over(w))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName], *,
                   ties: Sequence[ColumnOrName], keep_rn: bool = False,
                   ascending: bool = False) -> DataFrame:
    """Newest row per key (``ascending=True``: oldest)."""
    rn = "__rn"
    out = number_rows(df, keys, order, ties=ties, ascending=ascending, name=rn, balanced=False)
    out = out.filter(F.col(rn) == 1)
    return out.withColumnRenamed(rn, "rn") if keep_rn else out.drop(rn)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName], *,
                  ties: Sequence[ColumnOrName], keep_rn: bool = False) -> DataFrame:
    """Oldest row per key, nulls last."""
    return latest_per_key(df, keys, order, ties=ties, keep_rn=keep_rn, ascending=True)


def newest_rows(df: DataFrame, keys: Sequence[str], *cols: str) -> DataFrame:
    """All rows of each key that share its greatest ``cols`` (nulls last), ties included.

    ``rank() = 1``: like ``row_number``, Spark limits each key before the
    shuffle, so of a history only its newest rows travel.  Joins that follow see
    the newest rows in place of the history."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in cols])
    return df.withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") == 1).drop("__rank")
