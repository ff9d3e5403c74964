"""Set operations and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; fails on differing column sets."""
    out = dfs[0]
    for d in dfs[1:]:
        if sorted(d.columns) != sorted(out.columns):
            raise ValueError(f"union of different columns: {out.columns} vs {d.columns}")
        out = out.unionByName(d)
    return out


def dedup(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """SELECT DISTINCT / GROUP BY all columns (hash aggregate with map-side
    partial aggregation, so repeated rows are collapsed before the shuffle)."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()
