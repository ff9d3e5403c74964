"""Warehouse catalogue: name -> DataFrame, case-insensitive, schema-checked.

Names may carry a schema prefix (``core.dimclient``) and any case; they
resolve on the last dotted part.  Columns are lower-cased at the source so
that every operator can use lower-case names.  ``validate`` fails before any
job runs when a report needs a column a source lacks.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fincrime.sources.schemas import relation_names, schema_of


def _short(name: str) -> str:
    return name.lower().split(".")[-1]


def lower_columns(df: DataFrame) -> DataFrame:
    if all(c == c.lower() for c in df.columns):
        return df
    return df.select(*[F.col(f"`{c}`").alias(c.lower()) for c in df.columns])


class Warehouse:
    """A set of named relations.  Sources are DataFrames or parquet paths.

    Names are case-insensitive and may carry a schema.  A name without one finds
    a relation of any schema; where several schemas have it, that raises."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame | str]):
        self.spark = spark
        self._sources: dict[str, DataFrame | str] = {}
        for k, v in sources.items():
            if k.lower() in self._sources:
                raise ValueError(f"relation {k!r} is given twice")
            self._sources[k.lower()] = v
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def from_parquet_root(cls, spark: SparkSession, root: str,
                          names: Iterable[str] | None = None) -> "Warehouse":
        """One parquet folder (or file) per relation under ``root``.

        A local ``root`` is listed.  Otherwise (any Hadoop-compatible URI)
        ``names`` -- by default every declared relation -- map to
        ``root/name`` without listing; a missing one fails when first read."""
        root = root.rstrip("/")
        sources: dict[str, str] = {}
        if names is None and "://" not in root and os.path.isdir(root):
            for entry in os.listdir(root):
                sources[entry[:-8] if entry.endswith(".parquet") else entry] = f"{root}/{entry}"
        else:
            for name in (names if names is not None else relation_names()):
                sources[name] = f"{root}/{name}"
        return cls(spark, sources)

    def _key(self, name: str) -> str | None:
        """The full name of a relation: the name itself, else the one relation
        of that short name whose schema is not contradicted."""
        name = name.lower()
        if name in self._sources:
            return name
        found = [k for k in self._sources if _short(k) == _short(name) and not ("." in k and "." in name)]
        if len(found) > 1:
            raise ValueError(f"relation {name!r} is ambiguous: {', '.join(sorted(found))}")
        return found[0] if found else None

    def has(self, name: str) -> bool:
        return self._key(name) is not None

    def table(self, name: str) -> DataFrame:
        key = self._key(name)
        if key is None:
            raise KeyError(f"relation {name!r} is not in the catalogue")
        if key not in self._cache:
            src = self._sources[key]
            df = self.spark.read.parquet(src) if isinstance(src, str) else src
            self._cache[key] = lower_columns(df)
        return self._cache[key]

    __getitem__ = table

    def validate(self, required: Mapping[str, Iterable[str]]) -> None:
        """Check that every relation has the columns a report reads, with a
        type compatible with the declared schema.  Raises ``ValueError``."""
        problems = []
        for rel, cols in required.items():
            if not self.has(rel):
                problems.append(f"missing relation {rel}")
                continue
            have = {f.name: f.dataType for f in self.table(rel).schema.fields}
            declared = {f.name: f.dataType for f in schema_of(rel).fields}
            for c in cols:
                if c not in have:
                    problems.append(f"{rel}.{c} missing")
                elif c in declared and not _compatible(have[c], declared[c]):
                    problems.append(f"{rel}.{c} is {have[c].simpleString()}, "
                                    f"expected {declared[c].simpleString()}")
        if problems:
            raise ValueError("warehouse does not fit the report: " + "; ".join(problems))


def _compatible(have: T.DataType, want: T.DataType) -> bool:
    if type(have) is type(want):
        return True
    numeric = (T.IntegerType, T.LongType, T.ShortType, T.DecimalType)
    if isinstance(have, numeric) and isinstance(want, numeric):
        return True
    temporal = (T.TimestampType, T.TimestampNTZType)
    return isinstance(have, temporal) and isinstance(want, temporal)
