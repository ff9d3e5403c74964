"""Search keys, inline relations and code-table lookups.

Broadcast policy: an explicit ``F.broadcast`` is only put on relations whose
size is known on the driver before any job runs (literal rows, literal key
lists).  Everything whose size grows with the data is left to Spark's
size-checked broadcast (``autoBroadcastJoinThreshold``, re-checked by AQE on
real shuffle sizes), with sort-merge join as the fallback.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def inline_relation(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A literal relation (``VALUES`` / ``UNION ALL`` of constants)."""
    return spark.createDataFrame(list(rows), schema)


def key_frame(spark: SparkSession, keys: Sequence, name: str, dtype: str = "string") -> DataFrame:
    """Search keys as a one-column relation."""
    return spark.createDataFrame([(k,) for k in keys], f"{name} {dtype}")


def _typed_keys(df: DataFrame, col: str, keys: Sequence | DataFrame, key_col: str | None = None) -> DataFrame:
    """(__key): a literal list or a DataFrame of keys in the type of ``df``'s column."""
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(key_col or keys.columns[0]).alias("__key"))
    else:
        keys = [k for k in keys if k is not None]
        mixed = len({type(k) for k in keys}) > 1
        spark = df.sparkSession
        k = spark.createDataFrame([(str(x) if mixed else x,) for x in keys], ["__key"]) if keys \
            else spark.createDataFrame([], "__key string")
    k = k.select(F.col("__key").try_cast(df.schema[col].dataType).alias("__key"))
    return k


def semi_join_keys(df: DataFrame, col: str, keys: Sequence | DataFrame,
                   key_col: str | None = None) -> DataFrame:
    """Keep rows of ``df`` whose ``col`` is a search key.

    ``keys`` is a literal list or a DataFrame, each of any size, and takes one
    path: keys are cast to the column's type (one that does not fit matches
    nothing, nor does null) and semi-joined.  A set of one key gives the same
    rows as the scalar form ``col = key``, and a key that maps to several rows
    never fails (unlike a scalar subquery).  Spark broadcasts the keys if
    their known size is under its threshold."""
    k = _typed_keys(df, col, keys, key_col)
    return df.join(k, df[col] == k["__key"], "left_semi")


def flag_keys(df: DataFrame, col: str, keys: Sequence | DataFrame, name: str,
              key_col: str | None = None) -> DataFrame:
    """``df`` with ``name``: whether ``col`` is a search key (false where it is
    null).  For tests that keep a row by this key *or* by another; the keys are
    made distinct, so no row is doubled, and have any size."""
    k = _typed_keys(df, col, keys, key_col).filter(F.col("__key").isNotNull()).distinct().withColumn("__hit", F.lit(True))
    return df.join(k, df[col] == k["__key"], "left") \
             .select(*[df[c] for c in df.columns], F.coalesce("__hit", F.lit(False)).alias(name))


def code_lookup(df: DataFrame, dim: DataFrame, left_on: str, code: str,
                names: Sequence[str], current_only: bool = False,
                flag: str = "rowiscurrent", how: str = "left",
                rename: Mapping[str, str] | None = None) -> DataFrame:
    """Join distinct (code, name...) rows of a code table.  A row listed twice
    never doubles the fact rows; a code with two names does, as in the source."""
    d = dim.filter(F.col(flag) == 1) if current_only else dim
    rename = dict(rename or {})
    sel = [F.col(code).alias("__code")] + [F.col(n).alias(rename.get(n, n)) for n in names]
    d = d.select(*sel).dropDuplicates()
    return df.join(d, df[left_on] == d["__code"], how).drop("__code")


def code_maps(dim: DataFrame, pairs: Mapping[str, tuple[str, str]], current_only: bool = False,
              flag: str = "rowiscurrent") -> DataFrame:
    """All code tables of a junk dimension from one pass: a row for each code,
    with the (kind, name) pairs it has.

    ``pairs`` names the (code, name) columns of each kind.  Each row of the
    dimension leaves one entry a kind; entries become distinct in the tasks
    before the one shuffle, so repeats of a code cost nothing after it."""
    d = dim.filter(F.col(flag) == 1) if current_only else dim
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(code).cast("string").alias("code"),
                                 F.col(name).cast("string").alias("name")) for kind, (code, name) in pairs.items()])
    d = d.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("code").isNotNull())
    return d.groupBy("code").agg(F.collect_set(F.struct("kind", "name")).alias("names"))


def code_map_lookup(df: DataFrame, maps: DataFrame, kind: str, left_on: str, code: str, name: str) -> DataFrame:
    """``code`` and ``name`` of one kind of ``maps`` (see ``code_maps``), null where
    ``left_on`` has none; a code with two names doubles the row, as a left join of
    the distinct pairs would.

    Every kind reads ``maps`` whole by its code, so all lookups share one exchange."""
    m = maps.select(F.col("code").alias("__code"), F.col("names").alias("__names"))
    own = F.filter("__names", lambda x: x["kind"] == kind)
    j = df.join(m, df[left_on] == m["__code"], "left").withColumn("__own", F.explode_outer(own))
    return j.select(*df.columns, F.when(F.col("__own").isNotNull(), F.col("__code")).alias(code),
                    F.col("__own.name").alias(name))


def decode(df: DataFrame, col: str, mapping: Mapping[str, str], out: str) -> DataFrame:
    """Map codes to labels with a literal table (unknown codes give null).
    The table's size is fixed by ``mapping``, so it is broadcast."""
    spark = df.sparkSession
    rel = inline_relation(spark, list(mapping.items()), "__code string, __label string")
    return (df.join(F.broadcast(rel), df[col] == rel["__code"], "left")
              .drop("__code").withColumnRenamed("__label", out))
