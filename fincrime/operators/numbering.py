"""Row numbering that stays balanced when one key holds most rows, and global ranks.

``row_number`` over a key alone sorts each key's rows inside one task; over no key
it sorts the whole table in one.  Here the keys with many rows are found in a
sample of at most about ``SAMPLE`` rows, and each of them is cut into ranges of
its whole order (all of its columns, so a constant first column is cut by the
next) at values of the sample.  Rows are numbered within (key, range) and the
rows of the key's earlier ranges are added.  Ranges are counted only for those
keys: a row a range, about ``RANGES`` at most.  All other keys take the
plain window; without a hot key that is the whole plan, one shuffle.

The cuts are literals of the plan, one list for all keys in the order of key and
row, so every part of it, and every recomputed task, cuts alike.  A row finds its
range by halving that list, so its cost grows with the logarithm of the cuts.
A poor sample costs balance and never a number.  All of it is built-in
expressions.  The result equals ``row_number() over (partition by keys
order by order)`` for a total order (ties must be broken by the caller, as
everywhere).  Null keys are keys, nulls come last; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = 10_000        # a key with more rows is cut into ranges of about as many
RANGES = 1_000       # cuts, about, of a whole table: larger tables take longer ranges
SAMPLE = 20_000      # rows, about, in the sample
LEAST = 16           # sampled rows of a key that is cut; a range has a quarter of that at least
_BUCKET, _BEFORE, _SPLITS, _LAST = "__bucket", "__before", "__splits", "__last"

#: a column's value, and whether it ascends
Ordered = tuple[Column, bool]


def _sorted(value: Column, ascending: bool) -> Column:
    return value.asc_nulls_last() if ascending else value.desc_nulls_last()


def _not_after(split: Sequence[Column], order: Sequence[Ordered]) -> Column:
    """Whether a split stands before a row or where it stands, nulls last."""
    out = F.lit(True)
    for s, (value, ascending) in reversed(list(zip(split, order, strict=True))):
        before = F.coalesce(s < value if ascending else s > value, F.lit(False)) | (s.isNotNull() & value.isNull())
        out = before | (s.eqNullSafe(value) & out)
    return out


def _rows_a_range(total: int) -> int:
    return max(ROWS, -(-total // RANGES))


def _splits(source: DataFrame, keys: Sequence[str], order: Sequence[Ordered], total: int, least_ranges: int) -> DataFrame:
    """A row for each key with many rows: the key, and order values that cut it, in their order.

    The sample is bounded, not the table."""
    share = min(1.0, SAMPLE / total)
    values = [v.alias(f"o{i}") for i, (v, _) in enumerate(order)]
    s = source.sample(share, seed=7).select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *values)
    names = [f"k{i}" for i in range(len(keys))]
    by = [F.col(c) for c in names] or [F.lit(0)]
    w = Window.partitionBy(*by)
    s = s.withColumn("n", F.count("*").over(w)).withColumn("at", F.row_number().over(
        w.orderBy(*[_sorted(F.col(f"o{i}"), a) for i, (_, a) in enumerate(order)])))
    ranges = F.least(F.greatest(F.ceil(F.col("n") / share / _rows_a_range(total)), F.lit(least_ranges)), F.floor(F.col("n") * 4 / LEAST))
    s = s.withColumn("ranges", ranges).filter((F.col("n") >= LEAST) & (F.col("ranges") > 1))
    cut = F.floor(F.col("at") * F.col("ranges") / F.col("n")) > F.floor((F.col("at") - 1) * F.col("ranges") / F.col("n"))
    return s.filter(cut & (F.col("at") < F.col("n"))).groupBy(*by[:len(keys)]) \
            .agg(F.sort_array(F.collect_list(F.struct("at", *[f"o{i}" for i in range(len(order))]))).alias(_SPLITS))


def _any_hot(source: DataFrame, keys: Sequence[str], total: int) -> bool:
    """Whether the sample shows a key with more than ``ROWS`` rows: one small count, without the cuts."""
    share = min(1.0, SAMPLE / total)
    n = source.sample(share, seed=7).groupBy(*keys).count()
    return bool(n.filter((F.col("count") >= LEAST) & (F.col("count") > _rows_a_range(total) * share)).head(1))


def _literals(values: Sequence, kind: T.DataType) -> Column:
    """An array literal; values of days and instants come as text (see ``_as_text``)."""
    return F.array(*[F.lit(v) for v in values]).cast(T.ArrayType(kind))


def _as_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _range_of(cuts: Sequence[Column], n: int, order: Sequence[Ordered]) -> Column:
    """The number of cuts that do not stand after a row, by halving: a step for each binary digit of ``n``.

    Whatever the cuts are, a later row never gets a smaller number."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])

    def step(at: Column, width: Column) -> Column:
        there = at + width
        cut = [F.get(c, there - 1) for c in cuts]
        return F.when((there <= n) & _not_after(cut, order), there).otherwise(at)
    return F.aggregate(steps, F.lit(0), step)


def number_rows_balanced(df: DataFrame, keys: Sequence[str], order: Sequence[Ordered], rest: Sequence[Column] = (),
                         name: str = "rn", sample_of: DataFrame | None = None, kind: str = "int") -> DataFrame:
    """``row_number()`` per ``keys`` by ``order``, then by ``rest`` (Columns with
    their direction, which sort but do not cut).

    ``sample_of`` is a table with the same columns that is cheaper to read, such
    as the one that ``df`` removes repeats from."""
    source = df if sample_of is None else sample_of
    keys = list(keys)
    sort = [*[_sorted(v, a) for v, a in order], *rest]
    total = source.count()
    cuts = []
    if order and (not keys or total > ROWS and _any_hot(source, keys, total)):
        least = 1 if keys else source.sparkSession.sparkContext.defaultParallelism
        found = _splits(source, keys, order, max(total, 1), least)
        names = [f"k{i}" for i in range(len(keys))] + [f"o{i}" for i in range(len(order))]
        flat = found.select("*", F.posexplode(_SPLITS).alias("pos", "cut")).select(*found.columns[:-1], "pos", "cut.*")
        kinds = [flat.schema[c].dataType for c in names]
        cuts = flat.orderBy(*[F.col(c).asc_nulls_last() for c in found.columns[:-1]], "pos") \
            .select(*[F.col(c).cast("string").alias(c) if _as_text(k) else F.col(c) for c, k in zip(names, kinds, strict=True)], "pos") \
            .collect()
    if not cuts:
        parts = [F.col(k) for k in keys] or [F.lit(0)]
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*parts).orderBy(*sort)).cast(kind))

    # a row's range: the cuts of all keys are one list by key, then by order
    lists = [_literals([r[i] for r in cuts], k) for i, k in enumerate(kinds)]
    by_key = [(df[k], True) for k in keys]
    d = df.withColumn(_BUCKET, _range_of(lists, len(cuts), [*by_key, *order]))
    # a key is cut if the cut before or after the row is one of its own
    own = [reduce(lambda a, b: a & b, [F.get(c, at).eqNullSafe(F.col(k)) for c, k in zip(lists, keys)], (at >= 0) & (at < len(cuts)))
           for at in (F.col(_BUCKET) - 1, F.col(_BUCKET))]
    starts = [i for i, r in enumerate(cuts) if r["pos"] == 0] + [len(cuts)]
    last = F.array(*[F.lit(end) for start, end in zip(starts, starts[1:]) for _ in range(start, end)])
    d = d.withColumn(_LAST, F.when(own[0], F.get(last, F.col(_BUCKET) - 1)).when(own[1], F.get(last, F.col(_BUCKET))))

    # rows of earlier ranges, a row a range; each range counts for all of its key that follow it
    counts = d.filter(F.col(_LAST).isNotNull()).groupBy(*keys, _LAST, _BUCKET).agg(F.count("*").alias("__n"))
    later = F.sequence(F.col(_BUCKET) + 1, F.col(_LAST))
    before = counts.filter(F.col(_BUCKET) < F.col(_LAST)) \
        .select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)], F.explode(later).alias("__later"), "__n") \
        .groupBy(*[f"__c{i}" for i in range(len(keys))], "__later").agg(F.sum("__n").alias(_BEFORE))
    local = d.withColumn("__local", F.row_number().over(Window.partitionBy(*keys, _BUCKET).orderBy(*sort)))
    same = reduce(lambda a, b: a & b, [local[k].eqNullSafe(before[f"__c{i}"]) for i, k in enumerate(keys)],
                  local[_BUCKET] == before["__later"])
    rn = F.col("__local") + F.coalesce(F.col(_BEFORE), F.lit(0))
    return local.join(F.broadcast(before), same, "left").select(*[local[c] for c in df.columns], rn.cast(kind).alias(name))


def global_rank(df: DataFrame, order: Sequence[tuple[str, bool]], name: str = "rank") -> DataFrame:
    """Each row's place (from 1) in the order of the whole table, as a column.

    ``order``: (column, whether it ascends), total.  Ranges of the order are
    numbered side by side, so no task sorts the table."""
    pairs = [(F.col(c), a) for c, a in order]
    return number_rows_balanced(df, [], pairs, name=name, kind="long")
