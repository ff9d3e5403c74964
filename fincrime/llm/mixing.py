"""Mixing sources to target weights by nested hash thresholds.

Every document gets a fixed 60-bit hash.  A source takes each of its documents
``whole`` times and once more those whose hash lies below the source's
threshold.  The threshold comes from histograms: words by source and hash
bucket, the running sum finds the bucket in which the budget ends, and only
the documents of that boundary bucket are counted again in finer buckets, until
it holds a single hash.  Documents are never sorted, and the first result is the
longest prefix in hash order that stays within the budget.

One long document at the boundary leaves much of a budget, so ``mix`` goes on:
in each pass those of the documents after the boundary that are at most half of
what is left give another prefix, until none is that small; a pass leaves less
than half.  Then the one document whose size is nearest to the rest is taken if
that brings the words nearer to the target, from below or above.

Scale: the histogram has at most ``2 ** BITS`` rows a source and is summed
before the shuffle, so a hot source costs no more than any other; the
documents meet the thresholds (a row a source) in a join that Spark broadcasts
below its threshold and splits beyond.  The list of sources is the mix's
configuration and is ranked as a whole.

Defined results: null text has size 0; a source of null is a source of its own
and comes last; a source of size 0 takes nothing; repeated rows have one hash
and are taken together or not (the last 20 bits are of the text, so null and
repeated ids of different texts have hashes of their own); an empty table gives
an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fincrime.llm.common import WORD, table, whole, written

BITS = 10
LEVELS = 6                   # BITS * LEVELS bits of hash
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def hash60(id: str) -> Column:
    """15 hex digits of the id's MD5 as a number; portable to other engines."""
    text = F.coalesce(F.col(id).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_with_text(id: str, text: str) -> Column:
    """``hash60`` with its last 20 bits replaced by 20 of the text's MD5."""
    own = F.conv(F.substring(F.md5(whole(text)), 1, 5), 16, 10).cast("long")
    return F.shiftleft(F.shiftright(hash60(id), 20), 20) + own


def sized(df: DataFrame, id: str, text: str, source: str) -> DataFrame:
    return df.select(F.col(id).alias("id"), F.col(source).alias("source"), hash_with_text(id, text).alias("h"),
                     F.regexp_count(whole(text), F.lit(WORD)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target words a source: ``share`` of all words dealt by weight, no source
    above ``most`` times its own; what it cannot use goes to the others by weight.

    ``sizes`` has a row a source (source, source_size).  A round caps every
    source above its limit; each but the last caps one at least, and the
    driver sees two sums a round."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    # the same list in each round: ranks are computed once
    s = written(sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (rank - 1) % len(weights))
                                 .cast("double")), "mix-sources")
    cap = most * F.col("source_size")
    budget = s.agg(F.sum("source_size")).first()[0]
    level, budget = 0.0, share * (budget or 0)
    while True:
        capped = cap <= level * F.col("weight")
        left, weight = s.agg(F.lit(budget) - F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)),
                             F.sum(F.when(~capped, F.col("weight")))).first()
        new = left / weight if weight else level
        if new <= level:
            break
        level = new
    return s.withColumn("target", F.least(cap, level * F.col("weight")))


def thresholds(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """Adds ``whole`` (copies that all documents get) and ``below`` (hashes
    under it get one more) to ``goal``."""
    whole_copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    g = goal.withColumn("whole", whole_copies.cast("long")) \
            .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")) \
            .withColumn("below", F.lit(0).cast("long"))
    return _prefix(sizes, g)


def _prefix(sizes: DataFrame, g: DataFrame) -> DataFrame:
    """``g`` with ``below`` after the longest prefix within ``left``, and what is
    left then; ``below`` is 0 in ``g``, and ``2 ** (BITS * LEVELS)`` if all fit."""
    keys = [c for c in g.columns if c not in ("left", "below")]
    for level in range(1, LEVELS + 1):
        width = 1 << (BITS * (LEVELS - level))
        inside = g.select(F.col("source").alias("s"), F.col("below").alias("low"))
        rows = sizes.join(inside, sizes["source"].eqNullSafe(inside["s"])).drop("s")
        if level > 1:        # only the boundary bucket of the level before
            rows = rows.filter((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + (width << BITS)))
        # summed in the tasks first: a row a source and bucket is shuffled
        hist = rows.groupBy("source", F.floor(F.col("h") / F.lit(width)).cast("long").alias("bucket")) \
                   .agg(F.sum("size").alias("words"), F.min("h").alias("first"), F.max("h").alias("last"))
        w = Window.partitionBy("source").orderBy("bucket")
        hist = hist.withColumn("upto", F.sum("words").over(w))
        h, k = hist.alias("h"), g.alias("k")
        joined = k.join(h, F.col("k.source").eqNullSafe(F.col("h.source")), "left")
        fits = F.col("h.upto") <= F.col("k.left")
        g = joined.groupBy(*[F.col(f"k.{c}").alias(c) for c in [*keys, "left"]]).agg(
            F.coalesce(F.max(F.when(fits, F.col("h.upto"))), F.lit(0)).alias("taken"),
            F.min(F.when(~fits, F.struct("h.bucket", "h.first", "h.last"))).alias("edge"),
            F.max("k.below").alias("before"))
        g = g.select(*keys, (F.col("left") - F.col("taken")).alias("left"),
                     # none is over the edge: everything up to the end of the bucket before
                     F.coalesce(F.col("edge.bucket") * F.lit(width),
                                F.col("before") + F.lit(width << BITS)).alias("below"),
                     F.coalesce(F.col("edge.first") < F.col("edge.last"), F.lit(False)).alias("open"))
        g = written(g, f"mix-level{level}")
        if not g.filter("open").head(1):
            break
        g = g.drop("open")
    return g.drop("open")


def _once_more(size: str) -> Column:
    """Whether the prefix, a pass or the last choice takes a hash once more."""
    passes = F.exists("passes", lambda x: (F.col("h") >= x["low"]) & (F.col("h") < x["high"]) & (F.col(size) <= x["most"]))
    return (F.col("h") < F.col("first")) | (passes & (F.col(size) > 0)) | F.coalesce(F.col("h") == F.col("extra"), F.lit(False))


def refined(units: DataFrame, g: DataFrame) -> DataFrame:
    """``thresholds``' result with ``first`` (its ``below``), ``passes`` and
    ``extra``, see ``_once_more``.  ``units`` has a row a source and hash.

    A pass takes over half of what is left or all that it admits, so passes are
    at most the binary digits of the largest unit."""
    # without a budget the prefix has documents of size 0 only, and they are not taken beyond the whole copies
    budget = F.col("target") > F.col("whole") * F.col("source_size")
    g = g.withColumn("first", F.when(budget, F.col("below")).otherwise(F.lit(0))) \
         .withColumn("passes", F.array().cast("array<struct<low:long,high:long,most:double>>"))
    keys = [c for c in g.columns if c not in ("left", "below", "passes")]
    while True:
        g = g.withColumn("low", F.col("below")).withColumn("most", F.col("left") / 2)
        k = g.select(F.col("source").alias("s"), "low", "most")
        rows = units.join(k, units["source"].eqNullSafe(k["s"])) \
                    .filter((F.col("h") >= F.col("low")) & (F.col("size") <= F.col("most")) & (F.col("size") > 0)) \
                    .select("source", "h", "size")
        if not rows.head(1):
            break
        g = _prefix(rows, g.withColumn("below", F.lit(0).cast("long"))).select(
            *keys, "left", "below", F.concat("passes", F.array(F.struct(
                "low", F.col("below").alias("high"), "most"))).alias("passes"))
    g = g.drop("low", "most")
    k = g.select(F.col("source").alias("s"), "left", "first", "passes", F.lit(None).cast("long").alias("extra"))
    away = F.abs(F.col("left") - F.col("size"))
    best = units.join(k, units["source"].eqNullSafe(k["s"])).filter(~_once_more("size") & (away < F.col("left"))) \
                .groupBy("source").agg(F.min(F.struct(away.alias("away"), "h")).alias("best")) \
                .select(F.col("source").alias("s"), F.col("best.h").alias("extra"))
    return written(g.join(best, g["source"].eqNullSafe(best["s"]), "left").drop("s"), "mix-refined")


def mix(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a document: ``size``, ``source_size``, ``target`` of its source
    and ``copies`` that the mix takes of it; ``h`` is its hash."""
    sizes = written(sized(df, id, text, source), "mix-sizes")
    goal = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    units = written(sizes.groupBy("source", "h").agg(F.sum("size").alias("size")), "mix-units")
    cut = refined(units, thresholds(sizes, goal)).select(F.col("source").alias("s"), "source_size", "target", "whole", "first", "passes", "extra")
    u = units.join(cut, units["source"].eqNullSafe(cut["s"])) \
             .select(F.col("source").alias("s"), F.col("h").alias("uh"), "source_size", "target",
                     (F.col("whole") + _once_more("size").cast("long")).alias("copies"))
    return sizes.join(u, (F.col("h") == F.col("uh")) & F.col("source").eqNullSafe(F.col("s"))) \
                .select(F.col("id").alias(id), "source", "size", "source_size", "target", "copies", "h")


def op6(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_sql() -> str:
    """The same by sorting; the water level is the smallest at which the sources
    beyond their limit and the others together use the budget.  ``p`` has a row
    a source and pass: its prefix takes hashes from ``low`` to before ``high`` of
    at most ``most`` words, and leaves ``rest``."""
    w = ", ".join(map(str, WEIGHTS))
    end = 1 << (BITS * LEVELS)
    return rf"""
with recursive d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
             (('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 15))::bigint // 1048576) * 1048576
               + ('0x' || substr(md5(coalesce(text, '')), 1, 5))::bigint as h from documents),
s as (select source, sum(size)::bigint as source_size,
        [{w}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1]::double as weight
      from d group by source),
r as (select *, {MOST} * source_size / weight as fill from s),
lev as (select a.fill, {SHARE} * (select sum(source_size) from s)
          - (select coalesce(sum({MOST} * b.source_size), 0) from r b where b.fill <= a.fill) as rest,
          (select sum(b.weight) from r b where b.fill > a.fill) as heavy
        from (select 0.0::double as fill union all select fill from r) a),
l as (select min(rest / heavy) as level from lev where heavy > 0 and rest / heavy >= fill
        and rest / heavy <= (select min(b.fill) from r b where b.fill > lev.fill)),
t as (select source, source_size, least({MOST} * source_size,
        coalesce((select level from l), (select max(fill) from r)) * weight) as target from s),
c as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from t),
u as (select source, h, sum(size)::bigint as size from d group by source, h),
p as (
  select x.source, 0 as n, 0::bigint as low, coalesce(min(h) filter (upto > x.rest), {end}) as high, {float(end)}::double as most,
    any_value(x.rest) - coalesce(max(upto) filter (upto <= x.rest), 0) as rest
  from (select c.source, target - whole * source_size as rest, h, sum(size) over (partition by c.source order by h) as upto
        from c join u on u.source is not distinct from c.source) x group by x.source
  union all
  select x.source, any_value(x.n) + 1, any_value(x.low), coalesce(min(h) filter (upto > x.rest), {end}), any_value(x.most),
    any_value(x.rest) - coalesce(max(upto) filter (upto <= x.rest), 0)
  from (select p.source, p.n, p.high as low, p.rest / 2 as most, p.rest, h, sum(size) over (partition by p.source order by h) as upto
        from p join u on u.source is not distinct from p.source where h >= p.high and size <= p.rest / 2 and size > 0) x
  group by x.source),
o as (select u.*, target > whole * source_size and exists (select 1 from p where p.source is not distinct from u.source
        and u.h >= p.low and u.h < p.high and u.size <= p.most and (p.n = 0 or u.size > 0)) as more,
        (select arg_min(p.rest, -p.n) from p where p.source is not distinct from u.source) as rest
      from u join c on u.source is not distinct from c.source),
e as (select source, arg_min(h, (abs(rest - size), h)) as h from o where not more and abs(rest - size) < rest group by source)
select doc_id, d.size, source_size, target, (d.size * (whole + case when o.more or e.h is not null then 1 else 0 end))::bigint as taken
from d join c on d.source is not distinct from c.source join o on o.source is not distinct from d.source and o.h = d.h
  left join e on e.source is not distinct from d.source and e.h = d.h
"""
