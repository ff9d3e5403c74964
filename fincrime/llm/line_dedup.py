"""Line deduplication by site-relative frequency.

A line is boilerplate of a host if the share of the host's pages that contain
it exceeds ``RATIO``.  Pages with equal texts count as one page: a page served
under several addresses says nothing about a template, and its lines would
otherwise be lost from all of its copies.  Lines of at least ``MIN_PAGES``
pages only: on a host of a few pages every line is frequent.

``RATIO`` follows measured shares.  On sf0.1 (20 sources of 500 documents) 98 %
of the (source, line) pairs are on one page and 396 of 85,396 on five or more.
The most common sentence is on 8.7 to 13.2 % of a source's pages, the next four
on 1.4 to 4.6 %, so a ratio of 10 % lets one sentence go, and in 12 sources only.
More than 1 % is six pages there, which all of the first five have everywhere.

Scale: lines travel as hashes (the host, 8 bytes of line, 8 bytes of text) and
are made distinct in the tasks before the shuffle; counts are summed likewise,
so a hot host or line costs no more than any other.  Each boilerplate line of a
host is on more than ``RATIO`` of its pages, so a host has at most its mean
number of lines a page / ``RATIO`` of them: one short array a host.  The texts
meet only that table and are not shuffled while Spark broadcasts it.

Defined results: a null text stays null and has no lines; lines without a word
are never dropped; a null host is a host of its own; repeated rows and equal
texts are cleaned alike; a text of boilerplate only becomes empty; an empty
table gives an empty one; other columns are kept untouched under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fincrime.llm.common import WORD, table, whole, written

RATIO = 0.01
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(df: DataFrame, text: str, host: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, bad): hashes of each host's boilerplate lines; hosts without are absent."""
    t = whole(text)
    pages = df.select(F.col(host).alias("host"), F.xxhash64(t).alias("page"), F.array_distinct(F.transform(
        F.filter(_lines(t), lambda x: x.rlike(WORD)), lambda x: F.xxhash64(x))).alias("lines"))
    # the page itself goes along as a line of null: the host's total is its count
    rows = pages.select("host", "page", F.explode(F.concat(F.array(F.lit(None).cast("long")), "lines")).alias("line"))
    counts = written(rows.distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
                         .filter(F.col("line").isNull() | (F.col("n") >= min_pages)), "line-counts")
    totals = counts.filter("line is null").select(F.col("host").alias("h"), F.col("n").alias("total"))
    lines = counts.filter("line is not null")
    return lines.join(totals, lines["host"].eqNullSafe(totals["h"])).filter(F.col("n") > ratio * F.col("total")) \
                .groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("bad"))


def clean(df: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
          min_pages: int = MIN_PAGES) -> DataFrame:
    """``df`` with ``text`` cleaned, and ``__lines_dropped`` (how many)."""
    bad = written(boilerplate(df, text, host, ratio, min_pages), "line-bad") \
        .select(F.col("host").alias("__host"), F.col("bad").alias("__bad"))
    j = df.join(bad, df[host].eqNullSafe(bad["__host"]), "left")
    kept = F.filter(_lines(F.col(text)), lambda x: ~(x.rlike(WORD) & F.array_contains(F.col("__bad"), F.xxhash64(x))))
    j = j.withColumn("__kept", F.when(F.col("__bad").isNotNull(), kept))
    dropped = F.coalesce(F.size(_lines(F.col(text))) - F.size("__kept"), F.lit(0))
    new = F.when(F.col("__kept").isNotNull(), F.array_join("__kept", "\n")).otherwise(F.col(text))
    return j.withColumn("__lines_dropped", dropped.cast("long")) \
            .select(*[new.alias(c) if c == text else F.col(c) for c in df.columns], "__lines_dropped")


def op3(spark, sf_dir: str) -> DataFrame:
    return clean(table(spark, sf_dir, "documents")).select("doc_id", "text", F.col("__lines_dropped").alias("n_dropped"))


def op3_sql() -> str:
    return rf"""
with d as (select row_number() over () as rid, doc_id, source, text, string_split(text, chr(10)) as ls from documents),
l as (select distinct source, coalesce(text, '') as page, unnest(ls) as line from d),
n as (select source, count(distinct coalesce(text, '')) as total from d group by source),
c as (select source, line, count(*) as n from l where regexp_matches(line, '{WORD}') group by source, line),
b as (select c.source, list(line) as bad from c join n on c.source is not distinct from n.source
      where c.n >= {MIN_PAGES} and c.n > {RATIO} * total group by c.source),
k as (select doc_id, text, ls, case when bad is not null
        then list_filter(ls, lambda x: not list_contains(bad, x)) end as kept
      from d left join b on d.source is not distinct from b.source)
select doc_id, case when kept is null then text else coalesce(array_to_string(kept, chr(10)), '') end as text,
  coalesce(len(ls) - len(kept), 0)::bigint as n_dropped from k
"""
