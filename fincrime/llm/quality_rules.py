"""Quality rules: a threshold table compiled into projections.

Each rule is a ratio of two measures of a text with a lower or an upper bound.
``verdicts`` turns the table into built-in expressions only: no user function,
no shuffle, one pass over the texts.

Defined results: a null text counts as empty; an empty text has zero measures
and fails the base rule; a ratio with a zero denominator is null and passes
its rule; repeated rows are judged each on its own; columns of the input are
never read but ``id`` and ``text``, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fincrime.llm.common import BLANKS, WORD, whole

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of the four languages, lower case.
STOP_WORDS = ("the of and to in is was that for be with as it at by from this are on or an he not "
              "der die das und ist nicht zu den mit ein eine von im auf für sich dem des "
              "de la le et les en un une du que qui dans pour sur est pas ne au "
              "el los las del y por con una se su para al como es no lo").split()


@dataclass(frozen=True)
class Rule:
    """``low <= top / bottom <= high``; a bound of None is open."""

    name: str
    top: str
    bottom: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        ratio = F.try_divide(F.col(self.top).cast("double"), F.col(self.bottom).cast("double"))
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (ratio >= self.low)
        if self.high is not None:
            ok = ok & (ratio <= self.high)
        return F.coalesce(ok, F.lit(True))


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols", "n_symbols", "n_words", high=0.10),
    Rule("exclamations", "n_exclaim", "n_words", high=0.30),
    Rule("stop_words", "n_stop", "n_words", low=0.04),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.70),
)


def _only(text: Column, kept: str) -> Column:
    """Characters of the class ``kept`` in the text."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def measured(df: DataFrame, id: str | Column, text: str) -> DataFrame:
    """``id`` with the measures of each whole text."""
    t = F.col("t")
    d = df.select((F.col(id) if isinstance(id, str) else id).alias("id"), whole(text).alias("t"))
    d = d.select("id", "t", F.array_remove(F.split(t, BLANKS), "").alias("words"),
                 F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    d = d.select(
        "id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _only(t, "#*$%&|<>").alias("n_symbols"), _only(t, "!").alias("n_exclaim"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS)))
         .cast("long").alias("n_stop"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    # one 64-bit hash per window, by doubling: words, then pairs, fours and eights
    d = d.withColumn("h2", F.transform("h1", lambda x, i: F.xxhash64(x, F.get("h1", i + 1))))
    d = d.withColumn("h4", F.transform("h2", lambda x, i: F.xxhash64(x, F.get("h2", i + 2))))
    d = d.withColumn("hashes", F.transform(F.slice("h4", F.lit(1), F.greatest(F.size("h4") - (WINDOW - 1), F.lit(0))),
                                           lambda x, i: F.xxhash64(x, F.get("h4", i + 4))))
    # windows that have an equal: neighbours of the sorted hashes; most texts have none
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    d = d.withColumn("sorted", F.when(repeats, F.sort_array(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    h = lambda j: F.get("sorted", j)["h"]
    d = d.withColumn("starts", F.sort_array(F.transform(
        F.filter("sorted", lambda e, j: (e["h"] == h(j - 1)) | (e["h"] == h(j + 1))), lambda e: e["i"])))
    # words under the union of those windows: each adds the distance to the next start, at most its length
    added = F.transform("starts", lambda v, j: F.least(
        F.coalesce(F.get("starts", j + 1) - v, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(added, F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select("id", "n_words", "word_chars", "n_symbols", "n_exclaim", "n_lines", "n_dup_lines", "n_stop",
                    F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def verdicts(df: DataFrame, id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``df``: measures, ``base_failed``, a column
    ``passes_<rule>`` for each rule, and ``kept``."""
    passed = {f"passes_{r.name}": r.passes() for r in rules}
    kept = ~base_failed()
    for ok in passed.values():
        kept = kept & ok
    d = measured(df, id, text).select(
        "*", base_failed().alias("base_failed"), *[c.alias(k) for k, c in passed.items()], kept.alias("kept"))
    return d.withColumnRenamed("id", id)


def kept_rows(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``df`` that are kept, with their columns; rows go through as
    a whole, so they need no key and no join."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    kept = ~base_failed()
    for r in rules:
        kept = kept & r.passes()
    # a row number in the projection keeps the filter above it: pushed below, it would repeat each measure
    m = measured(df, row, text).withColumn("nth", F.monotonically_increasing_id())
    return m.filter(kept & (F.col("nth") >= 0)).select("id.*")


def op10(spark, sf_dir: str) -> DataFrame:
    from fincrime.llm.common import table

    return verdicts(table(spark, sf_dir, "documents"))


def op10_sql(rules: Sequence[Rule] = RULES) -> str:
    words = "', '".join(sorted(set(STOP_WORDS)))
    tests = []
    for r in rules:
        bounds = [f"{r.top}::double / nullif({r.bottom}, 0) >= {r.low}"] * (r.low is not None) \
            + [f"{r.top}::double / nullif({r.bottom}, 0) <= {r.high}"] * (r.high is not None)
        tests.append(f"coalesce({' and '.join(bounds)}, true) as passes_{r.name}")
    return rf"""
with t as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (select rid, doc_id, t, regexp_extract_all(t, '{WORD}') as ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as ls from t),
win as (select rid, i, ws[i:i + {WINDOW - 1}] as g from w, unnest(range(1, len(ws) - {WINDOW - 2})) as u(i)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from win) where c >= 2),
cov as (select rid, count(distinct i + k) as n from rep, unnest(range(0, {WINDOW})) as v(k) group by rid),
m as (select doc_id, len(ws)::bigint as n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        length(regexp_replace(t, '[^!]+', '', 'g'))::bigint as n_exclaim,
        len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
        len(list_filter(ws, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', '')) in ('{words}')))::bigint as n_stop,
        coalesce(n, 0)::bigint as n_repeat_words
      from w left join cov using (rid)),
v as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
        {', '.join(tests)} from m)
select *, not base_failed and {' and '.join(f'passes_{r.name}' for r in rules)} as kept from v
"""
