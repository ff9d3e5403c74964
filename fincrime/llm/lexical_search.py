"""Ranked lexical search by presence masks.

The items are a stated query set; all documents are searched for each.  Every
text is read once per block of items: it leaves its length and its occurrences
of the block's terms, from which the corpus counts follow.  A second pass over
these postings ranks.  In each batch of documents bitmap operations give every
document a mask of the item's terms that it holds, and documents of one mask
form a group.  The most that a term adds to any score of the batch, summed over
a mask's terms, bounds the scores of its group.  Masks are evaluated by
descending bound, until the next bound lies below the item's tenth score so far
(equal ones are still evaluated, for the order of ids); the best ten are carried
from batch to batch, so later batches evaluate few groups.  Each task returns
its ten best of each item, and a last step ranks those.

Scale: items come in blocks of about ``BLOCK_TERMS`` terms by hash, so what a
task gets of them has a bound whatever their number; a document's postings hold
an entry for each of the block's terms in it; no text is shuffled.

Defined results: a null or empty text holds no term and is not counted; items
without terms, or whose terms no document has, have no rows; rows of one item id
make one item (null is an id too); each of several rows with one document id is
ranked by itself; equal scores are ranked by ascending id, nulls last; an empty
table on either side gives an empty one; other columns are never read.
Products stay within 64 bits while 90 x terms of a text x documents does.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fincrime.llm.common import table, whole, written

TOP = 10
BLOCK_TERMS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# the same rule for UTF-8 bytes: letters of ASCII in lower case, its other signs as blanks
BYTES = bytes(c if c >= 0x80 or chr(c).isdigit() else ord(chr(c).lower()) if chr(c).isalpha() else 0x20 for c in range(256))
POSTINGS = "n long, terms array<int>, tfs array<int>"


def item_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """(item, term), distinct."""
    lower = F.translate(whole(text), UPPER, LOWER)
    return items.select(F.col(id).alias("item"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), 0)).alias("term")).distinct()


def _reader(vocabulary):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for b in batches:
            lengths, terms, tfs, ends = [], [], [], [0]
            for text in b.column(1):
                words = text.as_py().translate(BYTES).split()
                found = Counter(words)
                held = [w for w in found if w in number]
                lengths.append(len(words))
                terms += [number[w] for w in held]
                tfs += [found[w] for w in held]
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], ["id", "n", "terms", "tfs"])
    return read


class Best:
    """The best documents of an item so far: (-score, id is null, id), in order."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    def offer(self, scores: np.ndarray, ids: Sequence) -> None:
        least = max(1, -self.rows[-1][0] if len(self.rows) == self.top else 1)
        if len(scores) > self.top:
            least = max(least, int(np.partition(scores, -self.top)[-self.top]))
        rows = [(-int(scores[k]), ids[k] is None, ids[k]) for k in np.flatnonzero(scores >= least)]
        # among equal ids the order does not show, and nulls are not compared
        self.rows = sorted(self.rows + rows, key=lambda r: r[:2] + (() if r[1] else r[2:]))[:self.top]

    def beyond(self, bound: int) -> bool:
        """Whether no document of at most this score can come in."""
        return bound <= 0 or len(self.rows) == self.top and bound < -self.rows[-1][0]


def rank_batch(best: Best, terms: np.ndarray, lists: dict, ids: Sequence, docs: int) -> int:
    """Offers ``best`` what a batch has for the item of ``terms``; returns how many masks it evaluated.

    lists: for each term of the batch its rows (ascending), what it adds there, the most of that."""
    held = [lists[t] for t in terms.tolist() if t in lists]
    if not held:
        return 0
    masks = np.zeros((docs, (len(held) + 63) // 64), np.uint64)
    for j, (rows, _, _) in enumerate(held):
        masks[rows, j // 64] |= np.uint64(1 << j % 64)
    bit = lambda m, j: (m[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)
    some = np.flatnonzero(masks.any(axis=1))
    if masks.shape[1] == 1:
        groups, of = np.unique(masks[some, 0], return_inverse=True)
        groups = groups[:, None]
    else:
        groups, of = np.unique(masks[some], axis=0, return_inverse=True)
    bounds = sum(bit(groups, j).astype(np.int64) * most for j, (_, _, most) in enumerate(held))
    order = np.argsort(-bounds, kind="stable")
    by_group = some[np.argsort(of.reshape(-1), kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(of.reshape(-1), minlength=len(groups)))])
    at, step = 0, 1
    while at < len(order) and not best.beyond(int(bounds[order[at]])):
        # more masks at a time as it goes on, of those that can still bring something
        now = [g for g in order[at:at + step] if not best.beyond(int(bounds[g]))]
        rows = np.sort(np.concatenate([by_group[first[g]:first[g + 1]] for g in now]))
        scores = np.zeros(len(rows), np.int64)
        for j, (where, adds, _) in enumerate(held):
            own = np.flatnonzero(bit(masks[rows], j))
            scores[own] += adds[np.searchsorted(where, rows[own])]
        best.offer(scores, [ids[k] for k in rows])
        at, step = at + len(now), step * 2
    return at


def _ranker(query, top: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, n_docs, n_terms = query.value
        best = [Best(top) for _ in items]
        kind = None
        for b in batches:
            kind = b.schema.field("id").type
            ids = b.column(0).to_pylist()
            m = 100 - 90 + (90 * b.column(1).to_numpy() * n_docs) // n_terms
            flat, tf = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy().astype(np.int64)
            rows = np.repeat(np.arange(len(ids)), np.diff(b.column(2).offsets.to_numpy()))
            adds = weights[flat] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[rows]))
            order = np.argsort(flat, kind="stable")
            terms, starts = np.unique(flat[order], return_index=True)
            lists = {t: (rows[o], adds[o], int(adds[o].max())) for t, o in zip(terms.tolist(), np.split(order, starts[1:]))}
            for i, (_, own) in enumerate(items):
                rank_batch(best[i], own, lists, ids, len(ids))
        found = [(k, r[2], -r[0]) for k, b in enumerate(best) for r in b.rows]
        if found:
            k, ids, scores = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(ids, kind), pa.array(scores, pa.int64())],
                                             ["k", "id", "score"])
    return rank


def _search_block(docs: DataFrame, block: list, top: int) -> DataFrame:
    """(k, id, score): the best of each task for the items of one block; k is an item's place in it."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
    kind = dict(docs.dtypes)["id"]
    postings = written(docs.mapInArrow(_reader(spark.sparkContext.broadcast({t.encode(): i for t, i in vocabulary.items()})),
                                       f"id {kind}, {POSTINGS}").filter("n > 0"), "search-postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    items = [(item, np.array([vocabulary[t] for t in terms], np.int64)) for item, terms in block]
    query = spark.sparkContext.broadcast((items, weights, n_docs, max(n_terms, 1)))
    return postings.mapInArrow(_ranker(query, top), f"k int, id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, id, score): each item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    d = docs.select(F.col(id).alias("id"), F.encode(whole(text), "UTF-8").alias("t"))
    terms = written(item_terms(items, item_id, item_text), "search-terms")
    blocks = math.ceil(terms.count() / BLOCK_TERMS)
    item_kind = dict(terms.dtypes)["item"]
    out = spark.createDataFrame([], f"item {item_kind}, rank int, id {dict(d.dtypes)['id']}, score long")
    for number in range(blocks):
        block = terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number) \
                     .groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        if block:
            names = spark.createDataFrame([(k, r["item"]) for k, r in enumerate(block)], f"k int, item {item_kind}")
            found = _search_block(d, [(r["item"], r["terms"]) for r in block], top)
            w = Window.partitionBy("k").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
            found = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
            # as many names as items of the block
            out = out.union(written(found.join(F.broadcast(names), "k").select("item", "rank", "id", "score"), "search-found"))
    return out.select(F.col("item").alias(item_id), "rank", F.col("id").alias(id), "score")


def op12(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_sql() -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return rf"""
with d as (select row_number() over () as rid, doc_id, {words} as ws from documents),
q as (select distinct item_id, unnest({words}) as term from benchmark),
c as (select count(*) as nn, sum(len(ws))::bigint as ll from d where len(ws) > 0),
p as (select rid, doc_id, len(ws) as n, unnest(ws) as term from d),
tf as (select rid, doc_id, n, term, count(*) as tf from p where term in (select term from q) group by rid, doc_id, n, term),
df as (select term, count(*) as df from tf group by term),
s as (select q.item_id, tf.rid, tf.doc_id, sum(floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)))::bigint
        * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll)))))::bigint as score
      from q join tf on q.term = tf.term join df on df.term = q.term, c group by q.item_id, tf.rid, tf.doc_id),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id asc nulls last)::int as rank, doc_id, score
      from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= {TOP}
"""
