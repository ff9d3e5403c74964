"""Phrase collocations by SON partitioning.

A text in lower case (A-Z) is split into pieces at punctuation and line ends and
those into words; phrases are runs of words of one piece.  Everything is counted
per language.

1. The corpus is dealt into ``SHARDS`` shards.  Each is mined completely for
   phrases at a local support of ceil(support / SHARDS): a phrase below it in
   every shard is below the support in the corpus.  Phrases go by 62 bits of a
   hash here, so a task sends 8 bytes a phrase and nothing is missed: two phrases
   of one hash only make each other more frequent.
2. The locally frequent hashes of all shards are united; those that reach the
   support over all shards stay.
3. A second pass counts the candidates globally and exactly, by their text.  A
   bitmap of the candidates' hashes (``BITS`` a candidate, ``MOST_BITS`` at most)
   keeps most of the others from being sent; where it lets one pass, the count by
   text decides.

Parts of a frequent phrase are at least as frequent as it, so the same table of
counts has all parts.  Scores and the test for longer phrases are joins of that
table with itself; integers of 38 digits keep products exact.

Scale: counts are summed in the tasks, over ``HELD`` phrases, before each
shuffle; hashes and phrases spread over all tasks whatever the language, so a
hot language or phrase costs no more than any other.  Hashes travel packed by
bucket, and there is a bucket for each ``BUCKET_BYTES`` of text: what a bucket
holds does not grow with the corpus.  The best phrases of a language are found in
``BUCKETS`` parts first.

Memory of a task: the batch it was given, ``PART`` bytes of it at work (some 50
bytes each), and either one array of ``HELD`` hashes, sorted in place, or ``TEXTS``
texts; it sends ``SENT`` phrases at a time, so neither side holds more of them.

Defined results: a null or empty text has no words; a null language counts as
``und``; words are separated by runs of blanks, phrases are given with single
ones; repeated rows count each; languages without candidates have no rows; an
empty table gives an empty one; other columns are never read.  A piece is held
whole in a task, a text is not.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fincrime.llm.common import table, whole, written

SUPPORT = 10
WORDS = 3
SHARDS = 3
COVER_PERCENT = 50
TOP = 2000
BUCKETS = 64
PART = 300_000               # bytes of text that are hashed together
HELD = 3_000_000             # phrases that a task holds before it sums and sends them
SENT = 100_000               # phrases that a task sends at a time
BUCKET_BYTES = 2_000_000     # bytes of text whose phrases' counts are added up together
TEXTS = 200_000              # candidates' texts that a task holds before it sends their counts
BITS, MOST_BITS = 16, 1 << 27
KEY = np.uint64((1 << 62) - 1)
DELIMITER = re.compile(rb"[.,;:!?\x0A-\x0D]")
# bytes by kind: 0 of a word, 1 blank, 2 between pieces; line 2 is where texts end, too
KIND = np.array([2 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 1 if c in b" \t" else 0 for c in range(256)], np.uint8)
BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The bits of each number spread over all of it."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of BASE and of its inverse, as far as they were asked for."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grow = lambda b: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]))
            self.up, self.down = grow(BASE), grow(np.uint64(pow(int(BASE), -1, 1 << 64)))
        return self.up, self.down


_powers = Powers()


def parts(texts: Iterable[bytes]) -> Iterator[bytes]:
    """The texts in lower case, each followed by a line end, put together to about PART bytes;
    longer ones are cut between pieces."""
    held, size = [], 0
    for t in texts:
        lo = 0
        while len(t) - lo > PART:
            cut = max(t.rfind(d, lo, lo + PART) for d in (b".", b",", b";", b":", b"!", b"?", b"\n", b"\x0b", b"\x0c", b"\r"))
            if cut < 0:
                found = DELIMITER.search(t, lo + PART)
                cut = found.start() if found else len(t) - 1
            yield t[lo:cut + 1].lower() + b"\n"
            lo = cut + 1
        held.append(t[lo:])
        size += len(t) - lo + 1
        if size >= PART:
            yield b"\n".join(held).lower() + b"\n"
            held, size = [], 0
    if held:
        yield b"\n".join(held).lower() + b"\n"


def phrases(part: bytes, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For one, two, ... words: hashes of all phrases, and where they start and end."""
    data = np.frombuffer(part, np.uint8)
    kind = KIND[data]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers.to(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])])
    word = _mix((sums[ends] - sums[starts]) * down[starts] + np.uint64(seed))
    piece = np.concatenate([[0], np.cumsum(kind == 2)])[starts]
    at, key = np.arange(len(starts)), word
    for n in range(1, WORDS + 1):
        if n > 1:
            at = at[at + n - 1 < len(starts)]
            at = at[piece[at] == piece[at + n - 1]]
            key = chained[at] + word[at + n - 1]
        yield _mix(key + np.uint64(n)) & KEY, starts[at], ends[at + n - 1]
        chained = np.zeros(len(starts), np.uint64)
        chained[at] = _mix(key) * np.uint64(0xD6E8FEB86659FD93)


def _by_language(b: pa.RecordBatch) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """Each language of a batch with a seed and its texts, which leave the batch one by one."""
    import hashlib
    langs, texts = b.column(0).dictionary_encode(), b.column(1)
    codes = langs.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(1, len(langs.dictionary)))
    for lang, own in zip(langs.dictionary.to_pylist(), np.split(order, cuts)):
        yield lang, int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"), (texts[i].as_py() for i in own.tolist())


def _shard_counts(bits: int):
    """(bucket, shard, keys, n): occurrences of phrases by hash, those of one bucket (the
    hash's first ``bits`` bits) packed in a row; the shard is the task's."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % SHARDS
        held, size = np.empty(HELD, np.uint64), 0

        def packed(own: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            keys, n = own[starts], np.diff(np.append(starts, len(own)))
            bucket, first = np.unique(keys >> np.uint64(62 - bits), return_index=True)
            ends = np.append(first, len(keys))
            binary = lambda x, width: pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(x)])
            return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(np.full(len(first), shard, np.int8)),
                                               binary(keys, 8), binary(n.astype(np.int32), 4)], ["bucket", "shard", "keys", "n"])

        def summed() -> Iterator[pa.RecordBatch]:
            held[:size].sort()
            for lo in range(0, size, SENT):
                yield packed(held[lo:min(lo + SENT, size)])

        for b in batches:
            for _, seed, texts in _by_language(b):
                for part in parts(texts):
                    for keys, _, _ in phrases(part, seed):
                        while len(keys):
                            some, keys = keys[:HELD - size], keys[HELD - size:]
                            held[size:size + len(some)] = some
                            size += len(some)
                            if size == HELD:
                                yield from summed()
                                size = 0
        yield from summed()
    return count


def _union(local: int, support: int):
    """The keys of a bucket that reach ``local`` in a shard and ``support`` over all shards."""
    def unite(bucket: pa.Table) -> pa.Table:
        unpack = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in bucket.column(name)])
        keys, n = unpack("keys", np.uint64), unpack("n", np.int32).astype(np.int64)
        shard = np.repeat(bucket.column("shard").to_numpy(), [len(x.as_buffer()) // 8 for x in bucket.column("keys")])
        order = np.argsort(keys, kind="stable")
        keys, n, shard = keys[order], n[order], shard[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        most = np.max([np.add.reduceat(np.where(shard == s, n, 0), starts) for s in range(SHARDS)], axis=0)
        keep = (most >= local) & (np.add.reduceat(n, starts) >= support)
        return pa.table({"key": keys[starts[keep]].view(np.int64)})
    return unite


def _texts(part: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """Each text of the phrases from ``starts`` to ``ends`` with a count.

    Phrases of one hash are counted together if their bytes equal those of the first; the
    rest (other blanks between words, or a collision) one by one."""
    data, size = np.frombuffer(part, np.uint8), ends - starts
    _, first, of = np.unique(keys, return_index=True, return_inverse=True)
    example = first[of]
    same = size == size[example]
    by_size = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[by_size])) + 1
    for own in np.split(by_size, cuts):
        own = own[same[own] & (example[own] != own)]
        if len(own):
            span = np.arange(size[own[0]])
            for lo in range(0, len(own), 1 + 500_000 // len(span)):
                some = own[lo:lo + 1 + 500_000 // len(span)]
                same[some] = (data[starts[some, None] + span] == data[starts[example[some], None] + span]).all(axis=1)
    n = np.bincount(of[same], minlength=len(first))
    yield from zip([part[i:j] for i, j in zip(starts[first].tolist(), ends[first].tolist())], n.tolist())
    yield from ((part[i:j], 1) for i, j in zip(starts[~same].tolist(), ends[~same].tolist()))


def _candidate_counts(bitmap):
    """(lang, words, phrase, n): occurrences of the candidates that the bitmap lets pass, by text;
    a row without a phrase has the number of all words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        mask = np.uint64(len(bits) * 8 - 1)
        held: dict[tuple[str, int], dict[bytes, int]] = {}
        total: Counter = Counter()

        def rows(found: list) -> pa.RecordBatch:
            cols = list(zip(*found)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.int64()))],
                                              ["lang", "words", "phrase", "n"])

        def flushed() -> Iterator[pa.RecordBatch]:
            # single blanks; what differs in blanks only is summed by the group that follows
            found = ((lang, k, b" ".join(t.split()).decode(), n) for (lang, k), texts in held.items() for t, n in texts.items())
            while some := list(islice(found, SENT)):
                yield rows(some)
            held.clear()

        for b in batches:
            for lang, seed, texts in _by_language(b):
                for part in parts(texts):
                    for k, (keys, starts, ends) in enumerate(phrases(part, seed), 1):
                        if k == 1:
                            total[lang] += len(keys)
                        slot = keys & mask
                        own = np.flatnonzero(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                        if len(own):
                            into = held.setdefault((lang, k), {})
                            for t, n in _texts(part, starts[own], ends[own], keys[own]):
                                into[t] = into.get(t, 0) + n
                    if sum(map(len, held.values())) >= TEXTS:
                        yield from flushed()
        yield from flushed()
        yield rows([(lang, 0, None, n) for lang, n in total.items() if n])
    return count


def candidates(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(key): hashes of phrases that are frequent in a shard and reach the support over all."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    bits = min(30, max(4, math.ceil(math.log2(max(1, size) / BUCKET_BYTES))))
    counts = docs.mapInArrow(_shard_counts(bits), "bucket int, shard byte, keys binary, n binary")
    # one shuffle serves both steps: a hash's counts of all shards are in one bucket
    return counts.groupBy("bucket").applyInArrow(_union(math.ceil(support / SHARDS), support), "key long")


def _bitmap(keys: DataFrame) -> bytes:
    """A bit for each key, in 8 bytes to MOST_BITS / 8."""
    size = min(MOST_BITS, 1 << max(6, math.ceil(math.log2(max(1, keys.count()) * BITS))))
    slot = F.col("key").bitwiseAND(F.lit(size - 1))
    words = keys.select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("b")) \
                .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return bits.tobytes()


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """Exact counts f of all phrases with f >= support: (lang, words, phrase, f); and (lang, n), all words."""
    docs = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.encode(whole(text), "UTF-8").alias("t"))
    keys = written(candidates(docs, support), "phrase-keys")
    bitmap = df.sparkSession.sparkContext.broadcast(_bitmap(keys))
    counts = docs.mapInArrow(_candidate_counts(bitmap), "lang string, words int, phrase string, n long") \
                 .groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    counts = written(counts.filter((F.col("words") == 0) | (F.col("f") >= support)), "phrase-counts")
    return counts.filter("words > 0"), counts.filter("words = 0").select("lang", F.col("f").alias("n"))


def _part(words: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT,
                 top: int = TOP, cover_percent: int = COVER_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases that no longer one covers."""
    counts, totals = phrase_counts(df, text, lang, support)
    w = F.split("phrase", " ")
    long = counts.filter("words > 1")

    # the most frequent longer phrase around each phrase
    inner = F.expr("flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), i -> struct(k, i))))")
    around = long.filter("words > 2").withColumn("w", w).select("lang", "f", "w", F.explode(inner).alias("s")) \
                 .select(F.col("lang").alias("cl"), _part(F.col("w"), F.col("s.i"), F.col("s.k")).alias("cp"), "f") \
                 .groupBy("cl", "cp").agg(F.max("f").alias("longer"))
    left = long.join(around, (F.col("lang") == F.col("cl")) & (F.col("phrase") == F.col("cp")), "left") \
               .filter(F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("f"))) \
               .select("lang", "phrase", "words", F.col("f").alias("a"))

    # each cut's parts and their counts
    cuts = left.withColumn("w", w).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("p", _part(F.col("w"), F.lit(1), F.col("k"))) \
               .withColumn("q", _part(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")))
    f = counts.select(F.col("lang").alias("fl"), F.col("phrase").alias("fp"), "f")
    cuts = cuts.join(f, (F.col("lang") == F.col("fl")) & (F.col("p") == F.col("fp"))).withColumnRenamed("f", "l").drop("fl", "fp")
    cuts = cuts.join(f, (F.col("lang") == F.col("fl")) & (F.col("q") == F.col("fp"))).withColumnRenamed("f", "r").drop("fl", "fp")
    big = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products have 38 digits
    above, below = (big("a") * big("a")).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)"), big("l") * big("r")
    cuts = cuts.withColumn("above", above.cast("decimal(38,0)")).withColumn("below", below) \
               .withColumn("score", F.expr("above div below").cast("long"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    best = best.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = Window.partitionBy("lang", "bucket").orderBy(*order)
    some = best.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))) \
               .withColumn("rn", F.row_number().over(part)).filter(F.col("rn") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
                 .filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op11_sql() -> str:
    return rf"""
with d as (select row_number() over () as rid, coalesce(lang, 'und') as lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
           from documents),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from d),
n as (select lang, sum(len(w))::bigint as n from p group by lang),
g as (select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase
      from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i
            from p, (values (1), (2), (3)) as s(k) where len(w) >= k)),
f as (select lang, k, phrase, count(*) as f, string_split(phrase, ' ') as w from g group by lang, k, phrase having count(*) >= {SUPPORT}),
c as (select lang, array_to_string(list_slice(w, i, i + 1), ' ') as phrase, max(f) as longer
      from f, (values (1), (2)) as s(i) where k = 3 group by 1, 2),
a as (select f.lang, f.phrase, f.k, f.f as a, f.w from f left join c on f.lang = c.lang and f.phrase = c.phrase
      where f.k > 1 and (longer is null or f.k = 3 or 100 * longer < {COVER_PERCENT} * f.f)),
u as (select a.*, s.i, array_to_string(list_slice(w, 1, s.i), ' ') as x, array_to_string(list_slice(w, s.i + 1, k), ' ') as y
      from a, (values (1), (2)) as s(i) where s.i < k),
s as (select u.lang, u.phrase, u.a, u.i, l.f as l, r.f as r, ((1000000::hugeint * u.a * u.a) // (l.f::hugeint * r.f))::bigint as score
      from u join f l on l.lang = u.lang and l.phrase = u.x join f r on r.lang = u.lang and r.phrase = u.y),
m as (select *, row_number() over (partition by lang, phrase order by score, i) as least from s),
o as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score from m where least = 1)
select o.lang, rank, phrase, a, l, r, n, score from o join n on o.lang = n.lang where rank <= {TOP}
"""
