"""Secret scans with an incremental ledger of blobs.

A blob is a text under its SHA-256.  The ledger is two tables in a folder:
``scanned`` (blob, rule_version) and ``findings`` (blob, rule_version, start,
stop).  ``scan`` content-addresses every version of every path, scans only the
pairs of blob and rule version that the ledger has not seen, appends them, and
joins the findings back to all paths that hold the blob.

Scale: a text is scanned once however many paths hold it.  What to scan is
decided on hashes and ids alone, and the decision meets the texts where they are
read: a bitmap of bounded size (``BITS`` a pair, ``MOST_BITS`` at most) marks the
pairs of id and blob that are not plainly scanned.  A row without a mark is
scanned on the spot; of the marked rows only those that a second bitmap has, of
the pairs which must be scanned and are marked by chance or for some rules only,
are shuffled and joined exactly.  That is one plan at every size; where the
bitmaps fill up, more texts are shuffled (all of them at worst) and the result is
the same.  Findings are a row a blob, few beside the texts.

Defined results: a null text is an empty one; repeated rows and equal texts
have the same findings; rows with a null id are scanned and kept; an empty
table leaves the ledger empty; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fincrime.llm.common import shared_path, table, whole, written


@dataclass(frozen=True)
class Rule:
    """Non-overlapping matches of ``pattern``, leftmost first, whose ``group``
    has ``least`` characters.  ``hints``: lower-case strings of which a text
    must hold one, a cheap test before the pattern."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII
    hints: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        import hashlib
        return f"{self.kind}:{hashlib.sha256(repr((self.pattern, self.group, self.least, int(self.flags))).encode()).hexdigest()[:16]}"


# The three base kinds, in their order; the others are this library's.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=12, flags=re.ASCII | re.IGNORECASE,
         hints=("password", "passwd", "secret", "token", "api_key", "apikey")),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, hints=("akia",)),
    Rule("hex", r"[0-9a-f]{16,}", least=16),          # maximal runs, as [0-9a-f]+ finds them
)
RULES = BASE + (
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)

BITS, MOST_BITS = 16, 1 << 25

FINDINGS = "blob string, rule_version string, start long, stop long"
SCANNED = "blob string, rule_version string"


def spans(text: str, rules: Sequence[Rule]) -> Iterator[tuple[int, int, int]]:
    """(index of the rule, start, end) in code points."""
    low = text.lower() if any(r.hints for r in rules) else ""
    for k, r in enumerate(rules):
        if r.hints and not any(h in low for h in r.hints):
            continue
        for m in re.finditer(r.pattern, text, r.flags):
            if len(m[r.group]) >= r.least:
                yield k, m.start(), m.end()


def _scanner(rules: Sequence[Rule]):
    versions = [r.version for r in rules]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("blob", pa.string()), ("rule_version", pa.string()),
                            ("start", pa.int64()), ("stop", pa.int64())])
        for b in batches:
            rows = [(blob.as_py(), versions[todo[k]], i, j) for blob, text, todo in zip(b.column(0), b.column(1), b.column(2).to_pylist())
                    for k, i, j in spans(text.as_py(), [rules[x] for x in todo])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, schema.types)],
                                             schema=schema)
    return scan


def _ledger(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A table of the ledger; before the first scan it is empty."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def _bitmap(pairs: DataFrame) -> DataFrame:
    """A bit for the hash ``h`` of each pair, as (size, word, bits); no row has a word without bits."""
    size = min(MOST_BITS, 1 << max(6, math.ceil(math.log2(max(1, pairs.count()) * BITS))))
    slot = F.col("h").bitwiseAND(F.lit(size - 1))
    bits = pairs.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("b")) \
                .groupBy("word").agg(F.bit_or("b").alias("bits"))
    return written(bits.select(F.lit(size).alias("size"), "word", "bits"), "secret-bitmap")


def _marked(rows: DataFrame, bitmap: DataFrame, keep: bool = True) -> DataFrame:
    """``rows`` whose ``h`` has a bit (``keep=False``: has none).  A bitmap has at most MOST_BITS / 64 rows."""
    size = bitmap.agg(F.coalesce(F.max("size"), F.lit(64))).first()[0]
    word = F.shiftright(F.col("h").bitwiseAND(F.lit(size - 1)), 6)
    j = rows.join(F.broadcast(bitmap.drop("size")), word == F.col("word"), "left")
    bit = F.coalesce(F.expr("shiftrightunsigned(bits, cast(h & 63 as int)) & 1L"), F.lit(0))
    return j.filter(bit == (1 if keep else 0)).drop("word", "bits")


def scan(versions: DataFrame, ledger: str, id: str = "doc_id", text: str = "text",
         rules: Sequence[Rule] = RULES) -> DataFrame:
    """Brings the ledger up to date with ``versions`` (one row a path and
    version, ``id`` naming it) and returns a row for each with its findings:
    (id, blob, found: array of (start, rank, kind, stop))."""
    spark = versions.sparkSession
    # 1. content addresses; two small columns, read from here on in place of the texts
    ids = written(versions.select(F.col(id).alias("id"), F.sha2(whole(text), 256).alias("blob")), "secret-blobs")

    # 2. pairs of blob and rule version that nobody has scanned
    held = _ledger(spark, ledger, "scanned", SCANNED)
    current = [r.version for r in rules]
    seen = held.filter(F.col("rule_version").isin(current)).groupBy("blob") \
               .agg(F.collect_set("rule_version").alias("seen"))        # as many as rules at most
    blobs = ids.groupBy("blob").agg(F.min("id").alias("first"))
    todo = F.filter(F.sequence(F.lit(0), F.lit(len(rules) - 1)), lambda k: ~F.array_contains(
        F.coalesce("seen", F.array().cast("array<string>")), F.get(F.array(*map(F.lit, current)), k)))
    blobs = written(blobs.join(seen, "blob", "left").select("blob", "first", todo.alias("todo")), "secret-todo")

    # 3. the decision for each pair of id and blob: which rules, if any
    b = blobs.select(F.col("blob").alias("b"), "first", "todo")
    pairs = written(ids.join(b, ids["blob"] == b["b"]).select("id", "blob", F.xxhash64("id", "blob").alias("h"), F.when(
        F.col("id") != F.col("first"), F.array().cast("array<int>")).otherwise(F.col("todo")).alias("todo")).distinct(), "secret-pairs")
    marks = _bitmap(pairs.filter(F.size("todo") < len(rules)))          # skipped, or scanned for some rules
    listed = written(_marked(pairs.filter(F.size("todo") > 0), marks), "secret-listed")
    lists = _bitmap(listed)

    # 4. rows without a mark here and now; of the others those that are listed
    t = versions.select(F.col(id).alias("id"), whole(text).alias("t"), F.sha2(whole(text), 256).alias("blob")) \
                .withColumn("h", F.xxhash64("id", "blob"))
    plain = _marked(t, marks, keep=False).select("blob", "t", F.array(*map(F.lit, range(len(rules)))).alias("todo"))
    some = _marked(_marked(t, marks), lists).alias("s")
    x = listed.alias("x").hint("merge")
    some = some.join(x, F.col("s.id").eqNullSafe(F.col("x.id")) & (F.col("s.blob") == F.col("x.blob"))) \
               .select("s.blob", "s.t", "x.todo")
    new = plain.mapInArrow(_scanner(rules), FINDINGS).union(some.mapInArrow(_scanner(rules), FINDINGS)).distinct()
    # findings first: if the run dies between the two, the pairs are scanned again and found twice, which
    # distinct() below takes back
    new.write.mode("append").parquet(f"{ledger}/findings")
    blobs.select("blob", F.explode("todo").alias("k")) \
         .select("blob", F.get(F.array(*map(F.lit, current)), F.col("k")).alias("rule_version")) \
         .write.mode("append").parquet(f"{ledger}/scanned")

    # 5. findings back to all paths
    # of the current versions only: what an older form of a rule found stays in the ledger, not in the result
    rank = F.array_position(F.array(*map(F.lit, current)), F.col("rule_version")).cast("int") - 1
    kind = F.get(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank"))
    found = _ledger(spark, ledger, "findings", FINDINGS).filter(F.col("rule_version").isin(current)).distinct() \
        .withColumn("rank", rank).withColumn("kind", kind).groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "stop"))).alias("found"))
    found = written(found.join(ids.select("blob").distinct(), "blob", "left_semi"), "secret-found")
    f = found.select(F.col("blob").alias("b"), "found")
    none = F.array().cast(T.ArrayType(T.StructType.fromDDL("start long, rank int, kind string, stop long")))
    return ids.join(f, ids["blob"] == f["b"], "left") \
              .select(F.col("id").alias(id), "blob", F.coalesce("found", none).alias("found"))


def _joined(found) -> F.Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def op1(spark, sf_dir: str) -> DataFrame:
    """Two commits of the corpus into a new ledger: half of the documents by a
    hash, then all; the second scans only blobs that the ledger has not seen."""
    docs, ledger = table(spark, sf_dir, "documents"), shared_path(spark, "secret-ledger")
    scan(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), ledger)
    d = scan(docs, ledger)
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    return d.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                    count("hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
                    _joined(F.col("found")).alias("spans"), "blob")
