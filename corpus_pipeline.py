"""A corpus pipeline of five of the operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result to the cluster's shared folder and reads it back as the next
one's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fincrime.llm import dart_minhash, line_dedup, mixing, piece_codec, quality_rules
from fincrime.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go.  Rules judge rows, so nothing is joined."""
    return quality_rules.kept_rows(docs, "text").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; n_chars follows the text."""
    return line_dedup.clean(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id; of its
    repeated rows one."""
    kept = dart_minhash.near_duplicates(docs).filter("kept").select("doc_id", "digest")
    again = written(kept.groupBy("doc_id", "digest").agg(F.count("*").alias("n")), "pipeline-kept")
    out = docs.withColumn("digest", F.md5(F.coalesce("text", F.lit("")))).alias("d")
    k = again.alias("k")
    out = out.join(k, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.digest") == F.col("k.digest"))) \
             .select(*[F.col(f"d.{c}") for c in COLUMNS])
    return out.dropDuplicates(["doc_id", "text"]) if again.filter("n > 1").head(1) else out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes as often as the mix takes it."""
    copies = mixing.mix(docs).select("h", "source", "copies").filter("copies > 0").distinct().alias("m")
    d = docs.withColumn("h", mixing.hash_with_text("doc_id", "text")).alias("d")
    j = d.join(copies, (F.col("d.h") == F.col("m.h")) & F.col("d.source").eqNullSafe(F.col("m.source")))
    return j.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col(f"d.{c}") for c in COLUMNS])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return piece_codec.encode(docs).withColumn("n_ids", F.size("ids"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("minhash near-dedup", near_duplicates),
    ("source mixing", mixture),
    ("piece encoding", pieces),
]

# MinHash and piece encoding have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
