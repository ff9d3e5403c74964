"""Equal texts stay together, shards are near equal, and columns may have any name."""

import random
import zlib

from pyspark.sql import functions as F

from fincrime.llm import registry, reshard
from fincrime.llm.common import shared_path

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, shard string, Shard_ int, old string, key long, block string, g string, part int, row string"


def test_equal_texts_are_cut_only_where_one_text_is_too_large(spark):
    """A block that many texts share, each with copies, and one text with a third of all rows."""
    r = random.Random(3)
    rows = [(i, f"text {i % 700} " + "x" * (i % 700 % 90), "s", 1, "o", 2, "b", "g", 3, "r") for i in range(4000)]
    rows += [(10_000 + i, "hot " * 20, "s", 1, "o", 2, "b", "g", 3, "r") for i in range(2000)]
    r.shuffle(rows)
    d = spark.createDataFrame(rows, SCHEMA)
    path = shared_path(spark, "relaid")
    got = reshard.relaid(d, path, old=2, new=4)
    shards = {}
    for x in got.collect():
        shards.setdefault(x["text_crc32"], set()).add(x["shard"])
    hot = zlib.crc32(("hot " * 20).encode())
    assert len(shards[hot]) > 1 and all(len(s) == 1 for crc, s in shards.items() if crc != hot)
    held = [x["b"] for x in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(held) == 4 and max(held) - min(held) <= 0.02 * sum(held)
    # the input's own columns come back, one of them named as the folders would be
    back = reshard.files(spark, d.schema, path)
    assert back.columns == [*d.columns, "shard__"] and {x["shard"] for x in back.select("shard").distinct().collect()} == {"s"}
    assert back.count() == len(rows)


def test_query_keeps_equal_texts_together_and_shards_near_equal(spark):
    got = registry.QUERIES["op4_min_cost_reshard"](spark, SF)
    rows = got.collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items())
    total, of, together = sum(r["size"] for r in rows), {}, {}
    for r in rows:
        of.setdefault(r["shard"], []).append(r)
        together.setdefault(docs[r["doc_id"]], []).append(r)
    held = [sum(r["size"] for r in x) for x in of.values()]
    assert set(of) == set(range(16)) and max(held) - min(held) <= max(r["size"] for r in rows)
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in of.values())
    room = total / 16 / reshard.PART
    assert all(len({r["shard"] for r in x}) == 1 for x in together.values() if sum(r["size"] for r in x) <= room
               and len(x) <= len(rows) / 16 / reshard.PART)
