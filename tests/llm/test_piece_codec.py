"""Texts with marks of their own, ids that are none, and the query's rows."""

import random

from fincrime.llm import piece_codec, registry

SF = "/root/testdata/sf0.001"
TEXTS = ["a▁b", "▁", "▁▁ ▁a", " ▁", "a ▁ b▁", "▁" * 70 + "x" * 70, "no mark", " lead", "trail ", "\U0001f600▁é", "", None]


def test_marks_of_the_text_survive(spark):
    rnd = random.Random(2)
    texts = TEXTS + ["".join(rnd.choice("ab ▁é") for _ in range(rnd.randint(1, 120))) for _ in range(100)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    e = piece_codec.encode(d)
    assert {r["doc_id"]: r["text"] for r in piece_codec.decode(e).collect()} == dict(enumerate(texts))
    assert all(r["round_trip"] is (None if texts[r["doc_id"]] is None else True) for r in e.collect())
    with open(piece_codec.MODEL, "rb") as f:
        v = piece_codec.Vocabulary.load(f.read())
    codec = piece_codec.Codec(v)
    assert all(codec.encode(t).tolist() == piece_codec.encode_whole(t, v) for t in texts if t)


def test_ids_that_are_none_decode_to_null(spark):
    rows = [(1, [-1]), (2, [10 ** 6]), (3, [None, 264]), (4, [3 + 0xE2]), (5, []), (6, None), (7, [264])]
    d = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in piece_codec.decode(d).collect()}
    assert [got[i] for i in range(1, 7)] == [None, None, None, None, "", None] and got[7]


def test_query_gives_whole_texts_back(spark):
    want = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = registry.QUERIES["op8_streaming_viterbi"](spark, SF)
    assert {r["doc_id"]: r["text"] for r in piece_codec.decode(out).collect()} == want
    assert out.filter("not round_trip or n_ids <> size(ids)").count() == 0
