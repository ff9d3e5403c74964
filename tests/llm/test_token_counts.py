"""Prefix token counts against the library that the vocabulary is for."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from fincrime.llm import registry, token_counts

SCHEMA = "doc_id long, text string, id string, t string, n_bytes string, n_tokens string, prefix_tokens string"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=token_counts.MODEL)
TEXTS = [None, "", " ", "  a  b ", "a\n\nb\t c", "<s> </s> <unk> <0x0A>", "a▁b", "é\U0001f600 ﬁ \0 x", "12,345.67", "x" * 300, " " * 90,
         "\U0001f600" * 61, "Der Überblick – c’est l’été: ¡mañana! 漢字"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y", "z", "n", "p") for i, t in enumerate(texts)], SCHEMA)


def odd_texts(n):
    r = random.Random(7)
    return ["".join(r.choice("ab é_=-\n\U0001f600  \t1٣²漢ǅ▁ther in") for _ in range(r.randint(0, 90))) for _ in range(n)]


def tokens(text):
    return len(LIBRARY.encode(text or ""))


def test_totals_equal_the_library(spark):
    texts = TEXTS + odd_texts(200) + ["word " * 30_000, "word " * 30_000]
    got = {r["doc_id"]: r for r in token_counts.counts(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert (got[i]["n_bytes"], got[i]["n_tokens"]) == (len((t or "").encode()), tokens(t)), t and t[:50]
    assert token_counts.counts(docs(spark, [])).count() == 0


def test_every_prefix_and_the_questions(spark):
    texts = TEXTS + odd_texts(30)
    stored = token_counts.prefixes(docs(spark, texts)).withColumn("at_5", token_counts.tokens_at(F.lit(5))) \
        .withColumn("within_4", token_counts.longest_within(F.lit(4)))
    cut = {r["doc_id"]: r["text"] for r in token_counts.truncate(stored, 4).collect()}
    for r in stored.collect():
        t = texts[r["doc_id"]] or ""
        want = [tokens(t[:i]) for i in range(len(t) + 1)]
        assert r["prefix_tokens"] == want and r["at_5"] == want[min(5, len(t))]
        assert r["within_4"] == max(i for i, n in enumerate(want) if n <= 4)
        assert cut[r["doc_id"]] == (None if texts[r["doc_id"]] is None else t[:r["within_4"]])


def test_walks_agree_and_tables_stay_bounded(monkeypatch):
    with open(token_counts.MODEL, "rb") as f:
        counter = token_counts.Counter.load(f.read())
    monkeypatch.setattr(token_counts, "PART", 300)
    monkeypatch.setattr(token_counts, "KEPT", 60)
    monkeypatch.setattr(token_counts, "PAIRS", 40)
    texts = odd_texts(300)
    assert counter.totals(texts) == [tokens(t) for t in texts]
    assert len(counter) == len(counter.total) <= 60 + 300
    for s, c in dict(counter).items():
        assert list(c) == list(counter.walk(s))


@pytest.mark.parametrize("pieces, cut", [(["▁", "a", "b", "ab", "▁ab", "a▁b"], False), (["▁", "a", "b", "ab"], True)])
def test_vocabulary_whose_pieces_hold_marks_inside(pieces, cut):
    counter = token_counts.Counter([(p, -float(i)) for i, p in enumerate(pieces)])
    assert (counter.cut is not None) == cut
    for t in ("ab ab", "a b", "ba ab b"):
        assert counter.totals([t]) == [len(counter.merged("▁" + t.replace(" ", "▁")))]


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    want = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = registry.QUERIES["op13_prefix_token_counts"](spark, sf).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == \
        {i: (len(t.encode()), tokens(t), tokens(t) > 4096) for i, t in want.items()} and len(got) == len(want)
