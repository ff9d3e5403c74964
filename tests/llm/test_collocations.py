"""Collocations against brute force: languages, nulls, blanks, ties, long texts, covered phrases."""

import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from fincrime.llm import collocations

SCHEMA = "doc_id long, text string, lang string, n long, key long, phrase string, f string, words string, shard string, rank string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, "p", "f", "w", "s", "r") for i, (t, lang) in enumerate(rows)], SCHEMA)


def lower(t):
    return "".join(c.lower() if c < "\x80" else c for c in t or "")


def counts(rows):
    f, n = Counter(), Counter()
    for t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, top=2000, support=10):
    f, n = counts(rows)
    longer = {}
    for (lang, p), c in f.items():
        if len(p) == 3 and c >= support:
            for q in {p[:2], p[1:]}:
                longer[lang, q] = max(longer.get((lang, q), 0), c)
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < support or 100 * longer.get((lang, p), -1) >= 50 * a:
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, l, r, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(lang, k + 1, *x[1:]) for k, x in enumerate(own)]
    return sorted(ranked)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    vocabulary = [f"w{int(r.paretovariate(0.9))}" for _ in range(300)] + ["Été", "漢字", "A", "ß", "-"]
    text = lambda n: "".join(r.choice(vocabulary) + r.choice([" "] * 12 + ["  ", "\t ", ", ", ".\n", "!", " ;", "\r\n"]) for _ in range(n))
    rows = [(text(r.randint(0, 80)), r.choice(["en"] * 5 + ["de", None, "und"])) for _ in range(700)]
    rows += [("New York City is big", "en")] * 30 + [("new york is a b", "en")] * 12 + [("x y x y x y x", "fr")] * 9
    rows += [("  ", "en"), (None, "en"), ("", None), (text(30_000), "en"), ("only here", "rare"), ("aa bb" + " aa bb" * 20, "rare")]
    return rows


def test_equal_to_brute_force(spark, corpus):
    want = brute(corpus)
    assert len({r[0] for r in want}) >= 4
    assert rows_of(collocations.collocations(docs(spark, corpus).repartition(7))) == want
    assert rows_of(collocations.collocations(docs(spark, corpus).coalesce(1), top=5, support=4)) == brute(corpus, 5, 4)


def test_texts_longer_than_a_part(spark, corpus, monkeypatch):
    monkeypatch.setattr(collocations, "PART", 1000)
    monkeypatch.setattr(collocations, "HELD", 500)
    monkeypatch.setattr(collocations, "TEXTS", 50)
    rows = corpus + [("no delimiter in this long piece " * 200 + ". and the end", "en")]
    # the settings reach the tasks, as the package is pickled by value
    assert rows_of(collocations.collocations(docs(spark, rows).repartition(3))) == brute(rows)


def test_full_bitmap_changes_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    assert rows_of(collocations.collocations(docs(spark, corpus))) == brute(corpus)


def test_candidates_miss_no_frequent_phrase(spark, corpus):
    d = docs(spark, corpus).repartition(9)
    exact, totals = collocations.phrase_counts(d)
    f, n = counts(corpus)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in exact.collect()} == {k: c for k, c in f.items() if c >= 10}
    assert {r["lang"]: r["n"] for r in totals.collect()} == {k: c for k, c in n.items() if c}


def test_hashes_tell_order_and_length_apart():
    (one, *_), (two, s, e), (three, *_) = collocations.phrases(b"a b a b\na ab\n", 5 << 40)
    assert [b"a b a b\na ab\n"[i:j] for i, j in zip(s, e)] == [b"a b", b"b a", b"a b", b"a ab"]
    assert two[0] == two[2] and len({*two.tolist()}) == 3 and len({*one.tolist()} | {*two.tolist()} | {*three.tolist()}) == 8
    assert not np.intersect1d(one, next(collocations.phrases(b"a b\n", 6 << 50))[0]).size


def test_products_beyond_64_bits(spark):
    rows = [("en", 2, "u v", 4 * 10**11), ("en", 1, "u", 5 * 10**11), ("en", 1, "v", 7 * 10**11)]
    f = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    n = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    mp = pytest.MonkeyPatch()
    with mp.context() as m:
        m.setattr(collocations, "phrase_counts", lambda *a: (f, n))
        got = rows_of(collocations.collocations(f.withColumnRenamed("phrase", "text")))
    assert got == [("en", 1, "u v", 4 * 10**11, 5 * 10**11, 7 * 10**11, 10**13, 10**6 * 16 * 10**22 // (35 * 10**22))]


def test_empty_table(spark):
    assert rows_of(collocations.collocations(docs(spark, []))) == []


def most_mb(batches):
    """MB that a task holds at most, and that its largest batch has."""
    tracemalloc.start()
    sent = max(b.nbytes for b in batches)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6, sent / 1e6


def many_words(n):
    words = np.random.default_rng(11).integers(0, 50_000, n).astype(str)
    texts = [" ".join(words[i:i + 1000]).encode() for i in range(0, n, 1000)]
    return iter([pa.RecordBatch.from_arrays([pa.array(["en", "de"] * (len(texts) // 2)), pa.array(texts)], ["lang", "t"])])


def test_memory_of_the_first_pass(monkeypatch):
    monkeypatch.setattr(collocations, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    peak, sent = most_mb(collocations._shard_counts(6)(many_words(1_200_000)))
    assert peak < 80 and sent < 4


def test_memory_of_the_second_pass():
    peak, sent = most_mb(collocations._candidate_counts(SimpleNamespace(value=b"\xff" * 8))(many_words(400_000)))
    assert peak < 120 and sent < 8


def test_a_full_buffer_loses_nothing(monkeypatch):
    monkeypatch.setattr(collocations, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 4)))
    want = Counter(k for _, seed, texts in collocations._by_language(next(many_words(4000)))
                   for part in collocations.parts(texts) for keys, _, _ in collocations.phrases(part, seed) for k in keys.tolist())
    monkeypatch.setattr(collocations, "HELD", 1000)
    monkeypatch.setattr(collocations, "SENT", 300, raising=False)
    got = Counter()
    for b in collocations._shard_counts(5)(many_words(4000)):
        for bucket, shard, keys, n in zip(*b.to_pydict().values()):
            keys = np.frombuffer(keys, np.uint64)
            assert shard == 1 and (keys >> np.uint64(57) == bucket).all()
            got.update(dict(zip(keys.tolist(), np.frombuffer(n, np.int32).tolist())))
    assert got == want
