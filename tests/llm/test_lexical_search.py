"""Ranked search against brute force: nulls, ties, repeated rows and ids, items of more than 64 terms."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fincrime.llm import lexical_search

DOCS = "doc_id long, text string, item_id string, rank string, id string, t string, n string, terms string, score string"
ITEMS = "item_id long, text string, doc_id string, k string, term string, id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e", "f", "g") for i, t in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], ITEMS)


def words(t):
    return re.findall(lexical_search.TERM, "".join(c.lower() if c < "\x80" else c for c in t or ""))


def brute(docs, items, top=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    query = {}
    for i, t in items:
        query.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in query.items():
        found = []
        for i, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                        for w in terms if w in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    vocabulary = [f"w{int(r.paretovariate(0.6))}" for _ in range(400)] + ["Été", "漢字", "é\U0001f600"]
    text = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", ",", ".\n", "-x"]) for _ in range(n))
    d = [(i, text(r.randint(1, 60))) for i in range(500)]
    d += [(1000 + i, d[3][1]) for i in range(40)] + [(7, d[7][1]), (7, "w1 other"), (None, d[3][1]), (None, None), (600, None), (601, ""), (602, " .,")]
    d += [(700, text(20_000)), (701, "W1 w1 W2 été ÉTÉ")]
    q = [(i, text(r.randint(1, 40))) for i in range(30)] + [(50, None), (51, ""), (52, "nowhere to be found"), (53, d[3][1]),
                                                          (54, " ".join(sorted(set(vocabulary)))), (55, "w1"), (55, "w2 été"), (None, "w5 w6")]
    return d, q


def test_equal_to_brute_force(spark, corpus):
    d, q = corpus
    want = brute(d, q)
    assert rows(lexical_search.search(docs(spark, d).repartition(5), items(spark, q))) == want
    assert rows(lexical_search.search(docs(spark, d).repartition(3), items(spark, q), top=3)) == brute(d, q, 3)


def test_blocks_of_items(spark, corpus, monkeypatch):
    d, q = corpus
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 150)
    assert rows(lexical_search.search(docs(spark, d[:80]), items(spark, q))) == brute(d[:80], q)


def test_empty_tables(spark, corpus):
    d, q = corpus
    assert rows(lexical_search.search(docs(spark, []), items(spark, q))) == []
    assert rows(lexical_search.search(docs(spark, d), items(spark, []))) == []
    assert rows(lexical_search.search(docs(spark, [(1, None)]), items(spark, q))) == []


def test_masks_below_the_tenth_score_are_not_evaluated():
    """200 documents hold all terms, 1,800 hold one of 15: their masks stay untouched."""
    n, terms = 2000, np.arange(16)
    lists = {}
    for t in range(16):
        where = np.array([k for k in range(n) if k < 200 or k % 16 == t])
        lists[t] = (where, np.full(len(where), 100, np.int64), 100)
    best = lexical_search.Best(10)
    assert lexical_search.rank_batch(best, terms, lists, list(range(n)), n) == 1
    assert [(-s, i) for s, _, i in best.rows] == [(1600, i) for i in range(10)]
    assert lexical_search.rank_batch(best, terms, {0: lists[0]}, list(range(n)), n) == 0
