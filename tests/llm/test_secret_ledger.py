"""The secret scan's decisions, and its query against brute force."""

import hashlib
import re

import pytest

from fincrime.llm import registry, secrets
from fincrime.llm.common import shared_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, id string, blob string, t string, todo string, h string, word string, bits string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e", "f", "g") for i, t in rows], SCHEMA)


def base(text):
    """(start, kind's place, kind, end) by the contract's three patterns."""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16])


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = registry.QUERIES["op1_secret_ledger"](spark, SF).collect()
    assert len(got) == len(texts)
    found = 0
    for r in got:
        text = texts[r["doc_id"]]
        want = base(text)
        found += len(want)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _, _ in want) for n in range(3)]
        joined = ",".join(f"{kind}:{i}:{j}" for i, _, kind, j in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        every = sorted((i, k, j) for k, i, j in secrets.spans(text, secrets.RULES))
        assert r["spans"] == ",".join(f"{secrets.RULES[k].kind}:{i}:{j}" for i, k, j in every)
    assert found


def test_second_version_scans_only_what_the_first_did_not(spark, monkeypatch):
    """The ledger gets no pair of blob and rule version twice, whatever the bitmaps let pass."""
    rows = [(i, f"text {i % 30} token = abcdefghijklmn{i % 30}") for i in range(90)] + [(None, "text 3 token = abcdefghijklmn3"), (None, None),
                                                                                      (5, "text 5 token = abcdefghijklmn5")]
    for most in (secrets.MOST_BITS, 64):                # the second bitmap is full: every text is joined
        monkeypatch.setattr(secrets, "MOST_BITS", most)
        path = shared_path(spark, "ledger")
        first = secrets.scan(docs(spark, rows[:40]), path)
        assert first.count() == 40
        got = {}
        for r in secrets.scan(docs(spark, rows), path).collect():
            got.setdefault(r["doc_id"], []).append([x["kind"] for x in r["found"]])
        assert got[7] == [["assign"]] and got[5] == [["assign"]] * 2 and sorted(got[None]) == [[], ["assign"]]
        scanned = spark.read.parquet(f"{path}/scanned")
        assert scanned.count() == scanned.distinct().count() == 31 * len(secrets.RULES)
        findings = spark.read.parquet(f"{path}/findings")
        assert findings.count() == findings.distinct().count() == 30


def test_plan_moves_no_text_without_a_mark(spark):
    """Texts are exchanged on the way to the listed rows only, in one plan whatever the size."""
    rows = docs(spark, [(1, "a"), (2, "b")]).selectExpr("doc_id as id", "text as t", "xxhash64(doc_id, text) as h")
    marks = secrets._bitmap(rows.filter("id = 1"))
    assert [r["id"] for r in secrets._marked(rows, marks).collect()] == [1]
    assert [r["id"] for r in secrets._marked(rows, marks, keep=False).collect()] == [2]
    plan = secrets._marked(rows, marks, keep=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("n", [0, 1])
def test_empty_tables(spark, n):
    assert secrets.scan(docs(spark, [(None, None)] * n), shared_path(spark, "ledger")).count() == n
