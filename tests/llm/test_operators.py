"""The ten operators on small tables with nulls, ties, repeated rows, empty and
long texts, clashing column names and empty tables, against brute force."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fincrime.llm import (components, dart_minhash, line_dedup, metric_join, mixing, piece_codec, quality_classifier,
                          quality_rules, registry, reshard, secrets, warc)
from fincrime.llm.common import shared_path

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, t string, key long, node long, host string, digest string, size long")
PROSE = "the reader of this page was glad that it is for all and not on paper with a note by an editor".split()


def docs(spark, rows):
    """rows: (doc_id, text, source); the other columns have clashing names."""
    return spark.createDataFrame([(i, t, "en", s, None, "x", "y", 1, 2, "z", "d", 3) for i, t, s in rows], SCHEMA)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(PROSE) + str(r.randint(0, 30)) * (r.random() < 0.5) for _ in range(n))


LONG = prose(1, 20_000)
ODD = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, LONG, "b"), (6, LONG, "a"), (6, LONG, "a"),
       (None, "no id here", "a"), (8, "a\nb\na\n\na", None), (9, "é\U0001f600 x", "c")]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_quality_measures(spark):
    got = quality_rules.verdicts(docs(spark, ODD + [(10, "a b c d e f g h i a b c d e f g h", "c")])).collect()
    assert len(got) == len(ODD) + 1
    by = {r["doc_id"]: r for r in got}
    for i, t, _ in ODD + [(10, "a b c d e f g h i a b c d e f g h", "c")]:
        w = words(t)
        win = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        often = {x for x in win if win.count(x) > 1} if len(win) < 100 else {x for x, c in __import__("collections").Counter(win).items() if c > 1}
        covered = {k + j for k, x in enumerate(win) if x in often for j in range(8)}
        assert (by[i]["n_words"], by[i]["word_chars"], by[i]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(covered)), i
        assert by[i]["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    assert by[8]["n_dup_lines"] == 2 and not by[1]["kept"] and by[5]["kept"]
    assert quality_rules.kept_rows(docs(spark, ODD)).filter("doc_id = 6").count() == 2
    assert quality_rules.verdicts(docs(spark, [])).count() == 0


def test_lines(spark):
    rows = [(i, f"own {i}\nmenu of the site\n\nend {i % 3}", "hot") for i in range(20)] + \
           [(100 + i, "copied page\nof two lines", "hot") for i in range(9)] + ODD
    got = {(r["doc_id"], r["text"]) for r in line_dedup.clean(docs(spark, rows), ratio=0.4).collect()}
    assert (0, "own 0\n\nend 0") in got and (100, "copied page\nof two lines") in got and (1, None) in got and (2, "") in got
    assert line_dedup.clean(docs(spark, rows)).count() == len(rows) and line_dedup.clean(docs(spark, [])).count() == 0


def test_default_ratio_drops_planted_lines_and_keeps_clean_ones(spark):
    """1,000 pages of a hot source: templates on 9, 3 and 1.2 % of them go, lines
    on 1 % and on one page stay; a small source keeps what is on 4 of its 20 pages."""
    def page(i):
        often = [f"template {n}" for n, step in (("nine", 11), ("three", 33), ("one", 80)) if i % step == 0]
        return "\n".join([f"own {i}", *often, *["rare"] * (i % 100 == 7), f"end {i}"])
    rows = [(i, page(i), "hot") for i in range(1000)] + \
           [(2000 + i, f"page {i}" + "\nfour pages" * (i < 4) + "\nsix pages" * (i < 6), "small") for i in range(20)]
    got = {r["doc_id"]: r for r in line_dedup.clean(docs(spark, rows)).collect()}
    for i, t, s in rows:
        gone = ("template", "six pages")
        kept = [x for x in t.split("\n") if not x.startswith(gone)]
        assert (got[i]["text"], got[i]["__lines_dropped"]) == ("\n".join(kept), t.count("\n") + 1 - len(kept)), i


def test_mix_meets_targets(spark):
    rows = [(i, prose(i, 20 + i % 7), "abc"[i % 3] if i % 10 else None) for i in range(600)] + ODD
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows) and max(r["copies"] for r in got) <= 2
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        if sum(r["size"] for r in own) > 5000 and s not in ("a", "b"):       # those two hold the very long texts
            assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) < 60
    assert all(r["target"] <= 2 * r["source_size"] + 1e-6 for r in got)
    assert mixing.mix(docs(spark, [])).count() == 0


def test_mix_goes_on_after_a_long_document(spark):
    """Very long texts, ids that are null or repeated: no text that is left out
    brings a source nearer to its target."""
    rows = [(i, prose(i, 20 + i % 7), "xyz"[i % 3]) for i in range(600)] + [(5000 + i, prose(i, 1500), "x") for i in range(3)] + \
           [(None, prose(i, 15 + i % 9), "n") for i in range(200)] + [(7, prose(900 + i, 30), "r") for i in range(100)] + ODD
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    for s in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == s]
        off = own[0]["target"] - sum(r["size"] * r["copies"] for r in own)
        units = {}
        for r in own:
            size, copies = units.get(r["h"], (0, r["copies"]))
            assert copies == r["copies"]
            units[r["h"]] = (size + r["size"], copies)
        base = math.floor(own[0]["target"] / own[0]["source_size"]) if own[0]["source_size"] else 0
        untaken = [size for size, copies in units.values() if copies == base and size]
        assert all(abs(off - size) >= abs(off) for size in untaken), s       # no other text brings it nearer
        if s in ("x", "y", "z", "n", "r"):
            assert abs(off) <= 15, (s, off)


def test_mixing_stage_takes_what_the_mix_says(spark):
    from corpus_pipeline import COLUMNS, mixture
    rows = [(None if i % 2 else 4, prose(i, 12 + i % 5), "ab"[i % 3 > 0]) for i in range(120)] + ODD
    d = docs(spark, rows).select(*COLUMNS)
    want = {}
    for r in mixing.mix(d).collect():
        want[r["source"]] = want.get(r["source"], 0) + r["size"] * r["copies"]
    got = dict.fromkeys(want, 0)
    for r in mixture(spark, d, "").collect():
        got[r["source"]] += len(words(r["text"]))
    assert got == want


def test_flow_moves_the_fewest():
    rnd = random.Random(3)
    for _ in range(20):
        n, m = rnd.randint(1, 5), rnd.randint(1, 6)
        sizes = [rnd.randint(0, 50) for _ in range(n)]
        room = [sum(sizes) // m + (j < sum(sizes) % m) for j in range(m)]
        flow = reshard.least_moves(sizes, room)
        assert [sum(f) for f in flow] == sizes and all(sum(f[j] for f in flow) <= room[j] for j in range(m))
        assert sum(f[j] for i, f in enumerate(flow) for j in range(m) if i != j) == \
            sum(sizes) - sum(min(sizes[i], room[i]) for i in range(min(n, m)))


def test_reshard(spark, tmp_path):
    rows = [(1000 + i, prose(i % 300, 30), "a") for i in range(400)] + ODD
    d = docs(spark, rows)
    got = reshard.reshard(d).collect()
    assert len(got) == len(rows)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    for r in got:
        t = next(t for i, t, _ in rows if i == r["doc_id"]) or ""
        assert (r["size"], r["text_crc32"]) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
    assert reshard.reshard(docs(spark, [])).count() == 0
    # rows without a text are few bytes, and still no single block when they are many
    sizes = spark.range(3001).selectExpr("id", "if(id = 3000, 1000000, 1)::bigint as size", "0 as old", "if(id = 3000, 6, 5)::bigint as block")
    parts, places = reshard.plan(sizes, 12, 16)
    assert parts.groupBy("old", "key").count().agg({"count": "max"}).first()[0] < 50
    assert places.count() <= 3 * 12 * reshard.BLOCKS + 2 * reshard.PART * 16
    reshard.rewrite(d, reshard.reshard(d), str(tmp_path / "out"))
    touched = {s for r in got if r["shard"] != r["old_shard"] for s in (r["shard"], r["old_shard"])}
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == sum(r["shard"] in touched for r in got)          # the others stay as they are


def test_relaid_files_hold_each_document_once(spark):
    """More and fewer shards: op4's rows are what lies in the files, emptied shards go."""
    rows = [(1000 + i, prose(i % 300, 30), "a") for i in range(400)] + ODD
    d = docs(spark, rows)
    for old, new in ((12, 16), (6, 4), (3, 3)):
        path = shared_path(spark, "relaid")
        got = reshard.relaid(d, path, old=old, new=new).collect()
        back = spark.read.parquet(path)
        key = lambda r: (str(r[0]), r[1], r[2])
        assert sorted(((r["doc_id"], r["text_crc32"], r["shard"]) for r in got), key=key) == sorted(
            ((r["doc_id"], zlib.crc32((r["text"] or "").encode()), r["shard"]) for r in back.collect()), key=key)
        assert sorted(back.columns) == sorted([*d.columns, "shard"]) and len(got) == len(rows)
        assert {r["shard"] for r in got} <= set(range(new))
        want = sorted(map(tuple, reshard.reshard(d, old=old, new=new).collect()), key=str)
        assert sorted(map(tuple, got), key=str) == want
    assert reshard.relaid(docs(spark, []), shared_path(spark, "relaid")).count() == 0


def test_rewrite_removes_emptied_shards(spark):
    """Three shards become two: the third's folder does not stay beside the copies."""
    d, path = docs(spark, [(i, prose(i, 20), "a") for i in range(90)]), shared_path(spark, "fewer")
    d.withColumn("shard", reshard.old_shard(F.col("text"), 3)).write.partitionBy("shard").parquet(path)
    reshard.rewrite(reshard.files(spark, d.schema, path).drop("shard"), reshard.reshard(d, old=3, new=2), path)
    back = spark.read.parquet(path)
    assert back.count() == 90 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1}


def test_secrets_ledger(spark):
    key = "AKIA" + "Z" * 14
    rows = [(20, f"é password: 'abcdefghijkl' {key}", "a"), (21, "TOKEN=short Api_Key = 0123456789abcdef", "a"),
            (22, f"é password: 'abcdefghijkl' {key}", "b"), (23, "ſecret=abcdefghijklmnop", "b")] + ODD
    path = shared_path(spark, "ledger")
    got = {r["doc_id"]: [(x["kind"], x["start"], x["stop"]) for x in r["found"]] for r in secrets.scan(docs(spark, rows), path).collect()}
    assert got[20] == got[22] == [("assign", 2, 25), ("access", 27, 45)] and got[23] == [] and got[1] == []
    assert got[21] == [("assign", 12, 38), ("hex", 22, 38)]
    scanned = spark.read.parquet(f"{path}/scanned").count()
    again = secrets.scan(docs(spark, rows + [(24, "new text", "a")]), path)
    assert again.count() == len(rows) + 1
    assert spark.read.parquet(f"{path}/scanned").count() == scanned + len(secrets.RULES)     # one new blob
    newer = secrets.RULES + (secrets.Rule("word", "editor"),)
    secrets.scan(docs(spark, rows), path, rules=newer).count()
    assert spark.read.parquet(f"{path}/scanned").count() == scanned + len(secrets.RULES) + scanned // len(secrets.RULES)
    # a rule that changed under its kind: what its older form found no longer shows
    changed = (secrets.Rule("assign", "never there"),) + secrets.RULES[1:]
    found = {r["doc_id"]: [(x["kind"], x["start"]) for x in r["found"]] for r in secrets.scan(docs(spark, rows), path, rules=changed).collect()}
    assert found[20] == [("access", 27)] and found[21] == [("hex", 22)]
    assert secrets.scan(docs(spark, []), shared_path(spark, "ledger")).count() == 0


def test_warc_round_trip(spark):
    long = "é<p>\r\n\r\nWARC/1.1\r\n" * 9000
    rows = [(1, "http://a b/", long), (2, None, long), (3, "u", None), (4, "u", ""), (5, "u", "x" * 999), (6, "u", "x" * 999),
            (7, "u", "y" * 1000), (8, "u", "y" * 1000), (8, "u", "y" * 1000), (None, "u", "z" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_path(spark, "warc-test")
    warc.write(pages, path, segment=1000)
    got = [r for r in warc.read(spark, path).collect()]
    assert len(got) == len(rows) and {r["status"] for r in got} == {"ok"}
    kinds = sorted((r["id"].split("/")[0], r["type"], r["refers_to"]) for r in got)
    assert kinds == sorted([("1", "revisit", "2"), ("2", "response", None), ("3", "response", None), ("4", "response", None),
                            ("5", "response", None), ("6", "response", None), ("7", "revisit", "8"), ("8", "response", None),
                            ("8", "response", None), ("", "response", None)], key=str) or set(kinds) == {
        ("1", "revisit", "2"), ("2", "response", None), ("3", "response", None), ("4", "response", None), ("5", "response", None),
        ("6", "response", None), ("7", "revisit", "8"), ("8", "response", None), ("", "response", None)}
    assert bytes(next(r["payload"] for r in got if r["id"].startswith("2/"))).decode() == long
    assert warc.unchunked(b"3\r\nabc\r\n0\r\n\r\n") == b"abc" and warc.unchunked(b"9\r\nabc\r\n0\r\n\r\n") is None
    import pandas as pd
    part = {"id": "1/0", "type": "response", "digest": hashlib.sha1(b"").hexdigest(), "refers_to": None, "origin": "1/0"}
    lost = pd.DataFrame([part | {"number": 1, "total": None, "last": False, "block": b"a"},
                         part | {"number": 3, "total": 2, "last": True, "block": b"b"}])
    assert warc.reassembled(lost)["status"].tolist() == ["incomplete"]


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(0)
    a = r.integers(0, 2 ** 63, 500).astype(np.uint64)
    w = r.integers(1, 20, 500).astype(float)
    v = np.where(np.arange(500) < 150, r.integers(1, 20, 500), w).astype(float)
    s = dart_minhash.signatures([(a, w), (a, v)], 4000)
    assert abs((s[0] == s[1]).mean() - np.minimum(w, v).sum() / np.maximum(w, v).sum()) < 0.04


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(5)
    base = prose(7, 120).split()
    rows = [(100, " ".join(base), "a"), (101, " ".join(base), "b")]
    for i in range(60):                     # a group around a text that is not its first
        w = list(base)
        for _ in range(r.randint(1, 3)):
            w[r.randrange(len(w))] = f"new{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(w), "a"))
    rows += [(200 + i, " ".join(base[:60]) + " " + prose(50 + i, 60), "a") for i in range(20)] + [(1000 + (i or 0), t, s) for i, t, s in ODD]
    got = {x["doc_id"]: x["class_id"] for x in dart_minhash.near_duplicates(docs(spark, rows)).collect()}
    sets = {i: set(dart_minhash.shingles(t or "")[0].tolist()) for i, t, _ in rows}
    label = {i: i for i in sets}
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j]
             and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for _ in range(len(sets)):
        before = dict(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    assert got == label
    assert dart_minhash.near_duplicates(docs(spark, [])).count() == 0


def test_near_copies_with_null_or_repeated_ids(spark):
    """One text of a group stays if its ids are all null, or if two texts share the smallest."""
    base = [prose(70 + g, 120) for g in range(3)]
    near = lambda g, n: f"{base[g]} tail{n}"
    rows = [(None, near(0, n), "a") for n in range(4)] + [(5, near(1, n), "a") for n in range(3)] + [(9, near(1, 8), "a")] + \
           [(None, near(2, 0), "a"), (7, near(2, 1), "a")]
    got = [r for r in dart_minhash.near_duplicates(docs(spark, rows)).collect()]
    assert len(got) == len(rows)
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got if r["kept"]) == [("5", "5"), ("7", "7"), ("None", "None")]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_metric_join_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "CELL", 40)
    monkeypatch.setattr(metric_join, "BLOCK", 32)
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 8))
    x[100:200] = x[:1] + 0.25 * r.normal(size=(100, 8))
    x[250:260] = x[249]
    rows = [(i, [float(c) for c in v], i % 2) for i, v in enumerate(x)]
    rows += [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [float("nan")] + [1.0] * 7, 0), (1003, rows[0][1], None),
             (1004, [None] + [1.0] * 7, 1), (1005, [1.0, 2.0], 0), (1006, [], 0), (0, rows[0][1], 0)]
    got = metric_join.join(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == len(rows)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (u @ u.T >= 0.93) & (np.arange(300)[:, None] % 2 == np.arange(300)[None, :] % 2)
    np.fill_diagonal(hit, False)
    n = hit.sum(axis=1) + np.array([i == 0 or hit[i, 0] for i in range(300)])        # vector 0 comes twice
    by = {g["vec_id"]: g for g in got}
    assert [by[i]["n_links"] for i in range(300)] == n.tolist()
    lab = np.arange(300)
    for _ in range(300):
        lab = np.minimum(lab, np.where(hit, lab[None, :], 999).min(axis=1))
    assert [by[i]["component_id"] for i in range(300)] == lab.tolist()
    assert all(by[i]["n_links"] == 0 and by[i]["kept"] for i in range(1000, 1007))


def test_classifier(spark):
    r = random.Random(1)
    rows = [(i, prose(i, 60) if i % 2 else " ".join(["BUY!!!###"] * r.randint(20, 60)), "a") for i in range(200)]
    x = quality_classifier.features(docs(spark, rows + ODD), "doc_id", "text")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None), (3, 1)], "doc_id long, quality int")
    model = quality_classifier.train(x, labels, "doc_id", "quality")
    got = x.select("id", model.score(F.col("x")).alias("s")).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= g["s"] <= 1 for g in got)
    assert all((g["s"] >= 0.5) == bool(g["id"] % 2) for g in got if g["id"] is not None and 10 <= g["id"] < 200)
    assert quality_classifier.train(x, labels.filter("quality = 1"), "doc_id", "quality") is None


PIECES = [("<unk>", 0.0, "special")] + [(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)] + \
    [(p, s, "piece") for p, s in (("▁", -3.0), ("a", -2.0), ("b", -2.5), ("ab", -3.5), ("ba", -3.25), ("aba", -5.0),
                                  ("▁a", -2.25), ("bb", -4.75), ("▁▁", -4.0))]


def _all(text, v):
    """Highest sum over all ways to cut the text."""
    if not text:
        return 0.0
    return max([v.scores[text[:n]][0] + _all(text[n:], v) for n in range(1, min(len(text), v.longest) + 1) if text[:n] in v.scores]
               + [v.uncovered + _all(text[1:], v)] * (text[0] not in v.scores))


def test_viterbi_is_best_and_streams():
    v = piece_codec.Vocabulary(PIECES)
    score = {i: s for i, (_, s, kind) in enumerate(PIECES) if kind == "piece"}
    codec, rnd = piece_codec.Codec(v), random.Random(4)
    for _ in range(200):
        t = "".join(rnd.choice("aabb c") for _ in range(rnd.randint(0, 9)))
        ids = codec.encode(t).tolist()
        got = sum(score.get(i, v.uncovered) for i in ids)
        assert math.isclose(got, _all("▁" + t.replace(" ", "▁"), v) if t else 0.0), t
        assert codec.decode(ids) == t and ids == piece_codec.encode_whole(t, v)
    long = "".join(rnd.choice("ab") for _ in range(5000))
    parts = list(piece_codec.viterbi(long, v))
    assert len(parts) > 100 and codec.decode([PIECES.index(("▁", -3.0, "piece")), *[i for p in parts for i in p]]) == long


def test_codec_round_trip(spark):
    if not __import__("os").path.exists(piece_codec.MODEL):
        pytest.skip("no vocabulary here")
    d = docs(spark, ODD)
    e = piece_codec.encode(d)
    got = sorted(((r["doc_id"], r["text"]) for r in piece_codec.decode(e).collect()), key=str)
    assert got == sorted([(i, t) for i, t, _ in ODD], key=str)
    assert piece_codec.encode(docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_keys(spark, name):
    from harness import compare, duck
    sf_dir = "/root/testdata/sf0.001"
    ok, _, _, detail = compare(spark, duck(sf_dir), name, registry.QUERIES[name], registry.oracle_sql()[name], sf_dir)
    assert ok, detail


def test_pipeline_run(spark, tmp_path):
    """Nulls, copies and a hot source through ``run``, against its rules in plain Python."""
    if not os.path.exists(piece_codec.MODEL):
        pytest.skip("no vocabulary here")
    import corpus_pipeline
    good = {i: f"{prose(3000 + i, 80 + i % 9)}\nthe end of page {i}" for i in range(140)}
    rows = [(i, t + "\nsite menu" * (i < 60), "hot" if i < 120 else "other") for i, t in good.items()]
    rows += [(500 + i, good[130], "other") for i in range(3)] + [(3, rows[3][1], "hot")]       # copies, a repeated row
    rows += [(600, None, "hot"), (601, "", None), (602, "too short", "other")]
    docs(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert all(x["n_ids"] == len(x["ids"]) for x in out.collect())
    got = piece_codec.decode(out).collect()
    # short and null texts go, the menu goes, of copies the smallest id stays
    assert {x["doc_id"] for x in got} <= set(good)
    times = {}
    for x in got:
        assert x["text"] == good[x["doc_id"]]
        times[x["doc_id"]] = times.get(x["doc_id"], 0) + 1
    # sources in order get weights 3 and 1 of 1.5 times all words, none over twice its own
    size = {s: sum(len(words(t)) for i, t in good.items() if (i < 120) == (s == "hot")) for s in ("hot", "other")}
    total = 1.5 * sum(size.values())
    target = {"other": min(2 * size["other"], total / 4)}
    target["hot"] = min(2 * size["hot"], total - target["other"])
    for s in size:
        taken = sum(len(words(good[i])) * n for i, n in times.items() if (i < 120) == (s == "hot"))
        assert abs(taken - target[s]) <= 40, (s, taken, target[s])
