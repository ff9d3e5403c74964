"""Null and repeated ids, empty tables and the query of the metric range join."""

import numpy as np

from fincrime.llm import metric_join, registry

SCHEMA = "vec_id long, embedding array<double>, label int, key string, space string, first long, cells array<int>"
SF = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", "s", 1, [1]) for i, v, label in rows], SCHEMA)


def chain(n, step=0.3):
    """Unit vectors in a plane, each within reach of its neighbours only."""
    return [[float(np.cos(step * k)), float(np.sin(step * k))] for k in range(n)]


def test_links_run_through_null_ids(spark):
    c = chain(6)
    rows = [(9, c[0], 1), (None, c[1], 1), (None, c[2], 1), (4, c[3], 1), (None, chain(12)[11], 1), (None, c[0], 2), (None, c[0], None)]
    got = metric_join.join(vectors(spark, rows)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == sorted([
        ("9", 1, "4", False), ("None", 2, "4", False), ("None", 2, "4", False), ("4", 1, "4", True),
        ("None", 0, "None", True), ("None", 0, "None", True), ("None", 0, "None", True)])


def test_repeated_ids_share_a_component(spark):
    c = chain(12)
    rows = [(5, c[0], 1), (5, c[11], 1), (8, c[10], 1), (8, c[10], 1), (2, c[5], 1)]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in metric_join.join(vectors(spark, rows)).collect())
    assert got == [(2, 0, 2), (5, 0, 5), (5, 2, 5), (8, 2, 5), (8, 2, 5)]


def test_reach_lists_hold_the_home_and_what_is_near():
    import pandas as pd
    pivots = [[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]]
    b = pd.DataFrame({"key": ["a", "b"], "space": "s", "v": [[1.0, 0.1], [0.7, 0.72]]})
    out, = metric_join._assigner({"s": pivots}, 0.3)(iter([b]))
    assert out["home"].tolist() == [0, 1] and [x.tolist() for x in out["cells"]] == [[0], [0, 1]]
    assert all(len(c) == len(f) for c, f in zip(out["cells"], out["far"]))


def test_empty_table(spark):
    assert metric_join.join(vectors(spark, [])).count() == 0


def test_query_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ok = [r for r in rows if r["label"] is not None and r["embedding"] and np.isfinite(np.array(r["embedding"], float)).all()
          and np.any(r["embedding"])]
    u = np.array([r["embedding"] for r in ok], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    lab = np.array([r["label"] for r in ok])
    hit = (u @ u.T >= 0.93) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(hit, False)
    ids = np.array([r["vec_id"] for r in ok])
    least = ids.copy()
    for _ in range(len(ids)):
        new = np.minimum(least, np.where(hit, least[None, :], least.max()).min(axis=1))
        if (new == least).all():
            break
        least = new
    want = {r["vec_id"]: (0, r["vec_id"]) for r in rows} | {int(i): (int(n), int(c)) for i, n, c in zip(ids, hit.sum(axis=1), least)}
    got = registry.QUERIES["op9_metric_range_join"](spark, SF).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
