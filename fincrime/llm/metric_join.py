"""Exact metric range join of embeddings, for near-duplicates.

Unit vectors are points; a cosine of ``c`` or more is a distance of at most
``r = sqrt(2 - 2c)``.  A bounded sample of the points serves as pivots.  Every
point has its home in the cell of the nearest pivot.  If a point x lies within r
of a point y whose home is cell p, the triangle inequality gives
``d(x, p) <= d(x, home) + 2 r`` and ``d(x, p) <= radius(p) + r``: x is also sent
to every cell that meets both.  So a cell holds all partners of its home points,
cells join independently, and each point counts its links in one place.

Equal vectors of one label are one point with a weight, so a group of copies is
never paired within itself.  Cells are cut into blocks of at most ``BLOCK`` home
points by ``BLOCK`` points, each a group of its own, so a dense cell is no
larger task.  Blocks return counts and a spanning forest of their links, never
all pairs.

Bounds: pivots are sent to the tasks, at most ``2 * MAX_PIVOTS`` in all however
many points and labels there are; a label too small for two has one cell and no
pivot.  The pivots affect speed only, never the result.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and rows with a null label, link with nothing; vectors of
different lengths do not link; rows that repeat a vec_id are vectors of their
own that share a component; a null vec_id links like any other and has the
component's smallest id that is not null (null where all are); an empty table
gives an empty one; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fincrime.llm.common import table, written
from fincrime.llm.components import components

COSINE = 0.93
CELL = 1024                  # points of a label for one more pivot
MAX_PIVOTS = 4096
BLOCK = 1024
SLACK = 1e-9                 # on distances, for rounding; the cosine itself has none


def _unit(vectors) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)        # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T)))


def usable(v: str):
    x = F.col(v)
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    return F.coalesce((F.size(x) > 0) & ~F.exists(x, bad) & F.exists(x, lambda e: e != 0), F.lit(False))


def points(df: DataFrame, id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Points (key, space, v, weight, first) and rows (id, key); rows of unusable
    vectors have no key.  ``space`` is the label and the length."""
    v = F.col(vector).cast("array<double>")
    # -0.0 and 0.0 are one value; the text of the numbers names a vector exactly
    text = F.concat_ws(",", F.transform(v, lambda e: (e + F.lit(0.0)).cast("string")))
    space = F.concat_ws("/", F.col(label).cast("string"), F.size(v).cast("string"))
    ok = F.col(label).isNotNull() & usable(vector)
    rows = df.select(F.col(id).alias("id"), F.when(ok, F.sha2(F.concat_ws("|", space, text), 256)).alias("key"),
                     space.alias("space"), F.when(ok, F.col(vector)).alias("v"))
    rows = written(rows, "join-rows")
    p = rows.filter("key is not null").groupBy("key").agg(
        F.first("space").alias("space"), F.first("v").alias("v"), F.count("*").alias("weight"), F.min("id").alias("first"))
    return written(p, "join-points"), rows.select("id", "key")


def pivots_of(pts: DataFrame) -> dict[str, list]:
    """A sample of each label's points: one for every CELL points, or more
    points where MAX_PIVOTS would be passed; none for labels with fewer."""
    n = written(pts.groupBy("space").agg(F.count("*").alias("n")), "join-spaces")
    cell = max(CELL, math.ceil((n.agg(F.sum("n")).first()[0] or 0) / MAX_PIVOTS))
    n = n.filter(F.col("n") > cell).withColumn("wanted", F.ceil(F.col("n") / F.lit(cell)))
    # keys are hashes, so the first ones are a sample; each task sends its first ones only
    rank = F.row_number().over(Window.partitionBy("space").orderBy("key"))
    top = pts.select("space", "key").withColumn("rank", rank).filter(F.col("rank") <= 2 * MAX_PIVOTS)
    top = top.join(n, "space").filter(F.col("rank") <= F.col("wanted")).select("key")
    out: dict[str, list] = {}
    for r in pts.join(top, "key").select("space", "key", "v").orderBy("space", "key").collect():
        out.setdefault(r["space"], []).append(r["v"])
    return out


def _assigner(pivots: dict[str, list], radius: float):
    units = {s: _unit(v) for s, v in pivots.items()}

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for space, g in b.groupby("space"):
                d = _distances(_unit(g["v"]), units[space]) if space in units else np.zeros((len(g), 1))
                home = d.argmin(axis=1)
                near = d[np.arange(len(d)), home]
                # what the home's distance leaves within reach; the cells' radii narrow it further
                cells = [np.flatnonzero(row <= limit) for row, limit in zip(d, near + 2 * radius)]
                yield pd.DataFrame({"key": g["key"].to_numpy(), "space": space, "home": home.astype("int32"), "near": near,
                                    "cells": [c.astype("int32") for c in cells], "far": [row[c] for row, c in zip(d, cells)]})
    return assign


def _linker(cosine: float):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        """Counts of the home points' links in one block, and a spanning forest."""
        h, m = group[group["side"] == 0], group[group["side"] == 1]
        if not len(h) or not len(m):
            return pd.DataFrame({"key": pd.Series(dtype=object), "links": pd.Series(dtype="int64"),
                                 "other": pd.Series(dtype=object)})
        hit = _unit(h["v"]) @ _unit(m["v"]).T >= cosine
        hk, mk = h["key"].to_numpy(), m["key"].to_numpy()
        hit &= hk[:, None] != mk[None, :]
        counts = (hit * m["weight"].to_numpy()[None, :]).sum(axis=1)
        rows, cols = np.nonzero(hit.any(axis=1))[0], np.nonzero(hit.any(axis=0))[0]
        sub = hit[np.ix_(rows, cols)]
        # smallest home point that each reaches within the block
        lab, big = np.arange(len(rows)), len(rows)
        while len(rows):
            col = np.where(sub, lab[:, None], big).min(axis=0)
            new = np.minimum(lab, np.where(sub, col[None, :], big).min(axis=1))
            new = np.minimum(new, new[new])
            if (new == lab).all():
                break
            lab = new
        home = hk[rows]
        out = [pd.DataFrame({"key": hk, "links": counts, "other": None})]
        if len(rows):
            out += [pd.DataFrame({"key": home, "links": 0, "other": home[lab]}),
                    pd.DataFrame({"key": mk[cols], "links": 0, "other": home[col]})]
        return pd.concat(out, ignore_index=True)
    return link


def join(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
         cosine: float = COSINE) -> DataFrame:
    """One row a row of ``df``: ``n_links``, ``component_id``, ``kept``."""
    pts, rows = points(df, id, vector, label)
    radius = math.sqrt(2.0 - 2.0 * cosine) + SLACK
    placed = pts.select("key", "space", "v").mapInPandas(
        _assigner(pivots_of(pts), radius), "key string, space string, home int, near double, cells array<int>, far array<double>")
    placed = written(placed, "join-cells")
    radii = placed.groupBy("space", "home").agg(F.max("near").alias("radius"), F.count("*").alias("homes"))
    # (key, cell) of all points: the home, and the cells within reach
    reach = placed.select("key", "space", "home", "near", F.explode(F.arrays_zip("cells", "far")).alias("x")) \
                  .select("key", "space", "home", "near", F.col("x.cells").alias("cell"), F.col("x.far").alias("far"))
    r = radii.withColumnRenamed("home", "cell")
    member = reach.join(r, ["space", "cell"]).filter(F.col("far") <= F.col("radius") + radius)
    sizes = member.groupBy("space", "cell").agg(F.count("*").alias("members"), F.max("homes").alias("homes"))
    cut = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    sizes = written(sizes.select("space", "cell", cut("homes").alias("hs"), cut("members").alias("ms")), "join-sizes")
    m = member.drop("radius", "homes").join(sizes, ["space", "cell"])
    part = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    homes = m.filter("cell = home").select("key", "space", "cell", F.lit(0).alias("side"), part("hs").alias("i"),
                                           F.explode(every("ms")).alias("j"))
    others = m.select("key", "space", "cell", F.lit(1).alias("side"), F.explode(every("hs")).alias("i"), part("ms").alias("j"))
    dealt = homes.unionByName(others).join(pts.select("key", "v", "weight"), "key")
    found = dealt.groupBy("space", "cell", "i", "j").applyInPandas(_linker(cosine), "key string, links long, other string")
    found = written(found, "join-found")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    edges = found.filter("other is not null and other <> key").select(F.col("key").alias("a"), F.col("other").alias("b"))
    # points that share an id are one component; null is no id
    ids = rows.filter("key is not null and id is not null").distinct()
    shared = ids.groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("z")).filter("a <> z")
    shared = ids.join(shared, "id").filter("key <> a").select("a", F.col("key").alias("b"))
    label_of = components(edges.union(shared).distinct())
    p = pts.join(counts, "key", "left").join(label_of, pts["key"] == label_of["node"], "left")
    p = written(p.select("key", "first", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                         F.coalesce("label", "key").alias("label")), "join-labels")
    least = p.groupBy("label").agg(F.min("first").alias("component_id"))           # nulls don't count
    p = written(p.join(least, "label").select(F.col("key").alias("k"), "n_links", "component_id"), "join-result")
    out = rows.join(p, rows["key"] == p["k"], "left")
    component = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op9(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "embeddings"))
