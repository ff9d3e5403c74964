"""Connected components of a graph given as links.

Each node starts as its own label.  A round gives every node the smallest label
among its neighbours' and its own, then the label of that label; rounds end
when nothing changes, after about the logarithm of the longest shortest path.
Labels are written to the shared folder each round; the driver sees one count a
round.  Links meet labels in joins of plain tables, which Spark broadcasts
below its threshold and whose hot keys it splits beyond."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fincrime.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: of one type with an order, undirected) -> (node, label): for every node of a
    link the smallest node that it reaches."""
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                        .filter("a <> b").distinct(), "cc-links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "cc-labels")
    while True:
        near = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("n")).agg(F.min("label").alias("seen"))
        step = written(labels.join(near, labels["node"] == near["n"])
                             .select("node", F.col("label").alias("before"), F.least("label", "seen").alias("label")), "cc-step")
        up = step.select(F.col("node").alias("n"), F.col("label").alias("upper"))
        new = written(step.join(up, step["label"] == up["n"])
                          .select("node", "before", F.col("upper").alias("label")), "cc-labels")
        labels = new.select("node", "label")
        if not new.filter("label <> before").head(1):
            return labels
