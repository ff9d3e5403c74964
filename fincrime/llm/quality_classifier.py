"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a vector of transformed statistics, computed with built-in
expressions over the whole text.  Training needs the count, the sums and the
sums of products of each class: one aggregate, whose result has a row a class
whatever the input.  The covariances are shrunk towards their pooled form and
then towards a multiple of the identity; their inverse Cholesky factors are
computed once on the driver (a few dozen numbers) and written into the scoring
expression, the logistic of the difference of the two log densities.

Defined results: a null text counts as empty; an empty text has the vector of
zero counts and a score like any other; a document with several labels takes
their majority, ties as 1; rows with a null id have no label; with no labelled
row of one class, every score is 0.5; repeated rows are scored each on its own;
other columns are never read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fincrime.llm.common import BLANKS, table, whole, written

POOLED = 0.10                # share of the pooled covariance in each class's
ROUND = 0.02                 # then share of the identity times the mean variance


def features(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, x: array of double): logarithms of smoothed counts and ratios."""
    t = F.col("t")
    d = df.select(F.col(id).alias("id"), whole(text).alias("t"))
    # what is neither a small letter nor a blank is a small part of most texts
    d = d.select("id", F.length(t).alias("chars"), F.array_remove(F.split(t, BLANKS), "").alias("w"),
                 F.regexp_replace(t, r"[\p{Ll}\x20]+", "").alias("rest"))
    n = F.size("w")
    left = lambda kept: F.length(F.regexp_replace("rest", f"[^{kept}]+", ""))
    d = d.select("id", "chars", n.alias("n"), F.length(F.array_join("w", "")).alias("wc"),
                 F.size(F.array_distinct("w")).alias("different"),
                 F.size(F.filter("w", lambda x: F.length(x) <= 3)).alias("short"),
                 left(r"\p{Lu}").alias("upper"), left(r"\d").alias("digits"), left("#*$%&|<>").alias("symbols"),
                 left("!?").alias("loud"), left(".,;:").alias("stops"), left(r"\n").alias("ends"))
    ratio = lambda a, b: F.log((F.col(a) + 0.5) / (F.col(b) + 1.0))
    return d.select("id", F.array(F.log(F.col("n") + 1.0), ratio("wc", "n"), ratio("different", "n"), ratio("short", "n"),
                                  ratio("upper", "chars"), ratio("digits", "chars"), ratio("symbols", "n"),
                                  ratio("loud", "n"), ratio("stops", "n"), ratio("ends", "n")).alias("x"))


D = 10


class Model:
    """Class means, inverse Cholesky factors and offsets; ``None`` without both classes."""

    def __init__(self, classes: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        """classes: label -> (n, mean, covariance)."""
        total = sum(n for n, _, _ in classes.values())
        pooled = sum(n * c for n, _, c in classes.values()) / total
        self.parts = {}
        for label, (n, mean, cov) in classes.items():
            s = (1 - POOLED) * cov + POOLED * pooled
            s = (1 - ROUND) * s + (ROUND * np.trace(s) / len(s) + 1e-9) * np.eye(len(s))
            chol = np.linalg.cholesky(s)
            self.parts[label] = (mean, np.linalg.inv(chol),
                                 math.log(n / total) - float(np.log(np.diag(chol)).sum()))

    def log_density(self, x: Column, label: int) -> Column:
        mean, inverse, offset = self.parts[label]
        out = F.lit(float(offset))
        for i in range(len(mean)):
            z = F.lit(0.0)
            for j in range(i + 1):
                z = z + (F.get(x, F.lit(j)) - float(mean[j])) * float(inverse[i, j])
            out = out - F.lit(0.5) * z * z
        return out

    def score(self, x: Column) -> Column:
        """Probability of label 1, between 0 and 1."""
        diff = self.log_density(x, 1) - self.log_density(x, 0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.greatest(F.least(-diff, F.lit(700.0)), F.lit(-700.0))))


def train(x: DataFrame, labels: DataFrame, id: str, label: str) -> Model | None:
    """``x`` (id, x) with labels 0 and 1 by ``id``; sums are exact over all rows."""
    y = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id).alias("i")) \
              .agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    j = x.join(y, x["id"] == y["i"]).select("y", *[F.get("x", F.lit(k)).alias(f"x{k}") for k in range(D)])
    pairs = [(a, b) for a in range(D) for b in range(a + 1)]
    rows = j.groupBy("y").agg(F.count("*").alias("n"), *[F.sum(f"x{k}").alias(f"s{k}") for k in range(D)],
                              *[F.sum(F.col(f"x{a}") * F.col(f"x{b}")).alias(f"p{a}_{b}") for a, b in pairs]).collect()
    classes = {}
    for r in rows:
        mean = np.array([r[f"s{k}"] for k in range(D)]) / r["n"]
        cov = np.zeros((D, D))
        for a, b in pairs:
            cov[a, b] = cov[b, a] = r[f"p{a}_{b}"] / r["n"] - mean[a] * mean[b]
        classes[r["y"]] = (r["n"], mean, cov)
    return Model(classes) if set(classes) == {0, 1} else None


def op5(spark, sf_dir: str) -> DataFrame:
    held = F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(3)) == 1
    x = written(features(table(spark, sf_dir, "documents"), "doc_id", "text"), "quality-x")
    model = train(x.filter(~held), table(spark, sf_dir, "labels"), "doc_id", "quality")
    score = model.score(F.col("x")) if model else F.lit(0.5)
    return x.select(F.col("id").alias("doc_id"), held.alias("held_out"), score.alias("score")) \
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
