"""Dense text measurements and a linear discriminant, fitted from grouped sums and applied as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RIDGE = 1e-3

FEATURES = ("f_length", "f_word", "f_distinct", "f_upper", "f_symbol", "f_wide", "f_de", "f_fr", "f_es")


def with_features(docs: DataFrame) -> DataFrame:
    """Add ``n_tokens`` and ``FEATURES`` measured on the whole text; NULL and empty texts measure 0 throughout.

    Tokens are what stands between blanks and line feeds. Rare kinds of characters are counted in what is left of the text
    without its small ASCII letters and common marks, so the text itself is searched once.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    chars = F.greatest(F.length(t), F.lit(1))

    def share(others: str) -> Column:
        return F.length(F.regexp_replace("_rest", others, "")) / chars

    pieces = F.greatest(F.size("_w"), F.lit(1))
    empty = t == ""
    return (
        docs.withColumn("_w", F.split(t, " "))
        .withColumn("_rest", F.regexp_replace(t, r"[a-z .,\n]+", ""))
        .withColumn("n_tokens", F.when(empty, 0).otherwise(F.size("_w") + F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))).cast("long"))
        .withColumn("f_length", F.log1p(F.col("n_tokens").cast("double")))
        .withColumn("f_word", F.length(t) / pieces / 10)
        .withColumn("f_distinct", F.when(empty, 0.0).otherwise(F.size(F.array_distinct("_w")) / pieces))
        .withColumn("f_upper", share(r"\P{Lu}+"))
        .withColumn("f_symbol", share(r"[^#*$%&|<>!]+") * 4)
        .withColumn("f_wide", (F.octet_length(t) - F.length(t)) / chars)
        .withColumn("f_de", share("[^äöüßÄÖÜ]+") * 10)
        .withColumn("f_fr", share("[^èêçÈÊÇ]+") * 10)
        .withColumn("f_es", share("[^ñóíÑÓÍ]+") * 10)
        .drop("_w", "_rest")
    )


@dataclass(frozen=True)
class Discriminant:
    """Classes with a linear score each: log prior + log density, up to what all classes share."""

    classes: Sequence[str]
    weights: np.ndarray  # class x feature
    offsets: np.ndarray  # without the prior
    priors: np.ndarray

    def scores(self, with_prior: bool = True) -> list[Column]:
        out = []
        for w, b, p in zip(self.weights, self.offsets, self.priors, strict=True):
            total = F.lit(float(b + (np.log(p) if with_prior else 0.0)))
            for name, x in zip(FEATURES, w, strict=True):
                total = total + F.col(name) * F.lit(float(x))
            out.append(total)
        return out

    def posteriors(self) -> Column:
        """Array with the probability of every class, in the order of ``classes``."""
        scores = F.array(*self.scores())
        raised = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
        total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
        return F.transform(raised, lambda x: x / total)


def fit_discriminant(labelled: DataFrame, label: str, classes: Sequence[str]) -> Discriminant:
    """Shared-covariance Gaussian classes from one grouped aggregate over every labelled row.

    The driver gets one row of sums per class. Rows of other labels are left out; a class without rows has the overall
    mean and next to no prior.
    """
    m = len(FEATURES)
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    sums = (
        labelled.filter(F.col(label).isin(list(classes)))
        .groupBy(F.col(label).alias("_class"))
        .agg(
            F.count("*").alias("n"),
            *[F.sum(f).alias(f) for f in FEATURES],
            *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}_{j}") for i, j in pairs],
        )
        .collect()
    )
    by = {r["_class"]: r for r in sums}
    n = np.array([by[c]["n"] if c in by else 0 for c in classes], float)
    first = np.array([[by[c][f] if c in by else 0.0 for f in FEATURES] for c in classes])
    all_n = max(n.sum(), 1.0)
    overall = first.sum(0) / all_n
    means = np.where(n[:, None] > 0, first / np.maximum(n, 1)[:, None], overall)
    second = np.zeros((m, m))
    for i, j in pairs:
        second[i, j] = second[j, i] = sum(r[f"s{i}_{j}"] for r in sums)
    cov = (second - (means * n[:, None]).T @ means) / all_n + RIDGE * np.eye(m)
    weights = np.linalg.solve(cov, means.T).T
    offsets = -0.5 * (weights * means).sum(1)
    return Discriminant(tuple(classes), weights, offsets, (n + 0.5) / (n + 0.5).sum())


def label_table(labels: DataFrame) -> DataFrame:
    """One row per document: where labels repeat, the lower quality and the higher toxicity count. NULL ids are left out."""
    return labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
