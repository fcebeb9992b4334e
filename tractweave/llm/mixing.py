"""Mixing to target weights with soft membership: domain posteriors, then nonnegative document rates by least squares."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractweave.llm.posterior import FEATURES, fit_discriminant, label_table, with_features
from tractweave.operators.scale import stage

TARGETS: Mapping[str, float] = {
    "en/1": 0.52,
    "de/1": 0.14,
    "fr/1": 0.14,
    "es/1": 0.12,
    "en/0": 0.05,
    "de/0": 0.01,
    "fr/0": 0.01,
    "es/0": 0.01,
}
"""Share of all tokens by domain; a domain is a language with the label of quality."""

SCALE = 1_000_000


@dataclass(frozen=True)
class MixConfig:
    targets: Mapping[str, float] | None = None
    max_steps: int = 40
    tolerance: float = 1e-4
    """Stop when every domain's expected tokens are this near their target, as a share of all tokens."""
    seed: int = 7


def domain_posteriors(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float]) -> DataFrame:
    """Stored table: the columns of ``docs`` but the text, ``n_tokens`` and ``posterior`` (in the order of ``targets``)."""
    measured = stage(with_features(docs).drop("text"), "mix-features")
    domain = F.concat_ws("/", F.coalesce("lang", F.lit("")), F.col("quality").cast("string"))
    labelled = measured.select("doc_id", "lang", *FEATURES).join(label_table(labels), "doc_id").withColumn("_domain", domain)
    model = fit_discriminant(labelled, "_domain", list(targets))
    # whole millionths, so that the sums below do not depend on the order of rows
    soft = F.transform(model.posteriors(), lambda p: F.round(p * SCALE).cast("long"))
    return stage(measured.withColumn("posterior", soft).drop(*FEATURES), "mix-posteriors")


def _fold(steps: list[np.ndarray]) -> Column:
    """Rate of a document after all projected steps, starting from 1: what it needs is its posteriors and the steps."""
    if not steps:
        return F.lit(1.0)
    gradients = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps])

    def step(rate: Column, gradient: Column) -> Column:
        along = F.aggregate(F.zip_with("posterior", gradient, lambda p, g: p * g), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(F.lit(0.0), rate - along / SCALE)

    return F.aggregate(gradients, F.lit(1.0), step)


def fit_rates(soft: DataFrame, targets: Mapping[str, float], config: MixConfig) -> list[np.ndarray]:
    """Steps of projected-gradient least squares on the rates of all documents.

    Least is the distance between expected tokens per domain and their targets, measured in the inverse of the domains'
    Gram matrix; in that metric a full step is never too long. A step is one aggregate over the stored posteriors, from
    which the driver gets one number per domain; rates are not stored but folded from the steps so far.
    """
    k = len(targets)
    tokens = F.col("n_tokens").cast("decimal(38,0)")
    at = [F.get("posterior", i).cast("decimal(38,0)") for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = soft.agg(
        F.sum("n_tokens").alias("n"), *[F.sum(tokens * F.get("posterior", i) * F.get("posterior", j)).alias(f"g{i}_{j}") for i, j in pairs]
    ).first()
    total = float(row["n"] or 0)
    if not total:
        return []
    gram = np.zeros((k, k))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = float(row[f"g{i}_{j}"]) / SCALE**2 / total
    inverse = np.linalg.inv(gram + 1e-6 * np.eye(k))
    wanted = np.array([targets[d] for d in targets]) / sum(targets.values())
    steps: list[np.ndarray] = []
    while len(steps) < config.max_steps:
        rate = F.round(_fold(steps) * SCALE).cast("decimal(38,0)")
        sums = soft.agg(*[F.sum(rate * tokens * p) for p in at]).first()
        off = np.array([float(x or 0) for x in sums]) / SCALE**2 / total - wanted
        if np.abs(off).max() <= config.tolerance:
            break
        steps.append(inverse @ off)
    return steps


def mix_rates(docs: DataFrame, labels: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``posterior``, ``domain`` (likeliest), ``rate`` and ``copies``.

    The expected tokens of each domain, sum of rate x tokens x posterior, meet the targets; their total is that of the
    input. ``copies`` realises the rate: its whole part, and one more for a share of documents drawn by a hash of the id.
    NULL and empty texts have no tokens, a rate like any other, and change no sum. Repeated rows are weighed alike. A domain
    without labelled rows is met only as far as posteriors reach it. No rows give no rows. Columns of these names are
    replaced.
    """
    targets = config.targets or TARGETS
    docs = docs.drop("n_tokens", "posterior", "domain", "rate", "copies", *FEATURES)
    soft = domain_posteriors(docs, labels, targets)
    steps = fit_rates(soft, targets, config)
    names = F.array(*[F.lit(d) for d in targets])
    draw = F.pmod(F.xxhash64(F.lit(config.seed), "doc_id"), F.lit(SCALE)) / SCALE
    return (
        soft.withColumn("rate", F.round(_fold(steps), 6))
        .withColumn("domain", F.get(names, F.array_position("posterior", F.array_max("posterior")).cast("int") - 1))
        .withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))
        .withColumn("posterior", F.transform("posterior", lambda p: p / SCALE))
    )


def mix_documents(docs: DataFrame, labels: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Rows of ``docs``, each as often as its rate says; columns stay as they are."""
    copies = (
        mix_rates(docs.select("doc_id", "lang", "text"), labels, config)
        .groupBy("doc_id")
        .agg(F.max("copies").alias("_copies"))  # rows of one id have one hash; the largest rate decides
    )
    return (
        docs.join(copies.withColumnRenamed("doc_id", "_id").hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("_copies", F.lit(1)))))
        .filter("_copies > 0")
        .drop("_copies", "_copy", "_id")
    )


def mix_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return mix_rates(docs.select("doc_id", "lang", "text"), labels).select(
        "doc_id", "n_tokens", "domain", F.transform("posterior", lambda p: F.round(p, 6)).alias("posterior"), "rate", "copies"
    )
