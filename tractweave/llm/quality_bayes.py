"""Quality by hierarchical empirical Bayes: evidence of the text, on top of what its site and its path are known for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractweave.llm.posterior import FEATURES, fit_discriminant, label_table, with_features
from tractweave.operators.scale import stage


@dataclass(frozen=True)
class QualityConfig:
    host: str = "source"
    path: str = "lang"
    """Columns of the site and of the part of the site. For URLs use ``url_host`` and ``url_path`` first."""
    soft_weight: float = 0.25
    """Weight of an unlabelled document's own classifier probability in the counts of its site."""
    fold: int = 5
    """Labels of rows whose crc32(doc_id) mod ``fold`` is 0 are never learned."""
    keep_at: float = 0.5


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """First folder of the path."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, parent: str) -> DataFrame:
    """One row: how many observations the parent's rate is worth, by the method of moments over all groups.

    ``groups`` has ``n``, ``y`` and the parent's rate. The spread between groups beyond what counts of their size show by
    chance is the variance of the groups' true rates.
    """
    rate, p = F.col(parent), F.col("y") / F.col("n")
    return (
        groups.filter("n > 0")
        .agg(
            F.sum(F.col("n") * (p - rate) * (p - rate)).alias("s"),
            F.sum(F.col("n") * rate * (1 - rate)).alias("v"),
            F.sum("n").alias("t"),
            F.sum(F.col("n") * F.col("n")).alias("q"),
            F.count("*").alias("k"),
        )
        .select(
            (F.col("v") / F.col("t")).alias("_v"),
            (
                (F.col("s") - (F.col("k") - 1) * F.col("v") / F.col("t")) / F.greatest(F.col("t") - F.col("q") / F.col("t"), F.lit(1e-9))
            ).alias("_tau"),
        )
        .select(
            F.when(F.col("_tau") > 0, F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.col("_v") / F.col("_tau") - 1)))
            .otherwise(F.lit(1e6))
            .alias("strength")
        )
    )


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """``_host``, ``_path``, the path's counts ``n`` and ``y``, its host's rate and the strength of that rate for paths.

    ``evidence`` has ``_host``, ``_path``, ``w`` (weight) and ``e`` (0 to 1). Sparse hosts are drawn to the global rate,
    sparse paths to their host. All of it is sums per path, per host and overall; a hot site sends one row per task.
    """
    paths = evidence.groupBy("_host", "_path").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("e")).alias("y"))
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    overall = hosts.agg((F.sum("y") / F.sum("n")).alias("mean"))  # single rows from here on are joined by a constant
    mean = F.coalesce(F.col("mean"), F.lit(0.5))
    one = F.lit(1).alias("_one")
    with_mean = hosts.withColumn("_one", one).join(F.broadcast(overall.select(mean.alias("mean"), one)), "_one")
    pull = _strength(with_mean, "mean").select("strength", one)
    host_rate = (
        with_mean.join(F.broadcast(pull), "_one")
        .withColumn("host_rate", (F.col("strength") * F.col("mean") + F.col("y")) / (F.col("strength") + F.col("n")))
        .select(F.col("_host").alias("_h"), "host_rate")
    )
    joined = paths.join(host_rate, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h").withColumn("_one", one)
    return joined.join(F.broadcast(_strength(joined, "host_rate").select("strength", one)), "_one").drop("_one")


def score_quality(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """``docs`` without its text, with ``evidence`` (log odds of the text alone), ``site_rate``, ``score`` and ``kept``.

    The text's evidence is a linear discriminant over whole-text measurements. A document's own part is taken out of its
    path's counts before these vote on it. NULL host or path is a group of its own. NULL and empty texts measure 0 and are
    scored like other texts; repeated rows get one score; no rows give no rows. Columns of these names are replaced.
    """
    docs = docs.drop("evidence", "site_rate", "score", "kept", "held_out", *FEATURES)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % config.fold == 0, F.lit(True))
    known = label_table(labels).select("doc_id", F.col("quality").alias("_y"))
    measured = stage(
        with_features(docs)
        .drop("text", "n_tokens")
        .withColumn("held_out", held_out)
        .join(known, "doc_id", "left")
        .withColumn("_y", F.when(~F.col("held_out"), F.col("_y"))),
        "quality-features",
    )
    model = fit_discriminant(
        measured.filter("_y IS NOT NULL").withColumn("_label", F.col("_y").cast("string")), "_label", ["0", "1"]
    )
    bad, good = model.scores(with_prior=False)
    prior = float(model.priors[1])
    scored = (
        measured.withColumn("evidence", F.greatest(F.lit(-8.0), F.least(F.lit(8.0), good - bad)))
        .withColumn("_host", F.col(config.host))
        .withColumn("_path", F.col(config.path))
        .withColumn("w", F.when(F.col("_y").isNull(), config.soft_weight).otherwise(1.0))
        .withColumn(
            "e", F.coalesce(F.col("_y").cast("double"), 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.lit(prior))))))
        )
        .drop(*FEATURES)
    )
    sites = site_posteriors(scored).select(
        F.col("_host").alias("_h"), F.col("_path").alias("_p"), "n", "y", "host_rate", "strength"
    )
    others_n, others_y = F.greatest(F.col("n") - F.col("w"), F.lit(0.0)), F.greatest(F.col("y") - F.col("w") * F.col("e"), F.lit(0.0))
    site_rate = (F.col("strength") * F.col("host_rate") + others_y) / (F.col("strength") + others_n)
    return (
        scored.join(sites, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p")))
        .withColumn("site_rate", site_rate)
        .withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("site_rate"))))))
        .withColumn("kept", F.col("score") >= config.keep_at)
        .drop("_host", "_path", "_h", "_p", "w", "e", "n", "y", "host_rate", "strength", "_y")
    )


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score_quality(docs.select("doc_id", "text", "source", "lang"), labels)
    return out.select(
        "doc_id", "held_out", F.round("evidence", 6).alias("evidence"), F.round("site_rate", 6).alias("site_rate"),
        F.round("score", 6).alias("score"), "kept",
    )
