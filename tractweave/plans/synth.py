"""Whole pipelines: group quarters, households and persons, and the chain from totals to errors."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractweave.config import GQ_ATTRS, HH_ATTRS, MILITARY_GROUP, P_ATTRS, SynthConfig
from tractweave.operators.areas import area_outcomes, area_pools, area_pumas
from tractweave.operators.draw import draw_households, expand_persons
from tractweave.operators.gq import append_gq, gq_clean, gq_marginals
from tractweave.operators.scale import stage
from tractweave.operators.targets import subtract_gq
from tractweave.operators.validate import drawn_counts, generated_counts
from tractweave.operators.weights import Fit, fit_weights


class Population(NamedTuple):
    """persons: the result; fit: weights and per-area report; targets: what was aimed at, with any shortfall; counts:
    ``(GEOID, attr, level, gen)`` of the persons, from the draws and not from the expanded rows; outcomes: areas without result and
    why (``area_outcomes``)."""

    persons: DataFrame
    fit: Fit
    targets: DataFrame
    counts: DataFrame
    outcomes: DataFrame


def synth_gq(
    areas: DataFrame,
    crosswalk: DataFrame,
    gq_seed: DataFrame,
    gq_targets: DataFrame,
    cfg: SynthConfig = SynthConfig(),
    id_col: str = "SERIALNO",
    n_chars: int | None = None,
) -> DataFrame:
    """Group-quarters persons of every area with all attributes of the seed.

    Areas whose targets add up to nothing get no persons. ``id_col`` identifies a seed person.
    """
    gq_targets = stage(gq_targets, "gq_targets")
    populated = gq_targets.groupBy("GEOID").agg(F.sum("target").alias("t")).filter("t > 0").select("GEOID")
    pumas = area_pumas(areas.join(populated, "GEOID", "left_semi"), crosswalk, n_chars)
    area_pool, pool_pumas = area_pools(pumas)
    seed = stage(gq_seed.withColumn("SERIALNO", F.col(id_col)), "gq_seed")
    fit = fit_weights(area_pool, pool_pumas, seed, GQ_ATTRS, gq_targets, cfg=cfg.fit)
    draws = draw_households(fit, cfg.draw).select("GEOID", "new_id", "SERIALNO")
    p_id = F.concat("GEOID", F.lit("GQ"), F.col("new_id").cast("string"))
    return draws.join(seed.drop("PUMA"), "SERIALNO").withColumn("p_id", p_id)


def synth_population(
    areas: DataFrame,
    crosswalk: DataFrame,
    hh_seed: DataFrame,
    person_seed: DataFrame,
    hh_targets: DataFrame,
    person_targets: DataFrame,
    hh_attrs: Sequence[str] = HH_ATTRS,
    p_attrs: Sequence[str] = P_ATTRS,
    gq_pop: DataFrame | None = None,
    occp: DataFrame | None = None,
    cfg: SynthConfig = SynthConfig(),
    military: int = MILITARY_GROUP,
    n_chars: int | None = None,
) -> Population:
    """Household and, when given, group-quarters persons of every area.

    Group-quarters persons are taken off the person targets before weighting and appended at the end.
    """
    attrs = [*hh_attrs, *p_attrs]
    hh_seed, person_seed = stage(hh_seed, "hh_seed"), stage(person_seed, "person_seed")
    if gq_pop is not None:
        gq_pop = stage(gq_pop, "gq")
        counts = gq_marginals(gq_pop, occp, p_attrs, breaks=cfg.breaks, military=military)
        person_targets = subtract_gq(person_targets, counts)
    else:
        person_targets = person_targets.withColumn("shortfall", F.lit(0.0))
    columns = ["GEOID", "attr", "level", "target", "shortfall"]
    hh_rows = hh_targets.filter(F.col("attr").isin(list(hh_attrs))).withColumn("shortfall", F.lit(0.0))
    p_rows = person_targets.filter(F.col("attr").isin(list(p_attrs)))
    targets = stage(hh_rows.select(columns).unionByName(p_rows.select(columns)), "targets")
    area_pool, pool_pumas = area_pools(area_pumas(areas, crosswalk, n_chars))
    fit = fit_weights(area_pool, pool_pumas, hh_seed, hh_attrs, targets, person_seed, p_attrs, cfg.fit)
    draws = stage(draw_households(fit, cfg.draw), "draws")
    persons = expand_persons(draws, person_seed, attrs, cfg.draw, hh_seed)
    counts = drawn_counts(draws, hh_seed, person_seed, hh_attrs, p_attrs)
    if gq_pop is not None:
        gq_persons = gq_clean(gq_pop, occp, attrs, breaks=cfg.breaks, military=military)
        persons = append_gq(persons, gq_persons)
        counts = counts.unionByName(generated_counts(gq_persons, attrs))
    outcomes = area_outcomes(areas, crosswalk, targets, hh_seed, person_seed, n_chars)
    return Population(persons, fit, targets, counts, outcomes)


def write_population(persons: DataFrame, path: str, county_chars: int = 5) -> None:
    """Parquet partitioned by county prefix, in even files: small counties share a task and large ones are split."""
    rows = persons.withColumn("county", F.substring("GEOID", 1, county_chars)).hint("rebalance", "county")
    rows.write.mode("overwrite").partitionBy("county").parquet(path)
