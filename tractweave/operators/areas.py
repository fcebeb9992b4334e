"""Areas to synthesize and their seed pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tractweave.functions import scalars as S
from tractweave.operators.regions import in_regions
from tractweave.operators.scale import stage
from tractweave.sources.lookups import puma_code


def areas_with_population(acs: DataFrame, fips=None, variable: str = "B01001_001") -> DataFrame:
    """Areas of a region whose total is positive."""
    return (
        in_regions(acs.filter(F.col("variable") == variable), fips)
        .groupBy("GEOID")
        .agg(S.strict_sum(F.col("estimate")).alias("pop"))
        .filter("pop > 0")
    )


def area_pumas(areas: DataFrame, crosswalk: DataFrame, n_chars: int | None = None) -> DataFrame:
    """PUMAs of each area, each with its state (``puma_code``). ``n_chars`` is the length of the area codes when they are
    shorter than a tract's."""
    code = F.col("CTFP") if n_chars is None else F.substring("CTFP", 1, n_chars)
    relation = crosswalk.select(code.alias("GEOID"), puma_code(crosswalk).alias("PUMA")).distinct()
    return areas.select("GEOID").join(relation, "GEOID")


def area_pools(area_pumas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seed pool of each area and PUMAs of each pool.

    Areas inside one PUMA share its pool; an area over several PUMAs has a pool of its own.
    """
    puma, area = F.col("PUMA"), Window.partitionBy("GEOID")
    pool = F.when(F.min(puma).over(area) == F.max(puma).over(area), F.concat(F.lit("P"), puma)).otherwise(
        F.concat(F.lit("A"), F.col("GEOID"))
    )
    pooled = stage(area_pumas.select("GEOID", "PUMA", pool.alias("pool")), "pooled")
    return pooled.select("GEOID", "pool").distinct(), pooled.select("pool", "PUMA").distinct()


NO_PUMA, NO_TARGET, NO_SEED = 1, 2, 4


def area_outcomes(
    areas: DataFrame, crosswalk: DataFrame, targets: DataFrame, hh_seed: DataFrame, person_seed: DataFrame | None = None, n_chars: int | None = None
) -> DataFrame:
    """Areas that can have no result, with the reasons as bits: no PUMA in the crosswalk (1), no known target (2), no
    household with persons in its PUMAs (4). Areas without a PUMA have no seed either.
    """
    seeded = hh_seed if person_seed is None else hh_seed.join(person_seed.select("SERIALNO"), "SERIALNO", "left_semi")
    yes = F.lit(True)
    known = targets.filter("target IS NOT NULL").select("GEOID", yes.alias("has_target")).distinct()
    pumas = area_pumas(areas, crosswalk, n_chars).join(seeded.select("PUMA", yes.alias("has_seed")).distinct(), "PUMA", "left")
    found = pumas.groupBy("GEOID").agg(F.max(F.coalesce("has_seed", F.lit(False))).alias("has_seed"))

    def bit(missing: Column, value: int) -> Column:
        return F.when(missing, value).otherwise(0)

    rows = areas.select("GEOID").distinct().join(found, "GEOID", "left").join(known, "GEOID", "left")
    reason = (
        bit(F.col("has_seed").isNull(), NO_PUMA)
        + bit(F.col("has_target").isNull(), NO_TARGET)
        + bit(~F.coalesce("has_seed", F.lit(False)), NO_SEED)
    )
    return rows.select("GEOID", reason.alias("reason")).filter("reason > 0")


def area_seed_sizes(area_pumas: DataFrame, hh_seed: DataFrame, person_seed: DataFrame) -> DataFrame:
    """Seed households with persons, and those persons, available to each area.

    Counted per PUMA first, so the area x household rows behind the numbers are never made.
    """
    sizes = person_seed.groupBy("SERIALNO").agg(F.count("*").alias("np"))
    per_puma = (
        hh_seed.join(sizes, "SERIALNO")
        .groupBy("PUMA")
        .agg(F.count("*").alias("households"), F.sum("np").alias("persons"))
    )
    return (
        area_pumas.join(per_puma, "PUMA")
        .groupBy("GEOID")
        .agg(F.sum("households").alias("households"), F.sum("persons").alias("persons"))
    )
