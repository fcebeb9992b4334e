"""Area totals -> long targets ``(GEOID, attr, level, target)``.

Every attribute is described by rows ``(variable, attr, level, sign)`` of a level map. All requested attributes are
then one join and one aggregate over one scan of the totals, however many there are. A derived level (people not
working = everyone minus the working) is expressed through ``sign``, so it needs no second pass either.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractweave.config import GQ_ATTRS, NOT_WORKING_GROUP, Breaks, canonical
from tractweave.functions import scalars as S
from tractweave.functions.local import small_table
from tractweave.operators.regions import in_regions
from tractweave.operators.scale import stage
from tractweave.sources.characteristics import TABLE_OF

# Variables that are totals over other variables of the same table.
AGE_TOTALS = ("B01001_001", "B01001_002", "B01001_026")
RACE_TOTALS = ("B03002_001", "B03002_002", "B03002_012")
POPULATION = "B01001_001"


def _rows(lookup: DataFrame, variable: str, attr: str, level: Column, sign: int = 1) -> DataFrame:
    return lookup.select(
        F.col(variable).alias("variable"),
        F.lit(attr).alias("attr"),
        level.cast("string").alias("level"),
        F.lit(sign).alias("sign"),
    )


def hh_level_map(lookups: Mapping[str, DataFrame], attrs: Sequence[str], breaks: Breaks = Breaks()) -> DataFrame:
    """Level map of household attributes; ``lookups`` holds ``hhsize_type`` and ``hhincome``."""
    makers = {
        "HH_Size": lambda: _rows(lookups["hhsize_type"], "name", "HH_Size", F.col("hh_size")),
        "HH_Type": lambda: _rows(lookups["hhsize_type"], "name", "HH_Type", F.col("hh_type")),
        "HH_Income": lambda: _rows(
            lookups["hhincome"], "name", "HH_Income", S.cut_left(F.col("income_max"), breaks.income)
        ),
    }
    return _union([makers[a]() for a in attrs if a in makers]).filter("level IS NOT NULL")


def person_level_map(lookups: Mapping[str, DataFrame], attrs: Sequence[str], breaks: Breaks = Breaks()) -> DataFrame:
    """Level map of person attributes; ``lookups`` holds ``sex_by_age``, ``race_eth``, ``grade`` and ``occp``."""

    def ages():
        return lookups["sex_by_age"].filter(~F.col("name").isin(*AGE_TOTALS))

    def races():
        return lookups["race_eth"].filter(~F.col("name").isin(*RACE_TOTALS))

    def schools():
        spark = next(iter(lookups.values())).sparkSession
        names = small_table(spark, {"name": list(S.SCHOOL_VARIABLES)}, "name string")
        return names.withColumn("school", S.school_variable(F.col("name")))

    makers = {
        "Age": lambda: _rows(ages(), "name", "Age", S.cut_left(F.col("age_max"), breaks.age, include_lowest=True)),
        "Sex": lambda: _rows(ages(), "name", "Sex", F.col("sex_num")),
        "Race": lambda: _rows(races(), "name", "Race", S.race_code(F.col("race"))),
        "Hispanic": lambda: _rows(races(), "name", "Hispanic", F.col("hispanic")),
        "Grade": lambda: _rows(lookups["grade"], "name", "Grade", F.col("grade")),
        "School_Type": lambda: _rows(schools(), "name", "School_Type", F.col("school")),
        "Occ_Group": lambda: _occupation_rows(lookups["occp"]),
    }
    return _union([makers[a]() for a in attrs if a in makers]).filter("level IS NOT NULL")


def _occupation_rows(occp: DataFrame) -> DataFrame:
    """Detailed occupations count for their group and against the not-working level; the population counts for it."""
    detailed = (
        occp.filter((F.length("Code2") < 10) & F.col("acs_var").isNotNull()).select("acs_var", "occ_group").distinct()
    )
    residual = F.lit(NOT_WORKING_GROUP)
    everyone = small_table(occp.sparkSession, {"acs_var": [POPULATION]}, "acs_var string")
    return _union(
        [
            _rows(detailed, "acs_var", "Occ_Group", F.col("occ_group")),
            _rows(detailed, "acs_var", "Occ_Group", residual, sign=-1),
            _rows(everyone, "acs_var", "Occ_Group", residual),
        ]
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("no attribute of this kind was requested")
    return reduce(DataFrame.unionByName, parts)


def apply_level_map(acs: DataFrame, level_map: DataFrame, tables: Sequence[str], fips=None) -> DataFrame:
    """Strict totals by area, attribute and level. A level reached by subtraction only is left out.

    The level map is stored first: with its true size known the planner can broadcast it, and the totals, which have few
    distinct variables, are not shuffled by variable.
    """
    return (
        in_regions(acs.filter(F.col("table_id").isin(sorted(tables))), fips)
        .join(stage(level_map, "level_map"), "variable")
        .groupBy("GEOID", "attr", "level")
        .agg(S.strict_sum(F.col("estimate") * F.col("sign")).alias("target"), F.max("sign").alias("sign"))
        .filter("sign = 1")
        .drop("sign")
    )


def hh_targets(
    acs: DataFrame, lookups: Mapping[str, DataFrame], chars: Sequence[str], fips=None, breaks: Breaks = Breaks()
) -> DataFrame:
    """Household size, type and income totals by area."""
    attrs = canonical(chars)
    level_map = hh_level_map(lookups, attrs, breaks)
    return apply_level_map(acs, level_map, {TABLE_OF[a] for a in attrs if a.startswith("HH_")}, fips)


def person_targets(
    acs: DataFrame, lookups: Mapping[str, DataFrame], chars: Sequence[str], fips=None, breaks: Breaks = Breaks()
) -> DataFrame:
    """Age, sex, race, ethnicity, grade, school type and occupation totals by area."""
    attrs = canonical(chars)
    tables = {TABLE_OF[a] for a in attrs if not a.startswith("HH_")}
    if "Occ_Group" in attrs:
        tables.add(TABLE_OF["Age"])
    return apply_level_map(acs, person_level_map(lookups, attrs, breaks), tables, fips)


def gq_targets(gq: DataFrame, fips=None) -> DataFrame:
    """Group-quarters sex, age and type totals by area."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("level")) for a in GQ_ATTRS])
    return (
        in_regions(gq, fips)
        .select("GEOID", "estimate", F.explode(pairs).alias("c"))
        .groupBy("GEOID", "c.attr", "c.level")
        .agg(S.strict_sum(F.col("estimate")).alias("target"))
    )


def residual_level(totals: DataFrame, parts: DataFrame, attr: str, level) -> DataFrame:
    """Append to ``parts`` one level holding total minus the sum of parts; an area without parts keeps its total."""
    used = parts.groupBy("GEOID").agg(
        S.strict_sum(F.col("target")).alias("_used"), F.lit(True).alias("_has_parts")
    )
    rest = totals.join(used, "GEOID", "left").select(
        "GEOID",
        F.lit(attr).alias("attr"),
        F.lit(str(level)).alias("level"),
        (F.col("total") - F.when(F.col("_has_parts"), F.col("_used")).otherwise(F.lit(0.0))).alias("target"),
    )
    return parts.unionByName(rest)


def subtract_gq(targets: DataFrame, gq_counts: DataFrame) -> DataFrame:
    """Person targets without the group-quarters persons.

    Adds ``shortfall``: by how much the group-quarters count exceeded the target, which is then held at zero.
    """
    count = F.coalesce(F.col("gq_count"), F.lit(0))
    gap = F.col("target") - count
    return targets.join(gq_counts, ["GEOID", "attr", "level"], "left").select(
        "GEOID",
        "attr",
        "level",
        # greatest() skips NULL, so an unknown target has to be kept by hand
        F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0))).alias("target"),
        F.greatest(count - F.col("target"), F.lit(0.0)).alias("shortfall"),
    )
