"""Survey microdata -> household, person and group-quarters seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractweave.config import MILITARY_GROUP, Breaks
from tractweave.functions import scalars as S

GQ_MARK = "GQ"


def in_pumas(pums: DataFrame, pumas: Sequence[str] | DataFrame | None) -> DataFrame:
    """Records of the given PUMAs: a short list, a frame with a ``PUMA`` column, or everything."""
    if pumas is None:
        return pums
    if isinstance(pumas, DataFrame):
        return pums.join(pumas.select("PUMA"), "PUMA", "left_semi")
    return pums.filter(F.col("PUMA").isin(list(pumas)))


def households_only(pums: DataFrame) -> DataFrame:
    return pums.filter(~F.col("SERIALNO").contains(GQ_MARK))


def first_per_household(df: DataFrame) -> DataFrame:
    """One row per household: the one with the lowest person number."""
    names = [c for c in df.columns if c != "SERIALNO"]
    first = F.min_by(F.struct(*names), "SPORDER").alias("r")
    return df.groupBy("SERIALNO").agg(first).select("SERIALNO", *[f"r.{c}" for c in names])


def hh_seed(
    pums: DataFrame,
    pumas=None,
    hh_vars: Sequence[str] = ("NP", "HHT", "HINCP", "ADJINC"),
    breaks: Breaks = Breaks(),
) -> DataFrame:
    """One recoded row per household outside group quarters."""
    recodes = {
        "HINCP": ("HH_Income", lambda: S.cut_left(S.adjusted_income(F.col("HINCP"), F.col("ADJINC")), breaks.income)),
        "NP": ("HH_Size", lambda: S.top_code(F.col("NP"))),
        "HHT": ("HH_Type", lambda: S.household_type(F.col("HHT"))),
    }
    consumed = {*recodes, "ADJINC"} if "HINCP" in hh_vars else set(recodes)
    kept = [v for v in dict.fromkeys(hh_vars) if v not in consumed]
    rows = households_only(in_pumas(pums, pumas)).select(
        "SERIALNO",
        "SPORDER",
        "PUMA",
        *kept,
        *[make().alias(name) for var, (name, make) in recodes.items() if var in hh_vars],
    )
    return first_per_household(rows)


def person_seed(
    pums: DataFrame,
    occp: DataFrame | None = None,
    pumas=None,
    p_vars: Sequence[str] = ("SEX", "AGEP", "RAC1P", "HISP", "OCCP", "SCHG", "SCH"),
    breaks: Breaks = Breaks(),
    military: int = MILITARY_GROUP,
) -> DataFrame:
    """One recoded row per person outside group quarters.

    With occupations, persons in the military group or with an unmatched code are left out, as they have no target.
    """
    recodes = _person_recodes(breaks)
    kept = [v for v in dict.fromkeys(p_vars) if v not in recodes and v not in ("SERIALNO", "SPORDER", "PUMA")]
    rows = households_only(in_pumas(pums, pumas)).select(
        "SERIALNO",
        "SPORDER",
        "PUMA",
        *kept,
        *[make().alias(name) for var, (name, make) in recodes.items() if var in p_vars],
    )
    if "OCCP" not in p_vars:
        return rows
    return working_groups(rows, occp, military)


def _person_recodes(breaks: Breaks) -> dict:
    return {
        "AGEP": ("Age", lambda: S.cut_left(F.col("AGEP"), breaks.age, include_lowest=True)),
        "RAC1P": ("Race", lambda: S.condense_race(F.col("RAC1P"))),
        "HISP": ("Hispanic", lambda: S.hispanic_flag(F.col("HISP"))),
        "SCH": ("School_Type", lambda: S.school_type(F.col("SCH"))),
        "SCHG": ("Grade", lambda: F.col("SCHG")),
        "SEX": ("Sex", lambda: F.col("SEX")),
        "OCCP": ("Occupation", lambda: F.col("OCCP")),
    }


def with_occupation_group(df: DataFrame, occp: DataFrame, column: str = "Occupation") -> DataFrame:
    """Left join of the occupation code list, not-working code moved to its own group."""
    groups = occp.select(F.col("Code").alias(column), F.col("occ_group").cast("int").alias("_group")).distinct()
    return df.join(groups, column, "left").withColumn(
        "Occ_Group", S.occupation_group(F.col(column), F.col("_group")).cast("int")
    ).drop("_group")


def working_groups(df: DataFrame, occp: DataFrame, military: int = MILITARY_GROUP) -> DataFrame:
    """Occupation group added; military and unmatched persons dropped."""
    return with_occupation_group(df, occp).filter(F.col("Occ_Group") != military)


UNMATCHED, MILITARY = 1, 2


def dropped_persons(pums: DataFrame, occp: DataFrame, pumas=None, military: int = MILITARY_GROUP) -> DataFrame:
    """Persons that the person seed leaves out, by PUMA, kind of quarters and reason: an occupation that the code list does not have (1), the military
    (2). The same pass counts persons of households and of group quarters.
    """
    rows = in_pumas(pums, pumas).select("PUMA", F.col("SERIALNO").contains(GQ_MARK).alias("in_gq"), F.col("OCCP").alias("Occupation"))
    group = F.col("Occ_Group")
    reason = F.when(group.isNull(), UNMATCHED).when(group == military, MILITARY)
    return (
        with_occupation_group(rows, occp)
        .withColumn("reason", reason)
        .filter("reason IS NOT NULL")
        .groupBy("PUMA", "in_gq", "reason")
        .agg(F.count("*").alias("persons"))
    )


def gq_seed(pums: DataFrame, pumas=None, breaks: Breaks = Breaks()) -> DataFrame:
    """Group-quarters persons with sex, age band and type as in the group-quarters totals."""
    return (
        in_pumas(pums, pumas)
        .filter(F.col("SERIALNO").contains(GQ_MARK))
        .withColumns(
            {
                "GQ_Type": S.gq_type(F.col("SCHG"), F.col("OCCP")),
                "GQ_Age": S.cut_left(F.col("AGEP"), breaks.gq_age),
            }
        )
        .withColumnRenamed("SEX", "GQ_Sex")
    )
