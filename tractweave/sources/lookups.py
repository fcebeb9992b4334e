"""Builders of the lookup tables from a variable dictionary ``(name, label, concept)``.

``by`` names columns (survey year, say) when the dictionary holds several editions; each edition is built on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tractweave.functions import scalars as S


def crosswalk_lookup(crosswalk: DataFrame) -> DataFrame:
    """Adds the county and tract codes to the tract-to-PUMA relation."""
    return crosswalk.select(
        "STATEFP",
        "COUNTYFP",
        "TRACTCE",
        "PUMA5CE",
        F.concat("STATEFP", "COUNTYFP").alias("STCNTYFP"),
        F.concat("STATEFP", "COUNTYFP", "TRACTCE").alias("CTFP"),
    )


def puma_code(crosswalk: DataFrame) -> Column:
    """Code of a PUMA in all joins: state and PUMA, as PUMA codes repeat from state to state.

    A crosswalk that already has a ``PUMA`` column names its PUMAs by it.
    """
    return F.col("PUMA") if "PUMA" in crosswalk.columns else S.puma_key(F.col("STATEFP"), F.col("PUMA5CE"))


def pumas_of(crosswalk: DataFrame, fips=None) -> DataFrame:
    """Distinct PUMAs of a region (state, county or tract prefix), each with its state (``puma_code``)."""
    return crosswalk.filter(S.in_region(F.col("CTFP"), fips)).select(puma_code(crosswalk).alias("PUMA")).distinct()


def occupation_lookup(codelist: DataFrame, subject: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Occupation codes with their group and, where the normalised text agrees, their totals variable."""
    _, _, _, l4, l5, l6 = S.label_levels(F.col("label"), 6)
    variables = subject.filter(F.col("name").rlike("S2401_C01") & l4.isNotNull()).select(
        *by, S.text_key(F.coalesce(l6, l5, l4)).alias("occp_match"), F.col("name").alias("acs_var")
    )
    codes = codelist.filter(F.col("Code").isNotNull()).select(
        *by,
        "Code",
        "Code2",
        "Description",
        F.substring("Code2", 1, 2).try_cast("int").alias("occ_group"),
        S.text_key(F.col("Description")).alias("occp_match"),
    )
    return codes.join(variables, [*by, "occp_match"], "left").select(
        *by, "Code", "Code2", "Description", "occ_group", "occp_match", "acs_var"
    )


def sex_age_lookup(dictionary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sex and age range of each sex-by-age variable; labels without a number are totals and are dropped."""
    label = F.col("label")
    sex = F.when(label.contains("Male"), "Male").otherwise("Female")
    return (
        dictionary.filter(F.col("name").rlike("B01001"))
        .select(
            *by,
            "name",
            "label",
            "concept",
            sex.alias("sex"),
            F.when(label.contains("Under 5"), 0.0).otherwise(S.min_number(label)).alias("age_min"),
            S.max_number(label).alias("age_max"),
        )
        .filter("age_min IS NOT NULL")
        .withColumn("sex_num", F.when(F.col("sex") == "Male", 1).otherwise(2))
    )


def hhsize_type_lookup(dictionary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Household size and type (1 family, 2 nonfamily) of each household-size variable."""
    _, _, l3, l4 = S.label_levels(F.col("label"), 4)
    return dictionary.filter(F.col("name").rlike("B11016") & l4.isNotNull()).select(
        *by,
        "name",
        S.first_number(l4).alias("hh_size"),
        F.when(l3.contains("Nonfamily"), 2).otherwise(1).alias("hh_type"),
    )


def race_eth_lookup(dictionary: DataFrame, by: Sequence[str] = (), leaves_only: bool = True) -> DataFrame:
    """Ethnicity flag and race label of each variable.

    Parts of "two or more races" carry a fifth label level. They repeat their parent's total, so only the four-level
    rows are kept; ``leaves_only=False`` keeps all of them.
    """
    _, _, l3, l4, l5 = S.label_levels(F.col("label"), 5)
    keep = F.col("name").rlike("B03002") & l4.isNotNull()
    if leaves_only:
        keep = keep & l5.isNull()
    return dictionary.filter(keep).select(
        *by, "name", S.if_else(l3.contains("Not Hispanic"), F.lit(0), F.lit(1)).alias("hispanic"), l4.alias("race")
    )


def grade_lookup(dictionary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Survey grade code of each school-grade variable, by its place in name order after the two totals.

    A name that stands twice in one edition stops the query, as the places behind it would be wrong: name the editions
    in ``by``.
    """
    window = Window.partitionBy(*by).orderBy("name")
    again = F.lag("name").over(window) == F.col("name")
    message = F.concat(F.lit("variable stands twice in the dictionary, name its editions in by: "), F.col("name"))
    place = F.when(again, F.raise_error(message).cast("int")).otherwise(F.row_number().over(window))
    codes = F.array(*[F.lit(c) for c in S.GRADE_CODES])
    return (
        dictionary.filter(F.col("name").rlike("B14007_"))
        .withColumn("_place", place)
        .filter("_place > 2")
        .select(*by, "name", "label", F.try_element_at(codes, F.col("_place") - 2).alias("grade"))
    )


def income_lookup(dictionary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Income range of each household-income variable; open ends get 0 and one million."""
    label = F.col("label")
    lowest = F.when(label.contains("Less than"), 0.0).otherwise(S.min_number(S.money(label)))
    highest = F.when(label.contains("or more"), 1e6).otherwise(S.max_number(S.money(label)))
    return (
        dictionary.filter(F.col("name").rlike("B19001_"))
        .select(*by, "name", "label", "concept", lowest.alias("income_min"), highest.alias("income_max"))
        # 12 is the number in "past 12 months", that is, a label without an amount
        .filter("income_min IS NOT NULL AND income_min <> 12")
    )
