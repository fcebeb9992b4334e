"""Which survey columns and which totals table each characteristic comes from."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractweave.functions.local import small_table

# Characteristic, survey columns, totals table.
CHARACTERISTICS = (
    ("Sex", ("SEX",), "B01001"),
    ("Age", ("AGEP",), "B01001"),
    ("Race", ("RAC1P",), "B03002"),
    ("Ethnicity", ("HISP",), "B03002"),
    ("Occupation", ("OCCP",), "S2401"),
    ("Grade", ("SCHG",), "B14007"),
    ("School_Type", ("SCH",), "B14003"),
    ("HH_Income", ("ADJINC", "HINCP"), "B19001"),
    ("HH_Type", ("HHT",), "B11016"),
    ("HH_Size", ("NP",), "B11016"),
)
TABLE_OF = {name: table for name, _, table in CHARACTERISTICS}
TABLE_OF |= {"Hispanic": TABLE_OF["Ethnicity"], "Occ_Group": TABLE_OF["Occupation"]}


def characteristic_map(spark: SparkSession) -> DataFrame:
    names, columns, tables = zip(*CHARACTERISTICS)
    return small_table(
        spark,
        {
            "characteristic": names,
            "pums": [list(c) for c in columns],
            "acs": tables,
            "ord": pa.array(range(len(names)), pa.int32()),
        },
        "characteristic string, pums array<string>, acs string, ord int",
    )


def requested(chars: Sequence[str]) -> list[tuple]:
    """Map entries of the requested characteristics, in the order asked; unknown names are an error."""
    known = {c[0]: c for c in CHARACTERISTICS}
    unknown = [c for c in chars if c not in known]
    if unknown:
        raise ValueError(f"unknown characteristics: {unknown}")
    return [known[c] for c in dict.fromkeys(chars)]


def pums_columns(chars: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(["PUMA", *(col for _, cols, _ in requested(chars) for col in cols)]))


def acs_tables(chars: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(table for _, _, table in requested(chars)))


def resolve_columns(char_map: DataFrame, wanted: DataFrame) -> DataFrame:
    """Survey columns of the characteristics in ``wanted``, one row each."""
    return char_map.join(wanted, "characteristic").select("characteristic", F.explode("pums").alias("column"))


def shared_tables(char_map: DataFrame) -> DataFrame:
    """Distinct totals tables, each named after the characteristics that share it, in their order.

    Repeats are merged before names are gathered, so a group holds each characteristic once.
    """
    entry = F.struct("ord", "characteristic")
    names = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["characteristic"])
    return (
        char_map.groupBy("acs", "characteristic")
        .agg(F.min("ord").alias("ord"))
        .groupBy("acs")
        .agg(F.concat_ws("_", names).alias("name"), F.count("*").alias("n_shared"))
    )


def split_variables(meta: DataFrame, columns: DataFrame | Sequence[str], year: int, survey: str) -> DataFrame:
    """Each survey column as a household or a person variable, by the metadata of one survey."""
    if not isinstance(columns, DataFrame):
        columns = small_table(meta.sparkSession, {"var_code": list(columns)}, "var_code string")
    housing = (
        meta.filter((F.col("year") == year) & (F.col("survey") == survey) & (F.col("level") == "housing"))
        .select("var_code")
        .distinct()
        .withColumn("_housing", F.lit(True))
    )
    kind = F.when(F.col("_housing"), "household").otherwise("person")
    return columns.distinct().join(housing, "var_code", "left").select("var_code", kind.alias("kind"))
