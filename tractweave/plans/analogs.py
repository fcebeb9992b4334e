"""Census-shaped inputs derived from the general test tables, so that every query can run on them at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tractweave.config import DrawConfig
from tractweave.functions.local import small_table
from tractweave.functions.reshape import melt
from tractweave.operators.scale import number_rows
from tractweave.sources.files import SEGMENT_CELLS
from tractweave.sources import lookups as build

# Public variable labels of the totals tables.
_TOTAL = "Estimate!!Total:"
_AGES = (
    "Under 5 years", "5 to 9 years", "10 to 14 years", "15 to 17 years", "18 and 19 years", "20 years", "21 years",
    "22 to 24 years", "25 to 29 years", "30 to 34 years", "35 to 39 years", "40 to 44 years", "45 to 49 years",
    "50 to 54 years", "55 to 59 years", "60 and 61 years", "62 to 64 years", "65 and 66 years", "67 to 69 years",
    "70 to 74 years", "75 to 79 years", "80 to 84 years", "85 years and over",
)
_RACES = (
    "White alone", "Black or African American alone", "American Indian and Alaska Native alone", "Asian alone",
    "Native Hawaiian and Other Pacific Islander alone", "Some other race alone", "Two or more races:",
    "Two or more races:!!Two races including Some other race",
    "Two or more races:!!Two races excluding Some other race, and three or more races",
)
_INCOMES = (
    "Less than $10,000", "$10,000 to $14,999", "$15,000 to $19,999", "$20,000 to $24,999", "$25,000 to $29,999",
    "$30,000 to $34,999", "$35,000 to $39,999", "$40,000 to $44,999", "$45,000 to $49,999", "$50,000 to $59,999",
    "$60,000 to $74,999", "$75,000 to $99,999", "$100,000 to $124,999", "$125,000 to $149,999",
    "$150,000 to $199,999", "$200,000 or more",
)


def _size_labels(kind: str, first: int) -> list[str]:
    names = [f"{i}-person household" for i in range(first, 7)] + ["7-or-more-person household"]
    return [f"{_TOTAL}!!{kind}:", *[f"{_TOTAL}!!{kind}:!!{n}" for n in names]]


def _grade_labels() -> list[str]:
    school = f"{_TOTAL}!!Enrolled in school:"
    grades = ["nursery school, preschool", "kindergarten", *[f"grade {i}" for i in range(1, 13)]]
    grades += ["college, undergraduate years", "graduate or professional school"]
    return [_TOTAL, school, *[f"{school}!!Enrolled in {g}" for g in grades], f"{_TOTAL}!!Not enrolled in school"]


LABELS = {
    "B01001": [_TOTAL, *[f"{_TOTAL}!!{s}:{a}" for s in ("Male", "Female") for a in ("", *[f"!!{x}" for x in _AGES])]],
    "B03002": [
        _TOTAL,
        *[
            f"{_TOTAL}!!{e}:{r}"
            for e in ("Not Hispanic or Latino", "Hispanic or Latino")
            for r in ("", *[f"!!{x}" for x in _RACES])
        ],
    ],
    "B11016": [_TOTAL, *_size_labels("Family households", 2), *_size_labels("Nonfamily households", 1)],
    "B14003": [f"{_TOTAL}!!School variable {i}" for i in range(1, 56)],
    "B14007": _grade_labels(),
    "B19001": [_TOTAL, *[f"{_TOTAL}!!{x}" for x in _INCOMES]],
}
N_OCCUPATIONS = 97


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pad(x: Column, n: int) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def pums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey persons: one per order, household = customer, every twentieth household in group quarters."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = DrawConfig().rows_per_task
    key = F.col("o_orderkey")
    size = orders.groupBy("o_custkey").agg(F.count("*").cast("int").alias("NP"))
    run = F.when(F.col("NP") > rows, F.floor(key / rows).cast("long"))
    numbered = number_rows(orders.join(size, "o_custkey"), ["o_custkey"], ["o_orderkey"], "place", run)
    segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    hht = F.array_position(F.array(*[F.lit(s) for s in segments]), F.col("c_mktsegment")).cast("string")
    kind = F.when(F.col("c_custkey") % 20 == 0, "2019GQ").otherwise("2019HU")
    school = F.when(key % 5 == 0, "b").when(key % 5 < 4, (key % 5).cast("string"))
    return numbered.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(kind, pad(F.col("c_custkey"), 7)).alias("SERIALNO"),
        (F.col("place") + 1).cast("int").alias("SPORDER"),
        pad(F.col("c_nationkey"), 5).alias("PUMA"),
        F.when(F.col("o_orderstatus") == "F", "2").otherwise("1").alias("SEX"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("AGEP"),
        F.substring("o_orderpriority", 1, 1).alias("RAC1P"),
        F.when(key % 4 == 0, "02").otherwise("01").alias("HISP"),
        F.when(key % 3 == 0, "0009").otherwise(pad(key % N_OCCUPATIONS, 4)).alias("OCCP"),
        F.when(key % 17 == 0, "bb").otherwise(pad(key % 17, 2)).alias("SCHG"),
        school.alias("SCH"),
        F.lit("1.01").alias("ADJINC"),
        (F.col("c_acctbal") * 20).alias("HINCP"),
        hht.alias("HHT"),
        "NP",
    )


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tract per supplier, one PUMA per nation."""
    both = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return build.crosswalk_lookup(
        both.select(
            pad(F.col("n_regionkey"), 2).alias("STATEFP"),
            pad(F.col("n_nationkey"), 3).alias("COUNTYFP"),
            pad(F.col("s_suppkey"), 6).alias("TRACTCE"),
            pad(F.col("n_nationkey"), 5).alias("PUMA5CE"),
        )
    )


def tract_pumas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crosswalk with PUMAs named as in ``pums``: nation numbers do not repeat from region to region."""
    return crosswalk(spark, sf_dir).withColumn("PUMA", F.col("PUMA5CE"))


def pumas_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State (region) and PUMA code of each county (nation) when every state numbers its PUMAs from 1."""
    place = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    return table(spark, sf_dir, "nation").select(
        pad(F.col("n_nationkey"), 3).alias("COUNTYFP"), pad(F.col("n_regionkey"), 2).alias("ST"), pad(place, 5).alias("place")
    )


def state_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crosswalk where every state numbers its PUMAs from 1."""
    pumas = pumas_by_region(spark, sf_dir).select("COUNTYFP", "place")
    return crosswalk(spark, sf_dir).join(pumas, "COUNTYFP").withColumn("PUMA5CE", F.col("place")).drop("place")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosswalk(spark, sf_dir).select(F.col("CTFP").alias("GEOID"))


def acs(spark: SparkSession, sf_dir: str, tables: Sequence[str] | None = None) -> DataFrame:
    """Area totals: quantities by supplier tract and by a variable taken from the part number.

    One value per table is unknown in tracts that end in 7.
    """
    names = list(tables or [*LABELS, "S2401"])
    codes = [
        F.struct(
            F.lit(i).alias("t"),
            (F.col("l_partkey") % (N_OCCUPATIONS if n == "S2401" else len(LABELS[n]))).cast("int").alias("code"),
        )
        for i, n in enumerate(names)
    ]
    # summed on numbers first: codes become text and suppliers tracts on the few rows that are left. Lines go to their supplier
    # once, before each becomes a row per table
    totals = (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", "l_partkey", "l_quantity")
        .filter("l_suppkey IS NOT NULL")
        .repartition("l_suppkey")
        .select("l_suppkey", "l_quantity", F.explode(F.array(*codes)).alias("v"))
        .groupBy("l_suppkey", "v.t", "v.code")
        .agg(F.sum("l_quantity").alias("estimate"))
    )
    tract = F.concat(pad(F.col("n_regionkey"), 2), pad(F.col("n_nationkey"), 3), pad(F.col("s_suppkey"), 6))
    tracts = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), tract.alias("GEOID"))
    )
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("t") + 1)
    number = F.when(name == "S2401", F.concat(F.lit("S2401_C01_"), pad(F.col("code"), 3))).otherwise(
        F.concat(name, F.lit("_"), pad(F.col("code") + 1, 3))
    )
    unknown = F.col("variable").endswith("_007") & F.col("GEOID").endswith("7")
    return (
        totals.join(tracts, "l_suppkey")
        .select(name.alias("table_id"), "GEOID", number.alias("variable"), "estimate")
        .withColumn("estimate", F.when(~unknown, F.col("estimate")))
    )


def dictionary(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Variable dictionary of one table in many editions: parts in order fill edition after edition."""
    n = len(LABELS[name])
    labels = small_table(spark, {"place": list(range(n)), "label": LABELS[name]}, "place long, label string")
    return (
        table(spark, sf_dir, "part")
        .select(F.floor(F.col("p_partkey") / n).cast("int").alias("edition"), (F.col("p_partkey") % n).alias("place"))
        .join(labels, "place")
        .select(
            "edition",
            F.concat(F.lit(f"{name}_"), pad(F.col("place") + 1, 3)).alias("name"),
            "label",
            F.lit("CONCEPT IN THE PAST 12 MONTHS").alias("concept"),
        )
    )


def variables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Dictionary of one table without editions."""
    return dictionary(spark, sf_dir, name).select("name", "label", "concept").distinct()


def subject_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupation variables, one per part, labels four to six levels deep and some too shallow."""
    k = F.col("p_partkey")
    text = F.concat(F.upper("p_name"), F.lit(" & "), F.col("p_type"), F.lit(" ("), k.cast("string"), F.lit(")"))
    deep = F.when(k % 3 == 0, "").when(k % 3 == 1, "Management:!!").otherwise("Management:!!Business:!!")
    label = F.when(k % 11 == 0, "Estimate!!Total").otherwise(
        F.concat(F.lit("Estimate!!Total!!Civilian employed!!"), deep, text)
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("S2401_C01_"), pad(k, 7)).alias("name"), label.alias("label"), F.lit("OCCUPATION").alias("concept")
    )


def codelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupation code list, one entry per part; some without code, some with a long or non-numeric group."""
    k = F.col("p_partkey")
    text = F.concat(F.col("p_name"), F.lit(", "), F.lower("p_type"), F.lit(" #"), k.cast("string"))
    group = F.concat((F.col("p_size") + 10).cast("string"), F.lit("-"), pad(k % 10000, 4))
    return table(spark, sf_dir, "part").select(
        F.when(k % 13 != 0, pad(k, 7)).alias("Code"),
        F.when(k % 19 == 0, "none").when(k % 10 == 9, F.concat(group, F.lit(",9999"))).otherwise(group).alias("Code2"),
        F.when(k % 7 == 0, F.concat(F.lit("Other "), text)).otherwise(text).alias("Description"),
    )


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupation lookup used by seeds and targets; some codes repeated, one missing, military without totals."""
    c = F.col("p_partkey") % N_OCCUPATIONS
    group = (c % 23) * 2 + 11
    rows = (
        table(spark, sf_dir, "part")
        .select(
            pad(c, 4).alias("Code"),
            F.when(c % 10 == 9, "11-1021,1022").otherwise("11-1021").alias("Code2"),
            group.cast("int").alias("occ_group"),
            F.when(group != 55, F.concat(F.lit("S2401_C01_"), pad(c, 3))).alias("acs_var"),
            F.col("p_type").alias("Description"),
        )
        .distinct()
    )
    return rows.filter("Code <> '0096'")


def lookups(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The named lookup tables, built from the dictionaries."""
    builders = {
        "hhsize_type": lambda: build.hhsize_type_lookup(variables(spark, sf_dir, "B11016")),
        "hhincome": lambda: build.income_lookup(variables(spark, sf_dir, "B19001")),
        "sex_by_age": lambda: build.sex_age_lookup(variables(spark, sf_dir, "B01001")),
        "race_eth": lambda: build.race_eth_lookup(variables(spark, sf_dir, "B03002")),
        "grade": lambda: build.grade_lookup(variables(spark, sf_dir, "B14007")),
        "occp": lambda: occupations(spark, sf_dir),
    }
    return {n: builders[n]() for n in names}


def segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """63 cells per record: line counts by supplier, cell from the part number."""
    cells = range(1, SEGMENT_CELLS + 1)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("LOGRECNO"), (F.col("l_partkey") % SEGMENT_CELLS + 1).alias("cell")
    )
    wide = lines.groupBy("LOGRECNO").pivot("cell", list(cells)).count()
    return wide.selectExpr("LOGRECNO", *[f"CAST(coalesce(`{i}`, 0) AS double) AS P04300{i:02d}" for i in cells])


def geo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width geography: a line per tract, county and state; apostrophe and # in names, some bad record numbers."""
    xw = crosswalk(spark, sf_dir)

    def line(level: str, record: Column, state: Column, county: Column, tract: Column, name: Column) -> Column:
        return F.concat(
            F.lit("SF1ST   "), F.lit(level), F.lit("       "), record, F.lit("  "), state, county, F.lit(" " * 22), tract, name
        )

    tract_no = F.col("TRACTCE")
    record = F.when(tract_no.endswith("3"), F.concat(F.lit("x"), tract_no)).otherwise(F.concat(F.lit("0"), tract_no))
    blank = F.lit(" ")
    tracts = xw.select(
        line("140", record, F.col("STATEFP"), F.col("COUNTYFP"), tract_no, F.lit(" Tract #1 O'Brien")).alias("value")
    )
    counties = (
        xw.groupBy("STATEFP", "COUNTYFP")
        .agg(F.min("TRACTCE").alias("t"))
        .select(
            line("050", F.concat(F.lit("5"), "t"), F.col("STATEFP"), F.col("COUNTYFP"), F.repeat(blank, 6), F.lit(" County")).alias("value")
        )
    )
    states = (
        xw.groupBy("STATEFP")
        .agg(F.min("TRACTCE").alias("t"))
        .select(
            line("040", F.concat(F.lit("4"), "t"), F.col("STATEFP"), F.repeat(blank, 3), F.repeat(blank, 6), F.lit(" State")).alias("value")
        )
    )
    return tracts.unionByName(counties).unionByName(states)


def residence(spark: SparkSession, sf_dir: str, hh_seed: DataFrame) -> DataFrame:
    """True home tract of each seed household: the tracts of a PUMA in turn, by household number."""
    rows = DrawConfig().rows_per_task
    xw = crosswalk(spark, sf_dir).select(
        F.col("PUMA5CE").alias("PUMA"), F.col("CTFP").alias("GEOID"), F.col("TRACTCE").cast("long").alias("tract")
    )
    sizes = xw.groupBy("PUMA").agg(F.count("*").alias("n_tracts"))
    run = F.when(F.col("n_tracts") > rows, F.floor(F.col("tract") / rows).cast("long"))
    homes = number_rows(xw.join(sizes, "PUMA"), ["PUMA"], ["GEOID"], "place", run)
    number = F.substring("SERIALNO", 7, 7).cast("long")
    sized = hh_seed.select("SERIALNO", "PUMA", number.alias("number")).join(sizes, "PUMA")
    return (
        sized.withColumn("place", F.col("number") % F.col("n_tracts"))
        .join(homes.select("PUMA", "place", "GEOID"), ["PUMA", "place"])
        .select("SERIALNO", "GEOID")
    )


def true_targets(spark: SparkSession, sf_dir: str, seed: DataFrame, homes: DataFrame, attrs: Sequence[str], times: int = 5):
    """Targets that some weights reproduce exactly: a multiple of the counts by true home tract."""
    rows = melt(seed.join(homes, "SERIALNO"), ["GEOID"], attrs)
    return (
        rows.filter("level IS NOT NULL")
        .groupBy("GEOID", "attr", "level")
        .agg((F.count("*") * times).cast("double").alias("target"))
    )
