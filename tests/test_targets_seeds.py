from tractweave.config import canonical
from tractweave.functions.reshape import lengthen, roll_up, widen
from tractweave.functions.scalars import strict_sum
from tractweave.operators import gq, seeds, targets
from pyspark.sql import functions as F
import pytest


def test_occupation_residual_rules(spark):
    acs = spark.createDataFrame(
        [
            ("B01001", "01", "B01001_001", 100.0),
            ("S2401", "01", "v1", 30.0),
            ("S2401", "01", "v2", 20.0),
            ("S2401", "01", "long", 50.0),
            ("B01001", "02", "B01001_001", 80.0),  # no occupation rows: everyone is left over
            ("B01001", "03", "B01001_001", 70.0),
            ("S2401", "03", "v1", None),  # unknown part: unknown rest
            ("S2401", "04", "v1", 5.0),  # no population: no rest
        ],
        "table_id string, GEOID string, variable string, estimate double",
    )
    occp = spark.createDataFrame(
        [("a", "11-1", 11, "v1"), ("b", "11-1", 11, "v1"), ("c", "13-1", 13, "v2"), ("d", "13-1011,1021", 13, "long"), ("e", "15-1", 15, None)],
        "Code string, Code2 string, occ_group int, acs_var string",
    )
    got = {(r.GEOID, r.level): r.target for r in targets.person_targets(acs, {"occp": occp}, ["Occupation"]).collect()}
    assert got == {
        ("01", "11"): 30.0,
        ("01", "13"): 20.0,
        ("01", "99"): 50.0,
        ("02", "99"): 80.0,
        ("03", "11"): None,
        ("03", "99"): None,
        ("04", "11"): 5.0,
    }
    only = targets.person_targets(acs, {"occp": occp}, ["Occupation"], fips=["02", "04"]).collect()
    assert {r.GEOID for r in only} == {"02", "04"}


def test_aliases():
    assert canonical(["Ethnicity", "Occupation", "Age", "Hispanic"]) == ["Hispanic", "Occ_Group", "Age"]
    with pytest.raises(ValueError):
        canonical(["Shoe_Size"])


def test_wide_long_and_roll_up(spark):
    rows = [("0101", "A", "1", 2.0), ("0101", "A", "2", 3.0), ("0102", "A", "1", 4.0)]
    long = spark.createDataFrame(rows, "GEOID string, attr string, level string, target double")
    wide = widen(long, "A", [1, 2])
    assert sorted(tuple(r) for r in wide.collect()) == [("0101", 2.0, 3.0), ("0102", 4.0, None)]
    back = {(r.GEOID, r.level): r.target for r in lengthen(wide, "A").collect()}
    assert back[("0102", "2")] is None and back[("0101", "2")] == 3.0
    up = {(r.GEOID, r.level): r.target for r in roll_up(long, 2, strict_sum(F.col("target"))).collect()}
    assert up == {("01", "1"): 6.0, ("01", "2"): 3.0}


def test_gq_correction_clamps_and_reports(spark):
    t = spark.createDataFrame(
        [("1", "Sex", "1", 10.0), ("1", "Sex", "2", 3.0), ("1", "Age", "1", None)], "GEOID string, attr string, level string, target double"
    )
    g = spark.createDataFrame([("1", "Sex", "2", 5), ("1", "Sex", "3", 9)], "GEOID string, attr string, level string, gq_count long")
    got = {(r.attr, r.level): (r.target, r.shortfall) for r in targets.subtract_gq(t, g).collect()}
    assert got == {("Sex", "1"): (10.0, 0.0), ("Sex", "2"): (0.0, 2.0), ("Age", "1"): (None, 0.0)}


PUMS = "SERIALNO string, SPORDER int, PUMA string, SEX string, AGEP int, RAC1P string, HISP string, OCCP string, SCHG string, SCH string, ADJINC string, HINCP double, HHT string, NP int"


def pums(spark):
    return spark.createDataFrame(
        [
            ("H1", 2, "1", "2", 150, "4", "02", "0009", "bb", "b", "1.1", 50000.0, "4", 9),
            ("H1", 1, "1", "1", 40, "1", "01", "0100", "05", "2", "1.1", 50000.0, "4", 9),
            ("H1", 3, "1", "1", 10, "1", None, "0200", "05", None, "1.1", 50000.0, None, 9),
            ("H2", 1, "2", "1", 20, "6", "01", "9999", "05", "3", "x", 50000.0, None, None),
            ("2GQ1", 1, "1", "1", 65, "5", "01", "0100", "bb", "1", "1.0", None, None, 1),
        ],
        PUMS,
    )


def occupations(spark):
    return spark.createDataFrame([("0100", 11), ("0100", 11), ("0200", 55)], "Code string, occ_group int")


def test_household_seed(spark):
    got = {r.SERIALNO: r for r in seeds.hh_seed(pums(spark)).collect()}
    assert set(got) == {"H1", "H2"}
    assert (got["H1"].SPORDER, got["H1"].HH_Size, got["H1"].HH_Type, got["H1"].HH_Income) == (1, 7, 2, 2)
    assert (got["H2"].HH_Size, got["H2"].HH_Type, got["H2"].HH_Income) == (None, 2, None)
    assert [r.SERIALNO for r in seeds.hh_seed(pums(spark), ["2"], ["NP"]).collect()] == ["H2"]


def test_person_seed(spark):
    got = {(r.SERIALNO, r.SPORDER): r for r in seeds.person_seed(pums(spark), occupations(spark)).collect()}
    assert set(got) == {("H1", 1), ("H1", 2)}  # military and unmatched persons are out
    r = got[("H1", 2)]
    assert (r.Age, r.Race, r.Hispanic, r.School_Type, r.Grade, r.Sex, r.Occ_Group) == (9, "3", 1, "non", "bb", "2", 99)
    assert seeds.person_seed(pums(spark), p_vars=["SEX", "SEX"]).columns == ["SERIALNO", "SPORDER", "PUMA", "Sex"]


def test_gq_seed_and_cleaning(spark):
    seed = seeds.gq_seed(pums(spark))
    r = seed.collect()[0]
    assert (r.GQ_Sex, r.GQ_Age, r.GQ_Type) == ("1", 3, "NonInst")
    pop = seed.withColumns({"GEOID": F.lit("06"), "new_id": F.lit(4).cast("long"), "p_id": F.lit("06GQ4")})
    clean = gq.gq_clean(pop, occupations(spark), ["Race", "HH_Size", "HH_Type", "HH_Income", "Occupation"]).collect()[0]
    assert clean.hhid == "06_GQ_NonInst_4" and clean.HH_Type == "GQ_NonInst" and clean.HH_Income == "0" and clean.HH_Size is None
    assert clean.Race == "3" and clean.Occ_Group == "11"
    idle = pop.withColumn("OCCP", F.lit("0009"))
    assert gq.gq_clean(idle, occupations(spark), ["Occupation"]).count() == 1  # not working is kept
    sums = {(x.attr, x.level): x.gq_count for x in gq.gq_marginals(idle, occupations(spark), ["Occupation", "Sex"]).collect()}
    assert sums == {("Occ_Group", "99"): 1, ("Sex", "1"): 1}
