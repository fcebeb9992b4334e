"""Regions as tables, outcomes, counts from draws, hot households, versions of lookups and states."""

import pytest
from pyspark.sql import functions as F

from tractweave.operators import areas, regions, seeds, validate
from tractweave.operators.draw import expand_persons
from tractweave.sources import files

CODES = ["01", "01001", "01001000100", "02013", "0201", "99999", None, ""]


@pytest.fixture(scope="module")
def coded(spark):
    return spark.createDataFrame([(c,) for c in CODES], "GEOID string")


def inside(df):
    return sorted(r.GEOID for r in df.collect())


def test_regions_of_mixed_and_nested_prefixes(spark, coded):
    table = spark.createDataFrame([("01001",), ("0100",), ("020",), ("0100",), (None,), ("7",)], "prefix string")
    want = ["01001", "01001000100", "0201", "02013"]
    assert inside(regions.in_regions(coded, table)) == want
    assert sorted(r.prefix for r in regions.region_table(table).collect()) == ["0100", "020", "7"]
    many = [f"{i:04d}" for i in range(90, 300)]
    assert inside(regions.in_regions(coded, many)) == [c for c in sorted(filter(None, CODES)) if c[:4] in many]


def test_regions_given_otherwise(spark, coded):
    assert inside(regions.in_regions(coded, "01")) == inside(regions.in_regions(coded, ["01"])) == ["01", "01001", "01001000100"]
    assert regions.in_regions(coded, None).count() == len(CODES)
    assert regions.in_regions(coded, []).count() == 0
    assert regions.in_regions(coded, spark.createDataFrame([], "prefix string")).count() == 0
    assert regions.in_regions(coded, spark.createDataFrame([("",)], "prefix string")).count() == len(CODES) - 1


def test_plan_does_not_grow_with_the_region(spark, coded):
    def joins(n):
        table = spark.createDataFrame([(f"{i:05d}",) for i in range(n)], "prefix string")
        plan = regions.in_regions(coded, table)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join"), plan.count("StartsWith")

    assert joins(3) == joins(3000) and joins(3)[1] == 0


def test_area_outcomes(spark):
    asked = spark.createDataFrame([("01001000001",), ("01001000002",), ("01001000003",), ("05001000009",)], "GEOID string")
    xw = spark.createDataFrame([("01001000001", "A"), ("01001000002", "B"), ("01001000003", "A")], "CTFP string, PUMA string")
    targets = spark.createDataFrame([("01001000001", "x", "1", 3.0), ("01001000002", "x", "1", 1.0), ("01001000003", "x", "1", None)], "GEOID string, attr string, level string, target double")
    hh = spark.createDataFrame([("h1", "A"), ("h2", "B")], "SERIALNO string, PUMA string")
    persons = spark.createDataFrame([("h1",)], "SERIALNO string")
    got = {r.GEOID: r.reason for r in areas.area_outcomes(asked, xw, targets, hh, persons).collect()}
    assert got == {"01001000002": areas.NO_SEED, "01001000003": areas.NO_TARGET, "05001000009": 7}
    assert areas.area_outcomes(asked.limit(0), xw, targets, hh).count() == 0


def test_dropped_persons(spark):
    pums = spark.createDataFrame([("2019HU1", "A", "11"), ("2019HU2", "A", "55"), ("2019GQ3", "A", "77"), ("2019HU4", "A", "0009"), ("2019HU5", "A", None)], "SERIALNO string, PUMA string, OCCP string")
    occp = spark.createDataFrame([("11", 11), ("55", 55)], "Code string, occ_group int")
    got = {(r.in_gq, r.reason): r.persons for r in seeds.dropped_persons(pums, occp).collect()}
    assert got == {(False, seeds.MILITARY): 1, (True, seeds.UNMATCHED): 1, (False, seeds.UNMATCHED): 1}


def drawn(spark, times):
    draws = spark.sql(f"SELECT 'A' AS GEOID, id + 1 AS new_id, 'h1' AS SERIALNO FROM range({times})")
    more = spark.createDataFrame([("B", 1, "h2"), ("B", 2, "h1")], "GEOID string, new_id long, SERIALNO string")
    hh = spark.createDataFrame([("h1", 2), ("h2", None)], "SERIALNO string, HH_Size int")
    persons = spark.createDataFrame([("h1", 1, "m"), ("h1", 2, None), ("h2", 1, "f")], "SERIALNO string, SPORDER int, Sex string")
    return draws.unionByName(more), hh, persons


def test_counts_of_draws_are_those_of_the_expanded_persons(spark):
    draws, hh, persons = drawn(spark, 5)
    expanded = expand_persons(draws, persons, ["HH_Size", "Sex"], hh=hh)
    got = validate.drawn_counts(draws, hh, persons, ["HH_Size"], ["Sex"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, validate.generated_counts(expanded, ["HH_Size", "Sex"]).collect()))


def test_a_household_drawn_very_often_is_spread(spark):
    draws, hh, persons = drawn(spark, 200_000)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = expand_persons(draws, persons, ["Sex"])
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 400_000 + 3 and len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_lookup_versions(spark, tmp_path):
    path = str(tmp_path / "lookup")
    one, two = (spark.range(n) for n in (3, 4))
    files.save_lookup(one, path)
    assert files.load_lookup(spark, path).count() == 3
    with pytest.raises(Exception, match="write died"):
        files.save_lookup(two.withColumn("id", F.raise_error(F.lit("write died")).cast("long")), path)
    assert files.load_lookup(spark, path).count() == 3
    files.save_lookup(two, path)
    assert files.load_lookup(spark, path).count() == 4
    one.write.parquet(str(tmp_path / "plain"))
    assert files.load_lookup(spark, str(tmp_path / "plain")).count() == 3


@pytest.mark.parametrize("folder", ["CA", "06"])
def test_states_by_letters_or_numbers(spark, tmp_path, folder):
    rows = spark.createDataFrame([("s1", 1, "00101", "1", folder, 2019), ("s2", 1, "00101", "2", "72" if folder == "06" else "PR", 2019)], "SERIALNO string, SPORDER int, PUMA string, SEX string, state string, year int")
    path = str(tmp_path / "pums")
    rows.write.partitionBy("state", "year").parquet(path)
    frame = spark.createDataFrame([("ca",)], "state string")
    for states in (["CA"], ["06"], ["6"], frame):
        got = files.read_pums(spark, path, ["Sex"], states, 2019).collect()
        assert [(r.SERIALNO, r.PUMA) for r in got] == [("s1", "0600101")]
    with pytest.raises(ValueError):
        files.read_pums(spark, path, ["Sex"], ["ZZ"])
