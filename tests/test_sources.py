import pytest
from pyspark.sql import functions as F

from tractweave.operators.areas import area_pools, area_pumas
from tractweave.operators.gq import gq_totals, keep_level
from tractweave.sources import characteristics as C
from tractweave.sources import files, lookups


def geo_line(level, record, state, county, tract, name):
    return "SF1ST   " + level + " " * 7 + record.rjust(7, "0") + "  " + state + county.ljust(3) + " " * 22 + tract.ljust(6) + name


def test_state_files_round_trip(spark, tmp_path):
    lines = [
        geo_line("140", "12", "06", "075", "010100", " Tract 'one' # x"),
        geo_line("140", "x2", "06", "075", "010200", ' Tract "two"'),
        geo_line("050", "3", "06", "075", "", " County"),
        geo_line("040", "4", "06", "", "", " State"),
    ]
    (tmp_path / "ca2010geo.txt").write_text("\n".join(lines) + "\n")
    row = ["SF", "CA", "000", "06", "0000012", *["0"] * 173, *[str(i) for i in range(1, 64)], "9"]
    (tmp_path / "ca000062010.txt").write_text(",".join(row) + "\n")
    geo = files.read_geo(spark, str(tmp_path / "ca2010geo.txt"))
    got = {r.GEOID: (r.LOGRECNO, r.SUMLEV, r.state) for r in geo.collect()}
    assert got == {
        "06075010100": (12, "140", "CA"),
        "06075010200": (None, "140", "CA"),
        "06075": (3, "050", "CA"),
        "06": (4, "040", "CA"),
    }
    segment = files.read_segment(spark, [str(tmp_path / "ca000062010.txt")])
    totals = gq_totals(geo, segment, "Tract").filter(F.col("LOGRECNO") == 12).collect()
    assert {r.variable: r.estimate for r in totals} == {
        f"P04300{i:02d}": float(i) for i in (4, 9, 14, 19, 24, 29, 35, 40, 45, 50, 55, 60)
    }
    assert [r.GEOID for r in keep_level(geo, "County").collect()] == ["06075"]
    assert [r.GEOID for r in keep_level(geo, "State").collect()] == ["06"]
    with pytest.raises(ValueError):
        keep_level(geo, "Block")


def test_microdata_and_totals_readers_prune(spark, tmp_path):
    pums = spark.createDataFrame(
        [("1", 1, "00101", "1", 30, "CA", 2019, "acs5"), ("2", 1, "00102", "2", 40, "NY", 2019, "acs5")],
        "SERIALNO string, SPORDER int, PUMA string, SEX string, AGEP int, state string, year int, survey string",
    )
    pums.write.partitionBy("state", "year", "survey").parquet(str(tmp_path / "pums"))
    df = files.read_pums(spark, str(tmp_path / "pums"), ["Sex", "Age"], ["CA"], 2019, "acs5")
    assert df.columns == ["SERIALNO", "SPORDER", "PUMA", "SEX", "AGEP"]
    assert [tuple(r) for r in df.collect()] == [("1", 1, "0600101", "1", 30)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HINCP" not in plan and "PartitionFilters: [isnotnull(state" in plan

    acs = spark.createDataFrame(
        [("B01001", "tract", "CA", 2019, "acs5", "06075010100", "B01001_001", 5.0), ("B19001", "tract", "CA", 2019, "acs5", "06075010100", "B19001_001", 2.0)],
        "table_id string, level string, state string, year int, survey string, GEOID string, variable string, estimate double",
    )
    acs.write.partitionBy("table_id", "level", "state", "year", "survey").parquet(str(tmp_path / "acs"))
    got = files.read_acs(spark, str(tmp_path / "acs"), ["Sex", "Age"], "Tract", ["CA"], 2019, "acs5").collect()
    assert [r.variable for r in got] == ["B01001_001"]
    with pytest.raises(ValueError):
        files.select_acs(acs, ["Shoe_Size"])


def test_csv_sources_and_lookup_store(spark, tmp_path):
    (tmp_path / "xw.csv").write_text("STATEFP,COUNTYFP,TRACTCE,PUMA5CE\n06,075,010100,07501\n")
    xw = lookups.crosswalk_lookup(files.read_crosswalk(spark, str(tmp_path / "xw.csv")))
    assert [(r.STCNTYFP, r.CTFP) for r in xw.collect()] == [("06075", "06075010100")]
    assert [r.PUMA for r in lookups.pumas_of(xw, "06075").collect()] == ["0607501"]
    (tmp_path / "codes.csv").write_text('Code,SOC,Text\n0010,11-1011,"Chief executives, and legislators"\n,11,Heading\n0020,11-1021,Managers\n')
    (tmp_path / "vars.csv").write_text(
        "name,label,concept\n"
        'S2401_C01_005,"Estimate!!Total!!Civilian:!!Chief Executives and Legislators",OCC\n'
        "S2401_C01_001,Estimate!!Total,OCC\n"
    )
    occ = lookups.occupation_lookup(
        files.read_codelist(spark, str(tmp_path / "codes.csv")), files.read_dictionary(spark, str(tmp_path / "vars.csv"))
    )
    got = {r.Code: (r.occ_group, r.acs_var) for r in occ.collect()}
    assert got == {"0010": (11, "S2401_C01_005"), "0020": (11, None)}
    for _ in range(2):
        files.save_lookup(occ, str(tmp_path / "occ"))
    assert files.load_lookup(spark, str(tmp_path / "occ")).count() == 2


def test_microdata_csv_goes_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text("PUMA,SERIALNO,SPORDER,AGEP,ST,SEX,EXTRA\n00101,33,1,2,36,1,x\n00101,34,1,5,6,2,y\n")
    got = files.read_pums(spark, str(tmp_path / "p.csv"), ["Sex", "Age"], fmt="csv")
    assert sorted(tuple(r) for r in got.collect()) == [("33", 1, "3600101", "1", 2), ("34", 1, "0600101", "2", 5)]
    (tmp_path / "q.csv").write_text("PUMA,SERIALNO,SPORDER,AGEP,SEX\n101,33,1,2,1\n")
    got = files.read_pums(spark, str(tmp_path / "q.csv"), ["Sex", "Age"], fmt="csv", state="ca")
    assert [tuple(r) for r in got.collect()] == [("33", 1, "0600101", "1", 2)]
    for bad in ({}, {"state": "CA", "states": ["CA"]}, {"state": "CA", "year": 2019}):
        with pytest.raises(ValueError, match="has no column"):
            files.read_pums(spark, str(tmp_path / "q.csv"), ["Sex", "Age"], fmt="csv", **bad)
    with pytest.raises(ValueError, match="has no column NP"):
        files.read_pums(spark, str(tmp_path / "q.csv"), ["HH_Size"], fmt="csv", state="CA")


def test_state_from_file_names(spark, tmp_path):
    for name in ("cageo2010.sf1", "part-00000.txt", "2010_geo_ca.txt", "zz1.txt"):
        (tmp_path / name).write_text("x\n")
    assert sorted(r.state or "" for r in files.read_lines(spark, str(tmp_path)).collect()) == ["", "", "", "CA"]
    assert {r.state for r in files.read_lines(spark, str(tmp_path), "ny").collect()} == {"NY"}


def test_pools_of_two_states_with_one_puma_code(spark):
    rows = [("06", "075", "010100", "00101"), ("36", "001", "000100", "00101")]
    xw = lookups.crosswalk_lookup(spark.createDataFrame(rows, "STATEFP string, COUNTYFP string, TRACTCE string, PUMA5CE string"))
    pumas = area_pumas(xw.selectExpr("CTFP AS GEOID"), xw)
    pools = {r.GEOID: r.pool for r in area_pools(pumas)[0].collect()}
    assert pools == {"06075010100": "P0600101", "36001000100": "P3600101"}


def test_grades_of_two_editions(spark):
    rows = [(f"B14007_{i:03d}", str(i), "c", e) for i in range(1, 5) for e in (2018, 2019)]
    both = spark.createDataFrame(rows, "name string, label string, concept string, edition int")
    got = {(r.name, r.edition): r.grade for r in lookups.grade_lookup(both, ["edition"]).collect()}
    assert got == {(f"B14007_{i:03d}", e): f"{i - 2:02d}" for i in (3, 4) for e in (2018, 2019)}
    with pytest.raises(Exception, match="stands twice"):
        lookups.grade_lookup(both).collect()


def test_lookup_builders(spark):
    def dictionary(*rows):
        return spark.createDataFrame([(n, x, "c") for n, x in rows], "name string, label string, concept string")

    t = "Estimate!!Total:"
    ages = lookups.sex_age_lookup(
        dictionary(("B01001_001", t), ("B01001_003", f"{t}!!Male:!!Under 5 years"), ("B01001_049", f"{t}!!Female:!!85 years and over"))
    )
    assert sorted((r.name, r.age_min, r.age_max, r.sex_num) for r in ages.collect()) == [
        ("B01001_003", 0.0, 5.0, 1),
        ("B01001_049", 85.0, 85.0, 2),
    ]
    races = dictionary(
        ("B03002_009", f"{t}!!Not Hispanic or Latino:!!Two or more races:"),
        ("B03002_010", f"{t}!!Not Hispanic or Latino:!!Two or more races:!!Two races including Some other race"),
        ("B03002_013", f"{t}!!Hispanic or Latino:!!White alone"),
    )
    assert sorted((r.name, r.hispanic) for r in lookups.race_eth_lookup(races).collect()) == [("B03002_009", 0), ("B03002_013", 1)]
    assert lookups.race_eth_lookup(races, leaves_only=False).count() == 3
    grades = lookups.grade_lookup(dictionary(*[(f"B14007_{i:03d}", str(i)) for i in range(1, 20)]))
    got = {r.name: r.grade for r in grades.collect()}
    assert len(got) == 17 and got["B14007_003"] == "01" and got["B14007_018"] == "16" and got["B14007_019"] == "bb"
    income = lookups.income_lookup(
        dictionary(("B19001_001", "Estimate!!Total (in the past 12 months)"), ("B19001_002", "x!!Less than $10,000"), ("B19001_017", "x!!$200,000 or more"))
    )
    assert sorted((r.income_min, r.income_max) for r in income.collect()) == [(0.0, 10000.0), (200000.0, 1000000.0)]


def test_characteristics(spark):
    assert C.pums_columns(["HH_Income", "Sex"]) == ["PUMA", "ADJINC", "HINCP", "SEX"]
    assert C.acs_tables(["Sex", "Age", "Race"]) == ["B01001", "B03002"]
    names = {r.acs: r.name for r in C.shared_tables(C.characteristic_map(spark)).collect()}
    assert names["B01001"] == "Sex_Age" and names["B11016"] == "HH_Type_HH_Size" and names["S2401"] == "Occupation"
    meta = spark.createDataFrame(
        [("NP", "housing", 2019, "acs5"), ("SEX", "person", 2019, "acs5"), ("SEX", "housing", 2018, "acs5")],
        "var_code string, level string, year int, survey string",
    )
    got = {r.var_code: r.kind for r in C.split_variables(meta, ["NP", "SEX", "ZZ"], 2019, "acs5").collect()}
    assert got == {"NP": "household", "SEX": "person", "ZZ": "person"}
