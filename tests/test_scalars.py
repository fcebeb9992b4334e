from pyspark.sql import functions as F

from tractweave.functions import scalars as S


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_cut_left_edges(spark):
    rows = [(x,) for x in (-1.0, 0.0, 9.9, 10.0, 20.0, 20.1, None)]
    x = F.col("x")
    assert values(spark, rows, "x double", S.cut_left(x, (0, 10, 20))) == [None, 1, 1, 2, None, None, None]
    assert values(spark, rows, "x double", S.cut_left(x, (0, 10, 20), True)) == [None, 1, 1, 2, 2, None, None]


def test_null_rules(spark):
    rows = [("1",), ("9",), (None,)]
    x = F.col("x")
    assert values(spark, rows, "x string", S.is_in(x, ("1",))) == [True, False, False]
    assert values(spark, rows, "x string", S.if_else(x == "1", F.lit(1), F.lit(0))) == [1, 0, None]
    assert values(spark, rows, "x string", S.household_type(x)) == [1, 2, 2]
    assert values(spark, rows, "x string", S.condense_race(x)) == ["1", "9", None]
    assert values(spark, [("01",), ("24",), (None,)], "x string", S.hispanic_flag(x)) == [0, 1, None]
    assert values(spark, [(3,), (7,), (12,), (None,)], "x int", S.top_code(x)) == [3, 7, 7, None]


def test_strict_sum(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", None)], "k string, x double")
    got = {r.k: r.s for r in df.groupBy("k").agg(S.strict_sum(F.col("x")).alias("s")).collect()}
    assert got == {"a": 3.0, "b": None}


def test_school_and_gq_type(spark):
    x = F.col("x")
    rows = [("b",), ("1",), ("2",), ("3",), ("4",), (None,)]
    assert values(spark, rows, "x string", S.school_type(x)) == ["non", "non", "pub", "pvt", None, None]
    pairs = [("bb", "0009"), ("bb", "9920"), ("bb", "1234"), ("12", "0009"), (None, "0009"), (None, "1234"), ("bb", None)]
    got = values(spark, pairs, "s string, o string", S.gq_type(F.col("s"), F.col("o")))
    assert got == ["Inst", "Inst", "NonInst", "NonInst", None, "NonInst", "NonInst"]


def test_cell_codes(spark):
    rows = [(i,) for i in S.GQ_CELLS]
    v = S.gq_variable(F.col("i"))
    assert values(spark, rows, "i int", S.gq_cell_sex(v)) == [1] * 6 + [2] * 6
    assert values(spark, rows, "i int", S.gq_cell_age(v)) == [1, 1, 2, 2, 3, 3] * 2
    assert values(spark, rows, "i int", S.gq_cell_type(v)) == ["Inst", "NonInst"] * 6


def test_labels_and_numbers(spark):
    x = F.col("x")
    rows = [("$10,000 to $14,999",), ("Less than $10,000",), ("no digits",), (None,)]
    assert values(spark, rows, "x string", S.min_number(S.money(x))) == [10000.0, 10000.0, None, None]
    assert values(spark, rows, "x string", S.max_number(S.money(x))) == [14999.0, 10000.0, None, None]
    assert values(spark, [("7-or-more-person",), ("none",)], "x string", S.first_number(x)) == [7, None]
    assert values(spark, [("O'Brien & Sons, Inc. #2",)], "x string", S.text_key(x)) == ["obriensonsinc2"]
    l1, l2, l3 = S.label_levels(x, 3)
    got = spark.createDataFrame([("a!!b",), ("a!!b!!c!!d",)], "x string").select(l1, l2, l3).collect()
    assert [tuple(r) for r in got] == [("a", "b", None), ("a", "b", "c")]
    races = [("Two or more races:",), ("Some other race alone",), ("White alone",), ("else",)]
    assert values(spark, races, "x string", S.race_code(x)) == ["9", "8", "1", None]


def test_region_prefix_reaches_the_scan(spark, sf, tmp_path):
    df = spark.createDataFrame([("06075000100",), ("36061000100",), ("00607500000",)], "GEOID string")
    assert df.filter(S.in_region(F.col("GEOID"), "06075")).count() == 1
    assert df.filter(S.in_region(F.col("GEOID"), ["06", "36"])).count() == 2
    assert df.filter(S.in_region(F.col("GEOID"), None)).count() == 3
    df.write.parquet(str(tmp_path / "x"))
    plan = spark.read.parquet(str(tmp_path / "x")).filter(S.in_region(F.col("GEOID"), "06"))
    assert "StringStartsWith(GEOID,06)" in plan._jdf.queryExecution().executedPlan().toString()
