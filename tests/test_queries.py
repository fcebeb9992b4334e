import glob
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tractweave.operators.areas import areas_with_population
from tractweave.plans import analogs, registry
from tractweave.plans.synth import write_population

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracles import rows_of  # noqa: E402

LIGHT = ["fixed_width", "gq_totals", "hh_targets", "person_targets", "gq_targets", "residual_level", "hh_seed", "person_seed",
         "recode_person", "label_parse", "lookup_occupation", "shared_tables", "ipu_k2", "err_quantiles",
         "area_pools", "pumas_of", "area_seed", "lookup_crosswalk",
         "ipu_parted", "ipu_converged", "read_pums_files", "read_acs_files", "read_geo_files", "read_segment_files",
         "read_crosswalk_files", "read_codelist_files", "read_dictionary_files", "lookup_versions", "totals_in_regions",
         "areas_without_result", "dropped_persons", "population_from_totals", "validate_area"]


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", LIGHT)
def test_query_equals_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_population_invariants(spark, sf, tmp_path):
    result, _ = registry.population(spark, sf)
    write_population(result.persons, str(tmp_path / "pop"))
    pop = spark.read.parquet(str(tmp_path / "pop"))
    n = pop.count()
    assert n > 0 and pop.select("p_id").distinct().count() == n
    gq = pop.filter("HH_Type LIKE 'GQ_%'").count()
    assert 0 < gq < n
    assert result.targets.filter("target < 0").isEmpty()
    homes = {r.CTFP for r in analogs.crosswalk(spark, sf).select("CTFP").collect()}
    assert {r.GEOID for r in pop.select("GEOID").distinct().collect()} <= homes
    # the same seed gives the same population again
    again = registry.population(spark, sf)[0].persons
    assert again.exceptAll(pop.drop("county")).isEmpty() and again.count() == n


def test_regions(spark, sf):
    acs = analogs.acs(spark, sf, ["B01001"])
    everywhere = areas_with_population(acs).count()
    by_region = [areas_with_population(acs, f"{i:02d}").count() for i in range(5)]
    assert everywhere == sum(by_region) > 0
