"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractweave.config import AGE_BREAKS, GQ_AGE_BREAKS, GQ_ATTRS, HH_ATTRS, P_ATTRS, FitConfig, SynthConfig
from tractweave.functions import scalars as S
from tractweave.functions.reshape import lengthen, widen
from tractweave.operators import areas as A
from tractweave.operators import draw as D
from tractweave.operators import gq as G
from tractweave.operators import seeds, targets
from tractweave.operators import validate as V
from tractweave.operators import weights as W
from tractweave.operators.regions import in_regions
from tractweave.operators.scale import stage, stage_path
from tractweave.plans import analogs as T
from tractweave.plans import oracles as O
from tractweave.plans.synth import Population, synth_gq, synth_population
from tractweave.sources import characteristics as C
from tractweave.sources import files, lookups

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Two sweeps and the last weights: a fixed number of steps that plain SQL can repeat.
TWO_SWEEPS = SynthConfig(fit=FitConfig(max_iter=2, tol=0.0, keep="last"))
EDITION = ["edition"]


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = O.compose(sql)
        return fn

    return register


# --- readers and lookups ---------------------------------------------------------------------------------------------


@query("SELECT SERIALNO, SPORDER, PUMA, SEX, AGEP, ADJINC, HINCP, HHT FROM pums")
def read_pums(spark, sf):
    return files.select_pums(T.pums(spark, sf), ["Sex", "Age", "HH_Income", "HH_Type"])


def _pums_files(spark, sf) -> str:
    """Microdata as files by state, year and survey; every state numbers its PUMAs from 1."""
    path = stage_path(spark, "pums-files")
    pumas = T.pumas_by_region(spark, sf).select(F.lpad("COUNTYFP", 5, "0").alias("PUMA"), F.col("ST").alias("state"), "place")
    rows = T.pums(spark, sf).join(pumas, "PUMA").withColumn("PUMA", F.col("place")).drop("place")
    surveys = F.explode(F.array(F.lit("acs1"), F.lit("acs5"))).alias("survey")
    rows.select("*", F.lit(2019).alias("year"), surveys).write.partitionBy("state", "year", "survey").parquet(path)
    return path


_STATE_PUMA = """lpad(cast(n_regionkey AS varchar), 2, '0') ||
lpad(cast(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS varchar), 5, '0')"""


@query(
    f"""SELECT SERIALNO, SPORDER, key AS PUMA, SEX, AGEP, HINCP, ADJINC FROM pums
JOIN (SELECT n_nationkey, n_regionkey, {_STATE_PUMA} AS key FROM nation) n ON cast(PUMA AS int) = n_nationkey WHERE n_regionkey IN (1, 3)"""
)
def read_pums_files(spark, sf):
    """Partitions of other states are pruned at run time, when the frame of states is known."""
    return files.read_pums(spark, _pums_files(spark, sf), ["Sex", "Age", "HH_Income"], _states(spark, sf), 2019, "acs5")


@query("SELECT * FROM acs WHERE table_id IN ('B01001', 'B11016') AND substr(GEOID, 1, 2) IN ('01', '03')")
def read_acs_files(spark, sf):
    path = stage_path(spark, "acs-files")
    rows = T.acs(spark, sf).withColumns({"state": F.substring("GEOID", 1, 2), "level": F.lit("Tract"), "year": F.lit(2019), "survey": F.lit("acs5")})
    rows.write.partitionBy("level", "state", "year", "survey").parquet(path)
    return files.read_acs(spark, path, ["Sex", "Age", "HH_Size"], "tract", _states(spark, sf), 2019, "acs5")


@query("SELECT *, 'CA' AS state FROM geo")
def read_geo_files(spark, sf):
    path = stage_path(spark, "geo-files")
    T.geo_lines(spark, sf).write.text(path)
    return files.read_geo(spark, path, "ca")


@query("SELECT * FROM cells")
def read_segment_files(spark, sf):
    """63 cells from their places in a headerless file."""
    path = stage_path(spark, "segment-files")
    empty = [F.lit("-").alias(f"x{i}") for i in range(files.SEGMENT_FIRST - files.SEGMENT_RECORD - 1)]
    cells = [F.col(f"P04300{i:02d}") for i in range(1, files.SEGMENT_CELLS + 1)]
    before = [F.lit("SF1ST").alias(f"b{i}") for i in range(files.SEGMENT_RECORD - 1)]
    T.segment(spark, sf).select(*before, "LOGRECNO", *empty, *cells).write.csv(path)
    return files.gq_cells_long(files.read_segment(spark, path, "CA"))


def _csv(df: DataFrame, name: str) -> str:
    path = stage_path(df.sparkSession, name)
    df.write.csv(path, header=True)
    return path


@query("SELECT STATEFP, COUNTYFP, TRACTCE, PUMA5CE, STCNTYFP, CTFP FROM xw")
def read_crosswalk_files(spark, sf):
    raw = T.crosswalk(spark, sf).select("TRACTCE", F.lit("x").alias("note"), "PUMA5CE", "COUNTYFP", "STATEFP")
    return lookups.crosswalk_lookup(files.read_crosswalk(spark, _csv(raw, "crosswalk")))


@query("SELECT * FROM codelist")
def read_codelist_files(spark, sf):
    return files.read_codelist(spark, _csv(T.codelist(spark, sf), "codelist"))


@query("SELECT name, label, concept FROM subject")
def read_dictionary_files(spark, sf):
    return files.read_dictionary(spark, _csv(T.subject_dictionary(spark, sf).select("concept", "label", "name"), "dictionary"))


@query("SELECT * FROM lk_income")
def lookup_versions(spark, sf):
    """A saved lookup after a second version whose write died."""
    path = stage_path(spark, "lookup")
    table = lookups.income_lookup(T.dictionary(spark, sf, "B19001"), EDITION)
    files.save_lookup(table.limit(1), path)
    files.save_lookup(table, path)
    try:
        files.save_lookup(table.withColumn("edition", F.raise_error(F.lit("write died")).cast("int")), path)
    except Exception as err:  # whatever Spark wraps it in
        if "write died" not in str(err):
            raise
    return files.load_lookup(spark, path)


@query("SELECT * FROM acs WHERE table_id IN ('B01001', 'B11016')")
def read_acs(spark, sf):
    return files.select_acs(T.acs(spark, sf), ["Sex", "Age", "HH_Size"])


@query("SELECT * FROM geo")
def fixed_width(spark, sf):
    return files.parse_geo(T.geo_lines(spark, sf))


@query("SELECT * FROM cells")
def gq_cells(spark, sf):
    return files.gq_cells_long(T.segment(spark, sf))


@query("SELECT * FROM gq_totals")
def gq_totals(spark, sf):
    return _gq_totals(spark, sf)


def _gq_totals(spark, sf):
    return G.gq_totals(files.parse_geo(T.geo_lines(spark, sf)), T.segment(spark, sf), "Tract")


@query("SELECT STATEFP, COUNTYFP, TRACTCE, PUMA5CE, STCNTYFP, CTFP FROM xw")
def lookup_crosswalk(spark, sf):
    return T.crosswalk(spark, sf)


@query(
    f"""SELECT Code, Code2, Description, try_cast(substr(Code2, 1, 2) AS int) AS occ_group, {O.KEY.format('Description')} AS occp_match,
  acs_var FROM codelist LEFT JOIN (SELECT name AS acs_var, {O.KEY.format("coalesce(" + ", ".join(O.PART_LABEL.format('label', i) for i in (6, 5, 4)) + ")")} AS k
    FROM subject WHERE {O.PART_LABEL.format('label', 4)} IS NOT NULL) ON {O.KEY.format('Description')} = k WHERE Code IS NOT NULL"""
)
def lookup_occupation(spark, sf):
    return lookups.occupation_lookup(T.codelist(spark, sf), T.subject_dictionary(spark, sf))


@query("SELECT * FROM lk_sex_age")
def lookup_sex_age(spark, sf):
    return lookups.sex_age_lookup(T.dictionary(spark, sf, "B01001"), EDITION)


@query("SELECT * FROM lk_size_type")
def lookup_hhsize_type(spark, sf):
    return lookups.hhsize_type_lookup(T.dictionary(spark, sf, "B11016"), EDITION)


@query("SELECT * FROM lk_race_eth")
def lookup_race_eth(spark, sf):
    return lookups.race_eth_lookup(T.dictionary(spark, sf, "B03002"), EDITION)


@query("SELECT * FROM lk_grade")
def lookup_grade(spark, sf):
    return lookups.grade_lookup(T.dictionary(spark, sf, "B14007"), EDITION)


@query("SELECT * FROM lk_income")
def lookup_income(spark, sf):
    return lookups.income_lookup(T.dictionary(spark, sf, "B19001"), EDITION)


@query(
    """SELECT acs, string_agg(characteristic, '_' ORDER BY ord) AS name, count(*) AS n_shared
FROM (SELECT p_type AS acs, p_brand AS characteristic, min(p_partkey) AS ord FROM part GROUP BY ALL) GROUP BY acs"""
)
def shared_tables(spark, sf):
    part = T.table(spark, sf, "part")
    return C.shared_tables(
        part.select(F.col("p_brand").alias("characteristic"), F.col("p_type").alias("acs"), F.col("p_partkey").alias("ord"))
    )


@query(
    """SELECT DISTINCT p_brand AS characteristic, unnest([p_type, 'SIZE' || p_size]) AS "column" FROM part
WHERE p_brand IN (SELECT p_brand FROM part JOIN lineitem ON p_partkey = l_partkey)"""
)
def characteristic_columns(spark, sf):
    part = T.table(spark, sf, "part")
    char_map = part.select(
        F.col("p_brand").alias("characteristic"),
        F.array("p_type", F.concat(F.lit("SIZE"), F.col("p_size").cast("string"))).alias("pums"),
    )
    sold = part.join(T.table(spark, sf, "lineitem"), F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    wanted = sold.select(F.col("p_brand").alias("characteristic")).distinct()
    return C.resolve_columns(char_map, wanted).distinct()


@query(
    """SELECT v AS var_code, CASE WHEN v IN (SELECT p_brand || '_' || p_type FROM part WHERE p_size <= 25 AND 2015 + p_size % 5 = 2017
  AND p_partkey % 2 = 0) THEN 'household' ELSE 'person' END AS kind FROM (SELECT DISTINCT p_brand || '_' || p_type AS v FROM part)"""
)
def split_variables(spark, sf):
    meta = T.table(spark, sf, "part").select(
        F.concat_ws("_", "p_brand", "p_type").alias("var_code"),
        F.when(F.col("p_size") <= 25, "housing").otherwise("person").alias("level"),
        (F.lit(2015) + F.col("p_size") % 5).alias("year"),
        F.when(F.col("p_partkey") % 2 == 0, "acs5").otherwise("acs1").alias("survey"),
    )
    return C.split_variables(meta, meta.select("var_code"), 2017, "acs5")


@query(
    f"""SELECT GEOID, {O.STRICT.format('estimate')} AS pop FROM acs WHERE variable = 'B01001_001' GROUP BY GEOID
HAVING {O.STRICT.format('estimate')} > 0"""
)
def areas_with_population(spark, sf):
    return A.areas_with_population(T.acs(spark, sf, ["B01001"]))


O.VIEWS["regions"] = f"""
SELECT DISTINCT substr({O.pad('n_regionkey', 2)} || {O.pad('n_nationkey', 3)} || {O.pad('c_custkey', 6)}, 1, 5 + cast(c_custkey % 7 AS int)) AS prefix
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 > 0 OR n_nationkey % 5 = 0"""


def _regions(spark, sf) -> DataFrame:
    """County to tract prefixes, one per customer; some contain others."""
    both = T.table(spark, sf, "customer").join(T.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    code = F.concat(T.pad(F.col("n_regionkey"), 2), T.pad(F.col("n_nationkey"), 3), T.pad(key, 6))
    kept = both.filter((key % 7 > 0) | (F.col("n_nationkey") % 5 == 0))
    return kept.select(F.substring(code, F.lit(1), (F.lit(5) + key % 7).cast("int")).alias("prefix"))


@query("SELECT GEOID, variable, estimate FROM acs a WHERE table_id = 'B11016' AND EXISTS (SELECT 1 FROM regions r WHERE starts_with(a.GEOID, r.prefix))")
def totals_in_regions(spark, sf):
    """Areas of a region described by thousands of prefixes of mixed lengths."""
    return in_regions(T.acs(spark, sf, ["B11016"]), _regions(spark, sf)).select("GEOID", "variable", "estimate")


@query("SELECT DISTINCT PUMA5CE AS PUMA FROM xw")
def pumas_of(spark, sf):
    return lookups.pumas_of(T.tract_pumas(spark, sf))


REGION_PUMA = """lpad(cast(n_regionkey AS varchar), 2, '0') ||
lpad(cast(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS varchar), 5, '0')"""


@query(
    f"""SELECT CTFP AS GEOID, 'P' || PUMA AS pool, PUMA, households FROM xw
JOIN (SELECT n_nationkey AS nation, {REGION_PUMA} AS PUMA FROM nation) n ON nation = cast(PUMA5CE AS int)
JOIN (SELECT c_nationkey AS nation, count(*) AS households FROM customer GROUP BY c_nationkey) c USING (nation)"""
)
def area_pools(spark, sf):
    """Pools where every region (state) numbers its PUMAs from 1, so the bare codes repeat."""
    pumas = T.pumas_by_region(spark, sf)
    xw = T.crosswalk(spark, sf).join(pumas, "COUNTYFP").withColumn("PUMA5CE", F.col("place"))
    area_pool, pool_pumas = A.area_pools(A.area_pumas(T.areas(spark, sf), xw))
    households = (
        T.table(spark, sf, "customer")
        .select(T.pad(F.col("c_nationkey"), 3).alias("COUNTYFP"))
        .join(pumas, "COUNTYFP")
        .groupBy(S.puma_key(F.col("ST"), F.col("place")).alias("PUMA"))
        .agg(F.count("*").alias("households"))
    )
    return area_pool.join(pool_pumas, "pool").join(households, "PUMA").select("GEOID", "pool", "PUMA", "households")


# --- scalars ---------------------------------------------------------------------------------------------------------


@query(
    f"""SELECT SERIALNO, SPORDER, {O.AGE} AS age, {O.GQ_AGE} AS gq_age, {O.INCOME} AS income,
  {O.bins('NP', (2, 5, 10, 12))} AS size_open, {O.bins('NP', (2, 5, 10, 12), True)} AS size_closed FROM pums"""
)
def cut_codes(spark, sf):
    np_edges = (2, 5, 10, 12)
    return T.pums(spark, sf).select(
        "SERIALNO",
        "SPORDER",
        S.cut_left(F.col("AGEP"), AGE_BREAKS, include_lowest=True).alias("age"),
        S.cut_left(F.col("AGEP"), GQ_AGE_BREAKS).alias("gq_age"),
        S.cut_left(S.adjusted_income(F.col("HINCP"), F.col("ADJINC")), SynthConfig().breaks.income).alias("income"),
        S.cut_left(F.col("NP"), np_edges).alias("size_open"),
        S.cut_left(F.col("NP"), np_edges, include_lowest=True).alias("size_closed"),
    )


@query(
    f"""SELECT SERIALNO, SPORDER, {O.RACE} AS race, {O.HISPANIC} AS hispanic, {O.SCHOOL} AS school, {O.HH_TYPE} AS hh_type,
  {O.HH_SIZE} AS hh_size, {O.GQ_TYPE} AS gq_type, CASE WHEN OCCP = '0009' THEN 99 ELSE try_cast(OCCP AS int) END AS occ,
  HINCP * cast(ADJINC AS double) AS income,
  CASE WHEN SCH = '1' THEN 1 WHEN SCH <> '1' THEN 0 END AS two_sided, coalesce(SCH IN ('1', '2'), false) AS member FROM pums"""
)
def recode_person(spark, sf):
    c = F.col
    return T.pums(spark, sf).select(
        "SERIALNO",
        "SPORDER",
        S.condense_race(c("RAC1P")).alias("race"),
        S.hispanic_flag(c("HISP")).alias("hispanic"),
        S.school_type(c("SCH")).alias("school"),
        S.household_type(c("HHT")).alias("hh_type"),
        S.top_code(c("NP")).alias("hh_size"),
        S.gq_type(c("SCHG"), c("OCCP")).alias("gq_type"),
        S.occupation_group(c("OCCP"), c("OCCP").try_cast("int")).alias("occ"),
        S.adjusted_income(c("HINCP"), c("ADJINC")).alias("income"),
        S.if_else(c("SCH") == "1", F.lit(1), F.lit(0)).alias("two_sided"),
        S.is_in(c("SCH"), ("1", "2")).alias("member"),
    )


_DICTS = " UNION ALL ".join(f"SELECT * FROM dict_{n}" for n in T.LABELS)


@query(
    f"""SELECT edition, name, {', '.join(f"{O.PART_LABEL.format('label', i)} AS l{i}" for i in (3, 4, 5))},
  coalesce({', '.join(O.PART_LABEL.format('label', i) for i in (5, 4, 3))}) AS deepest, {O.KEY.format('label')} AS key,
  list_min({O.NUMBERS.format("replace(label, ',', '')")}) AS lowest, list_max({O.NUMBERS.format("replace(label, ',', '')")}) AS highest,
  try_cast(regexp_extract(label, '[0-9]+') AS int) AS first_no, {O._RACE_LABEL.replace('race', 'label')} AS race, length(label) AS n
FROM ({_DICTS})"""
)
def label_parse(spark, sf):
    dicts = [T.dictionary(spark, sf, n) for n in T.LABELS]
    rows = dicts[0]
    for d in dicts[1:]:
        rows = rows.unionByName(d)
    label = F.col("label")
    _, _, l3, l4, l5 = S.label_levels(label, 5)
    return rows.select(
        "edition",
        "name",
        l3.alias("l3"),
        l4.alias("l4"),
        l5.alias("l5"),
        F.coalesce(l5, l4, l3).alias("deepest"),
        S.text_key(label).alias("key"),
        S.min_number(S.money(label)).alias("lowest"),
        S.max_number(S.money(label)).alias("highest"),
        S.first_number(label).alias("first_no"),
        S.race_code(label).alias("race"),
        F.length(label).cast("long").alias("n"),
    )


@query(
    f"""SELECT p_partkey, name, {O.KEY.format("p_name || '; ' || p_type || '-' || p_partkey")} AS key
FROM part LEFT JOIN (SELECT name, {O.KEY.format("split_part(label, '!!', -1)")} AS k FROM subject) ON k = {O.KEY.format("p_name || '; ' || p_type || '-' || p_partkey")}"""
)
def text_key_join(spark, sf):
    text = F.concat("p_name", F.lit("; "), "p_type", F.lit("-"), F.col("p_partkey").cast("string"))
    left = T.table(spark, sf, "part").select("p_partkey", S.text_key(text).alias("key"))
    last = F.element_at(F.split("label", "!!"), -1)
    right = T.subject_dictionary(spark, sf).select("name", S.text_key(last).alias("key"))
    return left.join(right, "key", "left").select("p_partkey", "name", "key")


@query(f"SELECT GEOID, table_id, {O.STRICT.format('estimate')} AS strict, sum(estimate) AS loose FROM acs GROUP BY GEOID, table_id")
def strict_sum(spark, sf):
    x = F.col("estimate")
    return T.acs(spark, sf).groupBy("GEOID", "table_id").agg(S.strict_sum(x).alias("strict"), F.sum(x).alias("loose"))


# --- targets ---------------------------------------------------------------------------------------------------------


def _hh_targets(spark, sf):
    look = T.lookups(spark, sf, ["hhsize_type", "hhincome"])
    return targets.hh_targets(T.acs(spark, sf, ["B11016", "B19001"]), look, HH_ATTRS)


@query("SELECT * FROM hh_targets")
def hh_targets(spark, sf):
    return _hh_targets(spark, sf)


@query("SELECT * FROM person_targets")
def person_targets(spark, sf):
    look = T.lookups(spark, sf, ["sex_by_age", "race_eth", "grade", "occp"])
    acs = T.acs(spark, sf, ["B01001", "B03002", "B14007", "B14003", "S2401"])
    return targets.person_targets(acs, look, P_ATTRS)


@query("SELECT * FROM gq_targets")
def gq_targets(spark, sf):
    return targets.gq_targets(_gq_totals(spark, sf))


_SIZES = range(1, 8)


@query(
    f"""SELECT GEOID, {', '.join(f"max(target) FILTER (level = '{i}') AS size_{i}" for i in _SIZES)}
FROM hh_targets WHERE attr = 'HH_Size' GROUP BY GEOID"""
)
def targets_wide(spark, sf):
    wide = widen(_hh_targets(spark, sf), "HH_Size", _SIZES)
    return wide.select("GEOID", *[F.col(str(i)).alias(f"size_{i}") for i in _SIZES])


@query(
    """SELECT GEOID, 'HH_Income' AS attr, level, target FROM (SELECT DISTINCT GEOID FROM hh_targets WHERE attr = 'HH_Income')
CROSS JOIN (VALUES ('1'), ('2'), ('3'), ('4')) v(level)
LEFT JOIN (SELECT * FROM hh_targets WHERE attr = 'HH_Income') USING (GEOID, level)"""
)
def targets_long(spark, sf):
    return lengthen(widen(_hh_targets(spark, sf), "HH_Income", range(1, 5)), "HH_Income")


@query(
    """SELECT GEOID, 'Occ_Group' AS attr, cast(occ_group AS varchar) AS level, target FROM occ_work
UNION ALL SELECT GEOID, 'Occ_Group', '99', target FROM occ_rest"""
)
def residual_level(spark, sf):
    acs = T.acs(spark, sf, ["B01001", "S2401"])
    totals = acs.filter(F.col("variable") == targets.POPULATION).select("GEOID", F.col("estimate").alias("total"))
    detailed = T.occupations(spark, sf).filter((F.length("Code2") < 10) & F.col("acs_var").isNotNull())
    groups = detailed.select(F.col("acs_var").alias("variable"), "occ_group").distinct()
    parts = (
        acs.join(groups, "variable")
        .groupBy("GEOID", F.lit("Occ_Group").alias("attr"), F.col("occ_group").cast("string").alias("level"))
        .agg(S.strict_sum(F.col("estimate")).alias("target"))
    )
    return targets.residual_level(totals, parts, "Occ_Group", 99)


# --- seeds -----------------------------------------------------------------------------------------------------------


def _pums(spark, sf):
    """Microdata as a stored table, as a user would have it; for queries that read it several times."""
    return stage(T.pums(spark, sf), "pums")


def _seeds(spark, sf, pums=None):
    pums = _pums(spark, sf) if pums is None else pums
    return seeds.hh_seed(pums), seeds.person_seed(pums, T.occupations(spark, sf))


@query("SELECT * FROM hh_seed")
def hh_seed(spark, sf):
    return seeds.hh_seed(T.pums(spark, sf))


@query("SELECT * FROM p_seed")
def person_seed(spark, sf):
    return seeds.person_seed(T.pums(spark, sf), T.occupations(spark, sf))


@query("SELECT * FROM gq_seed")
def gq_seed(spark, sf):
    return seeds.gq_seed(T.pums(spark, sf))


@query(
    """SELECT * EXCLUDE (r) FROM (SELECT SERIALNO, SPORDER, PUMA, SEX, AGEP, RAC1P, row_number() OVER (PARTITION BY SERIALNO ORDER BY SPORDER) AS r
FROM pums) WHERE r = 1"""
)
def household_first(spark, sf):
    return seeds.first_per_household(T.pums(spark, sf).select("SERIALNO", "SPORDER", "PUMA", "SEX", "AGEP", "RAC1P"))


@query(
    """SELECT CTFP AS GEOID, cast(count(*) AS bigint) AS households, cast(sum(np) AS bigint) AS persons FROM xw JOIN hh_seed h ON PUMA = PUMA5CE
JOIN (SELECT SERIALNO, count(*) AS np FROM p_seed GROUP BY SERIALNO) USING (SERIALNO) GROUP BY CTFP"""
)
def area_seed(spark, sf):
    hh, persons = _seeds(spark, sf)
    return A.area_seed_sizes(A.area_pumas(T.areas(spark, sf), T.tract_pumas(spark, sf)), hh, persons)


# --- weights and draws -----------------------------------------------------------------------------------------------


# Small seeds give totals that lie exactly between two rounded values; added before rounding so both engines go one way.
NUDGE = 3e-7


def _fitted_sql(final: str, attrs, index: str) -> str:
    parts = [
        f"SELECT GEOID, '{a}' AS attr, '{lv}' AS level, round(sum(d_{a}_{lv} * w) + {NUDGE}, 4) AS fitted FROM {final} GROUP BY GEOID HAVING max(d_{a}_{lv}) > 0"
        for a in attrs
        for lv in O.FIT_LEVELS[a]
    ]
    return f"SELECT f.* FROM ({' UNION ALL '.join(parts)}) f JOIN {index} USING (attr, level)"


def _fitted(fit: W.Fit) -> DataFrame:
    return W.fitted_totals(fit).withColumn("fitted", F.round(F.col("fitted") + NUDGE, 4))


@query(_fitted_sql(O.RAKE, GQ_ATTRS, "rake_ix"))
def rake_k2(spark, sf):
    totals = stage(targets.gq_targets(_gq_totals(spark, sf)), "gq_targets")
    populated = totals.groupBy("GEOID").agg(F.sum("target").alias("t")).filter("t > 0")
    pools = A.area_pools(A.area_pumas(populated, T.tract_pumas(spark, sf)))
    seed = stage(seeds.gq_seed(T.pums(spark, sf)), "gq_seed").withColumn("SERIALNO", F.concat_ws("-", "SERIALNO", "SPORDER"))
    return _fitted(W.fit_weights(*pools, seed, GQ_ATTRS, totals, cfg=TWO_SWEEPS.fit))


def _fit_inputs(spark, sf, pums=None, hh_attrs=O.FIT_HH, p_attrs=O.FIT_P):
    hh, persons = _seeds(spark, sf, pums)
    homes = stage(T.residence(spark, sf, hh), "homes")
    return (
        hh,
        persons,
        T.true_targets(spark, sf, hh, homes, hh_attrs),
        T.true_targets(spark, sf, persons, homes, p_attrs),
    )


def _fit(spark, sf, cfg: FitConfig, hh_attrs=O.FIT_HH, p_attrs=O.FIT_P) -> W.Fit:
    hh, persons, hh_t, p_t = _fit_inputs(spark, sf, None, hh_attrs, p_attrs)
    pools = A.area_pools(A.area_pumas(T.areas(spark, sf), T.tract_pumas(spark, sf)))
    wanted = stage(hh_t.unionByName(p_t), "targets")
    return W.fit_weights(*pools, hh, hh_attrs, wanted, persons, p_attrs, cfg)


O.VIEWS["ipu_ix"] = O._index((*O.K2_HH, *O.K2_P), "true_all")
_IPU_K2 = _fitted_sql(O.IPU, (*O.K2_HH, *O.K2_P), "ipu_ix")


@query(_IPU_K2)
def ipu_k2(spark, sf):
    return _fitted(_fit(spark, sf, TWO_SWEEPS.fit, O.K2_HH, O.K2_P))


@query(_IPU_K2)
def ipu_parted(spark, sf):
    """The same fit with every pool cut into parts, as pools are that do not fit a task."""
    cfg = replace(TWO_SWEEPS.fit, kernel_cells=0, block_cells=1000)
    return _fitted(_fit(spark, sf, cfg, O.K2_HH, O.K2_P))


@query("SELECT GEOID, sweeps, round(gap, 6) AS gap, unreachable, converged FROM ipuc_report")
def ipu_converged(spark, sf):
    """Report of the full fit: sweeps, mean relative gap and unreachable targets of every area."""
    fit = _fit(spark, sf, FitConfig())
    return fit.factors.select("GEOID", "sweeps", F.round("gap", 6).alias("gap"), "unreachable", "converged")


O.VIEWS["home_w"] = """
SELECT GEOID, SERIALNO, md5(SERIALNO) || SERIALNO AS okey, cast(round_even((1 + NP * 0.37) * 1000000, 0) AS bigint) AS m
FROM homes JOIN (SELECT DISTINCT SERIALNO, NP FROM hu) USING (SERIALNO)"""
HOME_DRAW = O.position_chain("home", "home_w")


def _home_draw(spark, sf, pums=None) -> DataFrame:
    pums = _pums(spark, sf) if pums is None else pums
    sizes = seeds.households_only(pums).groupBy("SERIALNO").agg(F.max("NP").alias("NP"))
    homes = T.residence(spark, sf, seeds.hh_seed(pums)).join(sizes, "SERIALNO")
    return D.weighted_draw(homes.select("GEOID", "SERIALNO", (F.lit(1) + F.col("NP") * 0.37).alias("weight")))


@query(f"SELECT * FROM {HOME_DRAW}")
def weighted_draw(spark, sf):
    return _home_draw(spark, sf)


def _home_persons(spark, sf, pums=None) -> DataFrame:
    pums = _pums(spark, sf) if pums is None else pums
    hh, persons = _seeds(spark, sf, pums)
    draws = stage(_home_draw(spark, sf, pums), "draws")
    return D.expand_persons(draws, persons, (*O.FIT_HH, *O.FIT_P), hh=hh)


@query(O.expand(HOME_DRAW))
def expand_persons(spark, sf):
    return _home_persons(spark, sf)


# --- group quarters and population -----------------------------------------------------------------------------------


def _gq_pop(spark, sf, pums=None) -> DataFrame:
    pums = T.pums(spark, sf) if pums is None else pums
    seed = seeds.gq_seed(pums).withColumn("pid", F.concat_ws("-", "SERIALNO", "SPORDER"))
    return synth_gq(
        T.areas(spark, sf),
        T.tract_pumas(spark, sf),
        seed,
        targets.gq_targets(_gq_totals(spark, sf)),
        id_col="pid",
    ).drop("pid")


@query("SELECT * FROM gq_pop")
def synth_gq_population(spark, sf):
    return _gq_pop(spark, sf)


QUERIES["synth_gq"] = QUERIES.pop("synth_gq_population")
ORACLES["synth_gq"] = ORACLES.pop("synth_gq_population")


@query("SELECT * FROM gq_marginals")
def gq_marginals(spark, sf):
    return G.gq_marginals(_gq_pop(spark, sf), T.occupations(spark, sf), P_ATTRS)


@query(O.gq_rows((*HH_ATTRS, *P_ATTRS)))
def gq_clean(spark, sf):
    return G.gq_clean(_gq_pop(spark, sf), T.occupations(spark, sf), (*HH_ATTRS, *P_ATTRS))


@query("SELECT * FROM corrected")
def gq_correction(spark, sf):
    pums = _pums(spark, sf)
    *_, p_t = _fit_inputs(spark, sf, pums)
    return targets.subtract_gq(p_t, G.gq_marginals(_gq_pop(spark, sf, pums), T.occupations(spark, sf), P_ATTRS))


@query(f"{O.expand(HOME_DRAW)} UNION ALL {O.gq_rows((*O.FIT_HH, *O.FIT_P))}")
def append_gq(spark, sf):
    attrs, pums = (*O.FIT_HH, *O.FIT_P), _pums(spark, sf)
    return G.append_gq(_home_persons(spark, sf, pums), G.gq_clean(_gq_pop(spark, sf, pums), T.occupations(spark, sf), attrs))


def population(spark, sf, cfg: SynthConfig = SynthConfig()) -> tuple[Population, DataFrame]:
    """Synthetic population of every area with group quarters, and the uncorrected targets."""
    pums = _pums(spark, sf)
    hh, persons, hh_t, p_t = _fit_inputs(spark, sf, pums)
    result = synth_population(
        T.areas(spark, sf),
        T.tract_pumas(spark, sf),
        hh,
        persons,
        hh_t,
        p_t,
        O.FIT_HH,
        O.FIT_P,
        _gq_pop(spark, sf, pums),
        T.occupations(spark, sf),
        cfg,
    )
    return result, hh_t.unionByName(p_t)


def _errors(spark, sf) -> DataFrame:
    pop, wanted = population(spark, sf)
    return V.area_error(wanted, pop.counts)


def _rounded(errors: DataFrame) -> DataFrame:
    return errors.withColumn("pmiss", F.round("pmiss", 9))


@query("SELECT * FROM syn_pop")
def synth_persons(spark, sf):
    return population(spark, sf)[0].persons


QUERIES["synth_population"] = QUERIES.pop("synth_persons")
ORACLES["synth_population"] = ORACLES.pop("synth_persons")


# Areas beyond those of the crosswalk, and targets for some only, so that every reason occurs.
_ASKED = "SELECT CTFP AS GEOID FROM xw UNION ALL SELECT 'X' || c_custkey FROM customer WHERE c_custkey % 10 = 0"
_SEEDED = "SELECT DISTINCT PUMA FROM hh_seed WHERE PUMA <> '00007' AND SERIALNO IN (SELECT SERIALNO FROM p_seed)"


@query(
    f"""SELECT GEOID, reason FROM (SELECT GEOID, CASE WHEN c.CTFP IS NULL THEN 1 ELSE 0 END + CASE WHEN t.g IS NULL THEN 2 ELSE 0 END +
  CASE WHEN s.PUMA IS NULL THEN 4 ELSE 0 END AS reason FROM ({_ASKED}) LEFT JOIN xw c ON GEOID = c.CTFP LEFT JOIN ({_SEEDED}) s ON c.PUMA5CE = s.PUMA
  LEFT JOIN (SELECT DISTINCT GEOID AS g FROM hh_targets WHERE target IS NOT NULL AND GEOID NOT LIKE '%3') t ON GEOID = g) WHERE reason > 0"""
)
def areas_without_result(spark, sf):
    customers = T.table(spark, sf, "customer").filter("c_custkey % 10 = 0")
    asked = T.areas(spark, sf).unionByName(customers.select(F.concat(F.lit("X"), "c_custkey").alias("GEOID")))
    hh, persons = _seeds(spark, sf)
    wanted = _hh_targets(spark, sf).filter(~F.col("GEOID").endswith("3"))
    return A.area_outcomes(asked, T.tract_pumas(spark, sf), wanted, hh.filter("PUMA <> '00007'"), persons)


@query(
    """SELECT PUMA, in_gq, reason, count(*) AS persons FROM (SELECT PUMA, contains(SERIALNO, 'GQ') AS in_gq,
  CASE WHEN OCCP = '0009' THEN NULL WHEN occ_group IS NULL THEN 1 WHEN occ_group = 55 THEN 2 END AS reason FROM pums LEFT JOIN occ_codes ON OCCP = Code)
WHERE reason IS NOT NULL GROUP BY ALL"""
)
def dropped_persons(spark, sf):
    return seeds.dropped_persons(T.pums(spark, sf), T.occupations(spark, sf))


# Every state (region) numbers its PUMAs from 1, and targets come from totals. The totals of the test tables are all sums of the
# same lines: parts of them are taken that fit together, so many households, persons and working persons.
WORKING = 0.01
SCALE = "CASE WHEN attr LIKE 'HH%' THEN target / 2000 WHEN attr = 'Occ_Group' THEN target * 0.23 ELSE target / 200 END"
O.VIEWS["tot_rest"] = f"""
SELECT p.GEOID, 'Occ_Group' AS attr, '99' AS level, p.estimate - CASE WHEN w.GEOID IS NULL THEN 0 ELSE w.target END AS target
FROM (SELECT GEOID, estimate FROM acs WHERE variable = 'B01001_001') p
LEFT JOIN (SELECT GEOID, {O.STRICT.format('target')} * {WORKING} AS target FROM occ_work GROUP BY GEOID) w ON p.GEOID = w.GEOID"""
O.VIEWS["tot_targets"] = f"""
SELECT GEOID, attr, level, {SCALE} AS target FROM (SELECT * FROM hh_targets UNION ALL SELECT * FROM person_targets WHERE attr <> 'Occ_Group'
  UNION ALL SELECT GEOID, attr, level, target * {WORKING} FROM person_targets WHERE attr = 'Occ_Group' AND level <> '99' UNION ALL SELECT * FROM tot_rest)"""
O.VIEWS["tot_base"] = "SELECT * FROM base WHERE PUMA IN (SELECT PUMA5CE FROM xw WHERE STATEFP IN ('01', '03'))"
_TOT_DRAW = O.draw_chain("tot", O.fit_converged("tot", "tot_base", "tot_targets", (*O.FIT_HH, *O.FIT_P)), (*O.FIT_HH, *O.FIT_P), "tot_targets")


def _states(spark, sf):
    return T.table(spark, sf, "region").filter("r_regionkey IN (1, 3)").select(T.pad(F.col("r_regionkey"), 2).alias("state"))


def _population_from_totals(spark, sf) -> Population:
    """Two states that share PUMA codes, from microdata files and totals to persons, ten characteristics."""
    chars = ["Sex", "Age", "Race", "Ethnicity", "Occupation", "Grade", "School_Type", "HH_Income", "HH_Type", "HH_Size"]
    states = _states(spark, sf)
    pums = stage(files.read_pums(spark, _pums_files(spark, sf), chars, states, 2019, "acs5"), "pums")
    occp = T.occupations(spark, sf)
    xw = T.state_crosswalk(spark, sf).join(states.withColumnRenamed("state", "STATEFP"), "STATEFP", "left_semi")
    region = states.select("state")
    few = F.when(F.col("table_id") == "S2401", F.col("estimate") * WORKING).otherwise(F.col("estimate"))
    acs = stage(T.acs(spark, sf).withColumn("estimate", few), "acs")
    look = T.lookups(spark, sf, ["hhsize_type", "hhincome", "sex_by_age", "race_eth", "grade", "occp"])
    part = F.expr(SCALE).alias("target")
    hh_t = targets.hh_targets(acs, look, chars, region).select("GEOID", "attr", "level", part)
    p_t = targets.person_targets(acs, look, chars, region).select("GEOID", "attr", "level", part)
    areas = xw.select(F.col("CTFP").alias("GEOID"))
    hh, persons = seeds.hh_seed(pums), seeds.person_seed(pums, occp)
    return synth_population(areas, xw, hh, persons, hh_t, p_t, O.FIT_HH, O.FIT_P)


@query(O.expand(_TOT_DRAW))
def population_from_totals(spark, sf):
    return _population_from_totals(spark, sf).persons


# --- validation ------------------------------------------------------------------------------------------------------

_PROP = "CASE WHEN sum(obs) <> 0 THEN round(abs(sum(obs) - sum(gen)) / sum(obs), 9) END"
_QUANTILES = ", ".join(f"round(quantile_cont(pmiss, {p}), 9) AS q{round(p * 100)}" for p in (0.0, 0.25, 0.5, 0.75, 1.0))
_SUMMARY = f"attr, count(pmiss) AS n_areas, round(avg(pmiss), 9) AS mean, {_QUANTILES}"


@query(
    f"""SELECT attr, level, sum(obs) AS obs, cast(sum(gen) AS double) AS gen, {_PROP} AS prop_diff FROM area_cmp
WHERE NOT (attr = 'Race' AND level = '3') GROUP BY attr, level"""
)
def validate_global(spark, sf):
    pop, wanted = population(spark, sf)
    out = V.global_error(wanted, pop.counts, exclude=[("Race", "3")])
    return out.withColumn("prop_diff", F.round("prop_diff", 9))


@query("SELECT GEOID, attr, round(pmiss, 9) AS pmiss FROM area_err")
def validate_area(spark, sf):
    return _rounded(_errors(spark, sf))


def _rounded_summary(errors: DataFrame) -> DataFrame:
    out = V.error_summary(errors)
    return out.select("attr", "n_areas", *[F.round(c, 9).alias(c) for c in out.columns[2:]])


@query(f"SELECT {_SUMMARY} FROM area_err GROUP BY attr")
def error_summary(spark, sf):
    return _rounded_summary(_errors(spark, sf))


@query("SELECT DISTINCT GEOID FROM area_err WHERE pmiss > 0.5")
def high_error_areas(spark, sf):
    return V.high_error_areas(_errors(spark, sf), 0.5)


def _home_pair(spark, sf):
    """Totals-based targets against seed households counted by home tract: a light observed / generated pair."""
    hh = seeds.hh_seed(T.pums(spark, sf))
    homes = T.residence(spark, sf, hh)
    gen = T.true_targets(spark, sf, hh, homes, HH_ATTRS, times=1).withColumnRenamed("target", "gen")
    return _hh_targets(spark, sf).withColumn("target", F.col("target") / 100), gen


@query(
    f"""SELECT attr, level, round(sum(obs), 6) AS obs, cast(sum(gen) AS double) AS gen, {_PROP} AS prop_diff
FROM (SELECT attr, level, coalesce(target, 0) / 100 AS obs, coalesce(gen, 0) AS gen FROM hh_targets FULL JOIN home_gen USING (GEOID, attr, level))
GROUP BY attr, level"""
)
def err_global(spark, sf):
    out = V.compare(*_home_pair(spark, sf), ["attr", "level"])
    diff = F.round(S.rel_diff(F.col("obs"), F.col("gen")), 9)
    return out.select("attr", "level", F.round("obs", 6).alias("obs"), "gen", diff.alias("prop_diff"))


def _home_errors(spark, sf):
    return V.area_error(*_home_pair(spark, sf))


@query("SELECT GEOID, attr, round(pmiss, 9) AS pmiss FROM home_err")
def err_area(spark, sf):
    return _rounded(_home_errors(spark, sf))


@query(f"SELECT {_SUMMARY} FROM home_err GROUP BY attr")
def err_quantiles(spark, sf):
    return _rounded_summary(_home_errors(spark, sf))


@query(f"SELECT {_SUMMARY} FROM home_err WHERE GEOID NOT IN (SELECT GEOID FROM home_err WHERE round(pmiss, 9) > 1.0) GROUP BY attr")
def err_without_high(spark, sf):
    errors = _home_errors(spark, sf)
    return _rounded_summary(V.without_areas(errors, V.high_error_areas(_rounded(errors), 1.0)))
