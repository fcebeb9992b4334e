"""The registered queries in plain SQL for an independent engine, written against household rows and without patterns."""

from __future__ import annotations

import re

from tractweave.config import AGE_BREAKS, GQ_AGE_BREAKS, GQ_ATTRS, HH_ATTRS, INCOME_BREAKS, P_ATTRS, FitConfig
from tractweave.functions import scalars as S
from tractweave.operators.targets import AGE_TOTALS, RACE_TOTALS
from tractweave.plans.analogs import LABELS, N_OCCUPATIONS
from tractweave.sources.files import SEGMENT_CELLS


def pad(x: str, n: int) -> str:
    return f"lpad(cast({x} AS varchar), {n}, '0')"


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def bins(x: str, breaks, closed: bool = False) -> str:
    """CASE chain of left-closed bins."""
    last = len(breaks) - 2
    arms = [
        f"WHEN {x} >= {lo} AND {x} {'<=' if closed and i == last else '<'} {hi} THEN {i + 1}"
        for i, (lo, hi) in enumerate(zip(breaks, breaks[1:]))
    ]
    return f"CASE {' '.join(arms)} END"


STRICT = "CASE WHEN count({0}) = count(*) THEN sum({0}) END"
AGE = bins("AGEP", AGE_BREAKS, closed=True)
GQ_AGE = bins("AGEP", GQ_AGE_BREAKS)
INCOME = bins("HINCP * cast(ADJINC AS double)", INCOME_BREAKS)
RACE = "CASE WHEN RAC1P IN ('3','4','5') THEN '3' ELSE RAC1P END"
HISPANIC = "CASE WHEN HISP = '01' THEN 0 WHEN HISP <> '01' THEN 1 END"
SCHOOL = "CASE WHEN SCH IN ('b','1') THEN 'non' WHEN SCH = '2' THEN 'pub' WHEN SCH = '3' THEN 'pvt' END"
HH_TYPE = "CASE WHEN HHT IN ('1','2','3') THEN 1 ELSE 2 END"
HH_SIZE = "CASE WHEN NP >= 7 THEN 7 ELSE NP END"
GQ_TYPE = "CASE WHEN SCHG <> 'bb' OR coalesce(OCCP NOT IN ('0009','9920'), true) THEN 'NonInst' WHEN SCHG = 'bb' THEN 'Inst' END"
KEY = r"lower(regexp_replace({0}, '[[:punct:] ]', '', 'g'))"
NUMBERS = "cast(regexp_extract_all({0}, '[0-9]+') AS double[])"
PART_LABEL = "nullif(split_part({0}, '!!', {1}), '')"

VIEWS: dict[str, str] = {}

VIEWS["pums"] = f"""
SELECT concat(CASE WHEN c_custkey % 20 = 0 THEN '2019GQ' ELSE '2019HU' END, {pad('c_custkey', 7)}) AS SERIALNO,
  cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS int) AS SPORDER,
  {pad('c_nationkey', 5)} AS PUMA,
  CASE WHEN o_orderstatus = 'F' THEN '2' ELSE '1' END AS SEX,
  cast(floor(o_totalprice / 5000) AS int) AS AGEP,
  substr(o_orderpriority, 1, 1) AS RAC1P,
  CASE WHEN o_orderkey % 4 = 0 THEN '02' ELSE '01' END AS HISP,
  CASE WHEN o_orderkey % 3 = 0 THEN '0009' ELSE {pad(f'o_orderkey % {N_OCCUPATIONS}', 4)} END AS OCCP,
  CASE WHEN o_orderkey % 17 = 0 THEN 'bb' ELSE {pad('o_orderkey % 17', 2)} END AS SCHG,
  CASE o_orderkey % 5 WHEN 0 THEN 'b' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' END AS SCH,
  '1.01' AS ADJINC, c_acctbal * 20 AS HINCP,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
    WHEN 'HOUSEHOLD' THEN '4' ELSE '5' END AS HHT,
  cast(count(*) OVER (PARTITION BY o_custkey) AS int) AS NP
FROM orders JOIN customer ON o_custkey = c_custkey"""

VIEWS["xw"] = f"""
SELECT {pad('n_regionkey', 2)} AS STATEFP, {pad('n_nationkey', 3)} AS COUNTYFP, {pad('s_suppkey', 6)} AS TRACTCE,
  {pad('n_nationkey', 5)} AS PUMA5CE, {pad('n_regionkey', 2)} || {pad('n_nationkey', 3)} AS STCNTYFP,
  {pad('n_regionkey', 2)} || {pad('n_nationkey', 3)} || {pad('s_suppkey', 6)} AS CTFP, s_suppkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def _acs_part(name: str) -> str:
    if name == "S2401":
        var = f"'S2401_C01_' || {pad(f'l_partkey % {N_OCCUPATIONS}', 3)}"
    else:
        var = f"'{name}_' || {pad(f'l_partkey % {len(LABELS[name])} + 1', 3)}"
    return f"SELECT '{name}' AS table_id, CTFP AS GEOID, {var} AS variable, sum(l_quantity) AS e FROM lineitem JOIN xw ON l_suppkey = s_suppkey GROUP BY ALL"


VIEWS["acs"] = f"""
SELECT table_id, GEOID, variable, CASE WHEN variable LIKE '%\\_007' ESCAPE '\\' AND GEOID LIKE '%7' THEN NULL ELSE e END AS estimate
FROM ({' UNION ALL '.join(_acs_part(n) for n in [*LABELS, 'S2401'])})"""

for _name, _labels in LABELS.items():
    _values = ", ".join(f"({i}, {quoted([x])})" for i, x in enumerate(_labels))
    VIEWS[f"dict_{_name}"] = f"""
SELECT cast(floor(p_partkey / {len(_labels)}) AS int) AS edition, '{_name}_' || {pad('place + 1', 3)} AS name, label,
  'CONCEPT IN THE PAST 12 MONTHS' AS concept
FROM part JOIN (VALUES {_values}) AS t(place, label) ON p_partkey % {len(_labels)} = place"""

VIEWS["subject"] = f"""
SELECT 'S2401_C01_' || {pad('p_partkey', 7)} AS name, 'OCCUPATION' AS concept,
  CASE WHEN p_partkey % 11 = 0 THEN 'Estimate!!Total' ELSE 'Estimate!!Total!!Civilian employed!!' ||
    CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Management:!!' ELSE 'Management:!!Business:!!' END ||
    upper(p_name) || ' & ' || p_type || ' (' || p_partkey || ')' END AS label
FROM part"""
VIEWS["codelist"] = f"""
SELECT CASE WHEN p_partkey % 13 <> 0 THEN {pad('p_partkey', 7)} END AS Code,
  CASE WHEN p_partkey % 19 = 0 THEN 'none' ELSE (p_size + 10) || '-' || {pad('p_partkey % 10000', 4)} ||
    CASE WHEN p_partkey % 10 = 9 THEN ',9999' ELSE '' END END AS Code2,
  CASE WHEN p_partkey % 7 = 0 THEN 'Other ' ELSE '' END || p_name || ', ' || lower(p_type) || ' #' || p_partkey AS Description
FROM part"""
VIEWS["occp"] = f"""
SELECT DISTINCT {pad('c', 4)} AS Code, CASE WHEN c % 10 = 9 THEN '11-1021,1022' ELSE '11-1021' END AS Code2,
  cast(c % 23 * 2 + 11 AS int) AS occ_group,
  CASE WHEN c % 23 <> 22 THEN 'S2401_C01_' || {pad('c', 3)} END AS acs_var, p_type AS Description
FROM (SELECT p_partkey % {N_OCCUPATIONS} AS c, p_type FROM part) WHERE c <> 96"""
VIEWS["occ_codes"] = "SELECT DISTINCT Code, occ_group FROM occp"

# lookups, one row per edition and variable
VIEWS["lk_sex_age"] = f"""
SELECT * FROM (SELECT edition, name, label, concept, CASE WHEN contains(label, 'Male') THEN 'Male' ELSE 'Female' END AS sex,
  CASE WHEN contains(label, 'Under 5') THEN 0 ELSE list_min({NUMBERS.format('label')}) END AS age_min,
  list_max({NUMBERS.format('label')}) AS age_max, CASE WHEN contains(label, 'Male') THEN 1 ELSE 2 END AS sex_num
FROM dict_B01001) WHERE age_min IS NOT NULL"""
VIEWS["lk_size_type"] = f"""
SELECT edition, name, try_cast(regexp_extract({PART_LABEL.format('label', 4)}, '[0-9]+') AS int) AS hh_size,
  CASE WHEN contains(split_part(label, '!!', 3), 'Nonfamily') THEN 2 ELSE 1 END AS hh_type
FROM dict_B11016 WHERE {PART_LABEL.format('label', 4)} IS NOT NULL"""
VIEWS["lk_race_eth"] = f"""
SELECT edition, name, CASE WHEN contains(split_part(label, '!!', 3), 'Not Hispanic') THEN 0 ELSE 1 END AS hispanic,
  split_part(label, '!!', 4) AS race
FROM dict_B03002 WHERE {PART_LABEL.format('label', 4)} IS NOT NULL AND {PART_LABEL.format('label', 5)} IS NULL"""
VIEWS["lk_grade"] = f"""
SELECT edition, name, label, [{quoted(S.GRADE_CODES)}][place - 2] AS grade
FROM (SELECT *, row_number() OVER (PARTITION BY edition ORDER BY name) AS place FROM dict_B14007) WHERE place > 2"""
VIEWS["lk_income"] = f"""
SELECT * FROM (SELECT edition, name, label, concept,
  CASE WHEN contains(label, 'Less than') THEN 0 ELSE list_min({NUMBERS.format("replace(label, ',', '')")}) END AS income_min,
  CASE WHEN contains(label, 'or more') THEN 1000000 ELSE list_max({NUMBERS.format("replace(label, ',', '')")}) END AS income_max
FROM dict_B19001) WHERE income_min IS NOT NULL AND income_min <> 12"""

# seeds
VIEWS["hu"] = "SELECT * FROM pums WHERE NOT contains(SERIALNO, 'GQ')"
VIEWS["hh_seed"] = f"""
SELECT SERIALNO, SPORDER, PUMA, {INCOME} AS HH_Income, {HH_SIZE} AS HH_Size, {HH_TYPE} AS HH_Type
FROM (SELECT *, row_number() OVER (PARTITION BY SERIALNO ORDER BY SPORDER) AS place FROM hu) WHERE place = 1"""
VIEWS["p_seed"] = f"""
SELECT * FROM (SELECT SERIALNO, SPORDER, PUMA, SEX AS Sex, {AGE} AS Age, {RACE} AS Race, {HISPANIC} AS Hispanic,
  OCCP AS Occupation, SCHG AS Grade, {SCHOOL} AS School_Type,
  CASE WHEN OCCP = '0009' THEN 99 ELSE occ_group END AS Occ_Group
FROM hu LEFT JOIN occ_codes ON OCCP = Code) WHERE Occ_Group <> 55"""
VIEWS["gq_seed"] = f"""
SELECT SERIALNO, SPORDER, PUMA, SEX AS GQ_Sex, AGEP, RAC1P, HISP, OCCP, SCHG, SCH, ADJINC, HINCP, HHT, NP,
  {GQ_TYPE} AS GQ_Type, {GQ_AGE} AS GQ_Age
FROM pums WHERE contains(SERIALNO, 'GQ')"""

# group-quarters totals from lines and segment
VIEWS["lines"] = """
SELECT 'SF1ST   140       ' || CASE WHEN TRACTCE LIKE '%3' THEN 'x' ELSE '0' END || TRACTCE || '  ' || STATEFP || COUNTYFP ||
  repeat(' ', 22) || TRACTCE || ' Tract #1 O''Brien' AS value FROM xw
UNION ALL SELECT 'SF1ST   050       5' || min(TRACTCE) || '  ' || STATEFP || COUNTYFP || repeat(' ', 28) || ' County'
FROM xw GROUP BY STATEFP, COUNTYFP
UNION ALL SELECT 'SF1ST   040       4' || min(TRACTCE) || '  ' || STATEFP || repeat(' ', 31) || ' State' FROM xw GROUP BY STATEFP"""
VIEWS["geo"] = """
SELECT try_cast(substr(value, 19, 7) AS bigint) AS LOGRECNO, substr(value, 9, 3) AS SUMLEV, substr(value, 28, 2) AS ST_fips,
  substr(value, 30, 3) AS Cnty_fips, substr(value, 55, 6) AS Ct_fips,
  trim(substr(value, 28, 2)) || trim(substr(value, 30, 3)) || trim(substr(value, 55, 6)) AS GEOID
FROM lines"""
VIEWS["cells"] = f"""
SELECT r.LOGRECNO, 'P04300' || {pad('cell', 2)} AS variable, cast(coalesce(n, 0) AS double) AS estimate
FROM (SELECT l_suppkey AS LOGRECNO, cell FROM (SELECT DISTINCT l_suppkey FROM lineitem), range(1, {SEGMENT_CELLS + 1}) t(cell)) r
LEFT JOIN (SELECT l_suppkey, l_partkey % {SEGMENT_CELLS} + 1 AS c, count(*) AS n FROM lineitem GROUP BY ALL)
  ON l_suppkey = LOGRECNO AND c = cell"""
VIEWS["gq_totals"] = f"""
SELECT g.LOGRECNO, g.GEOID, ST_fips, Cnty_fips, Ct_fips, v.variable, estimate,
  CASE WHEN substr(v.variable, 8, 1) IN ('4', '9') THEN 1 ELSE 2 END AS GQ_Sex,
  CASE WHEN substr(v.variable, 7, 2) IN ('04','09','35','40') THEN 1 WHEN substr(v.variable, 7, 2) IN ('14','19','45','50') THEN 2
    WHEN substr(v.variable, 7, 2) IN ('24','29','55','60') THEN 3 END AS GQ_Age,
  CASE WHEN substr(v.variable, 8, 1) IN ('4', '5') THEN 'Inst' ELSE 'NonInst' END AS GQ_Type
FROM (SELECT * FROM geo WHERE SUMLEV = '140') g
CROSS JOIN (VALUES {', '.join(f"('P04300{c:02d}')" for c in S.GQ_CELLS)}) v(variable)
LEFT JOIN cells c ON c.LOGRECNO = g.LOGRECNO AND c.variable = v.variable"""
VIEWS["gq_targets"] = " UNION ALL ".join(
    f"SELECT GEOID, '{a}' AS attr, cast({a} AS varchar) AS level, {STRICT.format('estimate')} AS target FROM gq_totals GROUP BY GEOID, {a}"
    for a in ("GQ_Sex", "GQ_Age", "GQ_Type")
)


# targets from totals
def _target(attr: str, level: str, source: str, table: str, where: str = "true") -> str:
    return f"""SELECT GEOID, '{attr}' AS attr, cast({level} AS varchar) AS level, {STRICT.format('estimate')} AS target
FROM acs JOIN ({source}) lk ON variable = name WHERE table_id = '{table}' AND {where} AND {level} IS NOT NULL GROUP BY GEOID, {level}"""


def _plain(view: str) -> str:
    return f"SELECT DISTINCT * EXCLUDE (edition) FROM {view}"


VIEWS["hh_targets"] = " UNION ALL ".join(
    [
        _target("HH_Size", "hh_size", _plain("lk_size_type"), "B11016"),
        _target("HH_Type", "hh_type", _plain("lk_size_type"), "B11016"),
        _target("HH_Income", f"({bins('income_max', INCOME_BREAKS)})", _plain("lk_income"), "B19001"),
    ]
)
_RACE_LABEL = "CASE " + " ".join(f"WHEN contains(race, '{t}') THEN '{c}'" for t, c in S.RACE_LABELS) + " END"
VIEWS["occ_work"] = f"""
SELECT GEOID, occ_group, {STRICT.format('estimate')} AS target FROM acs
JOIN (SELECT DISTINCT acs_var, occ_group FROM occp WHERE length(Code2) < 10 AND acs_var IS NOT NULL) ON variable = acs_var
WHERE table_id = 'S2401' GROUP BY GEOID, occ_group"""
VIEWS["occ_rest"] = f"""
SELECT p.GEOID, p.estimate - CASE WHEN w.GEOID IS NULL THEN 0 ELSE w.target END AS target
FROM (SELECT GEOID, estimate FROM acs WHERE variable = 'B01001_001') p
LEFT JOIN (SELECT GEOID, {STRICT.format('target')} AS target FROM occ_work GROUP BY GEOID) w ON p.GEOID = w.GEOID"""
VIEWS["person_targets"] = " UNION ALL ".join(
    [
        _target("Age", f"({bins('age_max', AGE_BREAKS, True)})", _plain("lk_sex_age"), "B01001", f"variable NOT IN ({quoted(AGE_TOTALS)})"),
        _target("Sex", "sex_num", _plain("lk_sex_age"), "B01001", f"variable NOT IN ({quoted(AGE_TOTALS)})"),
        _target("Race", f"({_RACE_LABEL})", _plain("lk_race_eth"), "B03002", f"variable NOT IN ({quoted(RACE_TOTALS)})"),
        _target("Hispanic", "hispanic", _plain("lk_race_eth"), "B03002", f"variable NOT IN ({quoted(RACE_TOTALS)})"),
        _target("Grade", "grade", _plain("lk_grade"), "B14007"),
        f"""SELECT GEOID, 'School_Type' AS attr, s AS level, {STRICT.format('estimate')} AS target FROM acs
JOIN (VALUES {', '.join(f"('{v}', '{s}')" for v, s in S.SCHOOL_VARIABLES.items())}) t(v, s) ON variable = v WHERE table_id = 'B14003' GROUP BY GEOID, s""",
        "SELECT GEOID, 'Occ_Group' AS attr, cast(occ_group AS varchar) AS level, target FROM occ_work",
        "SELECT GEOID, 'Occ_Group' AS attr, '99' AS level, target FROM occ_rest",
    ]
)

# households by true home tract, and the targets that follow from it
VIEWS["homes"] = """
SELECT SERIALNO, GEOID FROM (SELECT SERIALNO, PUMA, cast(substr(SERIALNO, 7, 7) AS bigint) AS no FROM hh_seed) h
JOIN (SELECT PUMA5CE, CTFP AS GEOID, row_number() OVER (PARTITION BY PUMA5CE ORDER BY CTFP) - 1 AS place,
  count(*) OVER (PARTITION BY PUMA5CE) AS n FROM xw) x ON PUMA = PUMA5CE AND no % n = place"""


def _true(attrs, seed: str, times: int) -> str:
    return " UNION ALL ".join(
        f"SELECT GEOID, '{a}' AS attr, cast({a} AS varchar) AS level, cast({times} * count(*) AS double) AS target "
        f"FROM {seed} JOIN homes USING (SERIALNO) WHERE {a} IS NOT NULL GROUP BY GEOID, {a}"
        for a in attrs
    )


# two sweeps over five attributes are written out step by step, the whole fit over all ten is a recursion
K2_HH = ("HH_Size", "HH_Type")
K2_P = ("Sex", "Age", "Race")
FIT_HH, FIT_P = HH_ATTRS, P_ATTRS
FIT_LEVELS = {
    "HH_Size": "1234567",
    "HH_Type": "12",
    "HH_Income": "123",
    "Sex": "12",
    "Age": "123456789",
    "Race": sorted({"3", *(str(c) for _, c in S.RACE_LABELS)}),
    "Hispanic": "01",
    "Grade": sorted({*[f"{i:02d}" for i in range(1, 17)], "bb", *S.GRADE_CODES}),
    "School_Type": ("non", "pub", "pvt"),
    "Occ_Group": [str(i) for i in range(11, 54, 2)] + ["99"],
    "GQ_Sex": "12",
    "GQ_Age": "123",
    "GQ_Type": ("Inst", "NonInst"),
}
VIEWS["true_hh"] = _true(FIT_HH, "hh_seed", 5)
VIEWS["true_p"] = _true(FIT_P, "p_seed", 5)
VIEWS["true_all"] = "SELECT * FROM true_hh UNION ALL SELECT * FROM true_p"


def _fit_base(prefix: str, base: str, targets: str, attrs) -> list[tuple[str, str]]:
    cons = [(a, lv) for a in attrs for lv in FIT_LEVELS[a]]
    cols = ", ".join(
        f"max(target) FILTER (attr = '{a}' AND level = '{lv}') AS t{i}" for i, (a, lv) in enumerate(cons)
    )
    VIEWS[f"{prefix}_t"] = f"SELECT GEOID, {cols} FROM {targets} GROUP BY GEOID"
    VIEWS[f"{prefix}_w0"] = f"SELECT b.*, {', '.join(f't{i}' for i in range(len(cons)))}, cast(1 AS double) AS w FROM {base} b JOIN {prefix}_t USING (GEOID)"
    return cons


def _update(i: int, d: str, source: str) -> str:
    total = f"sum({d} * w) OVER (PARTITION BY GEOID)"
    return (
        f"SELECT * REPLACE (CASE WHEN {d} > 0 AND t{i} IS NOT NULL AND {total} > 0 "
        f"THEN w * (greatest(t{i}, 1e-5) / {total}) ELSE w END AS w) FROM {source}"
    )


def fit_chain(prefix: str, base: str, targets: str, attrs, sweeps: int = 2) -> str:
    """Weights of every area x household row after some sweeps, one window per update. ``base`` has columns d_<attr>_<level>."""
    step = 0
    for i, (a, lv) in list(enumerate(_fit_base(prefix, base, targets, attrs))) * sweeps:
        VIEWS[f"{prefix}_w{step + 1}"] = _update(i, f"d_{a}_{lv}", f"{prefix}_w{step}")
        step += 1
    return f"{prefix}_w{step}"


def fit_converged(prefix: str, base: str, targets: str, attrs, cfg: FitConfig = FitConfig()) -> str:
    """Weights of the sweep with the least mean relative gap, in a recursion over sweeps that ends area by area.

    ``<prefix>_it`` has a row per area and sweep, ``<prefix>_report`` one per area.
    """
    cons = _fit_base(prefix, base, targets, attrs)
    # one row per area: its households' counts and weights as lists, an update is a product of two lists
    counts = ", ".join(f"list(cast(d_{a}_{lv} AS double) ORDER BY SERIALNO) AS d{i}, any_value(t{i}) AS t{i}" for i, (a, lv) in enumerate(cons))
    VIEWS[f"{prefix}_a"] = f"SELECT GEOID, list(SERIALNO ORDER BY SERIALNO) AS ids, {counts} FROM {prefix}_w0 GROUP BY GEOID"
    rows = f"(SELECT a.*, i.w, i.sweep, i.gap FROM {prefix}_it i JOIN {prefix}_a a USING (GEOID) WHERE i.going)"
    for i in range(len(cons)):
        total = f"list_inner_product(d{i}, w)"
        factor = f"CASE WHEN t{i} IS NOT NULL AND {total} > 0 THEN greatest(t{i}, 1e-5) / {total} ELSE 1 END"
        rows = f"(SELECT * EXCLUDE (f) REPLACE (list_transform(list_zip(w, d{i}), lambda x: CASE WHEN x[2] > 0 THEN x[1] * f ELSE x[1] END) AS w) FROM (SELECT *, {factor} AS f FROM {rows}))"
    miss = " + ".join(f"CASE WHEN t{i} > 0 THEN abs(list_inner_product(d{i}, w) - t{i}) / t{i} ELSE 0 END" for i in range(len(cons)))
    counted = " + ".join(f"CASE WHEN t{i} > 0 THEN 1 ELSE 0 END" for i in range(len(cons)))
    VIEWS[f"{prefix}_it"] = f"""
SELECT GEOID, list_transform(ids, lambda x: cast(1 AS double)) AS w, 0 AS sweep, cast('inf' AS double) AS gap, false AS converged, true AS going FROM {prefix}_a
UNION ALL
SELECT GEOID, w, sweep + 1, new_gap, abs(gap - new_gap) < {cfg.tol}, abs(gap - new_gap) >= {cfg.tol} AND sweep + 1 < {cfg.max_iter}
FROM (SELECT *, ({miss}) / greatest({counted}, 1) AS new_gap FROM {rows})"""
    VIEWS[f"{prefix}_best"] = f"""
SELECT GEOID, sweep FROM {prefix}_it WHERE sweep > 0 QUALIFY row_number() OVER (PARTITION BY GEOID ORDER BY round(gap, 9), sweep) = 1"""
    VIEWS[f"{prefix}_fin"] = f"""
SELECT b.* EXCLUDE (w), f.w FROM (SELECT GEOID, unnest(ids) AS SERIALNO, unnest(i.w) AS w FROM {prefix}_it i JOIN {prefix}_best USING (GEOID, sweep) JOIN {prefix}_a USING (GEOID)) f
JOIN {prefix}_w0 b USING (GEOID, SERIALNO)"""
    unreachable = " + ".join(f"CASE WHEN t{i} > 0 AND max(d_{a}_{lv}) = 0 THEN 1 ELSE 0 END" for i, (a, lv) in enumerate(cons))
    VIEWS[f"{prefix}_report"] = f"""
SELECT GEOID, sweeps, gap, converged, unreachable
FROM (SELECT GEOID, max(sweep) AS sweeps, min(gap) AS gap, bool_or(converged) AS converged FROM {prefix}_it GROUP BY GEOID)
JOIN (SELECT GEOID, {unreachable} AS unreachable FROM {prefix}_w0 GROUP BY GEOID, {', '.join(f't{i}' for i in range(len(cons)))}) USING (GEOID)"""
    return f"{prefix}_fin"


_hh_d = ", ".join(f"CASE WHEN cast({a} AS varchar) = '{lv}' THEN 1 ELSE 0 END AS d_{a}_{lv}" for a in FIT_HH for lv in FIT_LEVELS[a])
_p_d = ", ".join(f"count(*) FILTER (cast({a} AS varchar) = '{lv}') AS d_{a}_{lv}" for a in FIT_P for lv in FIT_LEVELS[a])
_gq_d = ", ".join(
    f"CASE WHEN cast({a} AS varchar) = '{lv}' THEN 1 ELSE 0 END AS d_{a}_{lv}" for a in ("GQ_Sex", "GQ_Age", "GQ_Type") for lv in FIT_LEVELS[a]
)
VIEWS["hh_d"] = f"SELECT PUMA, SERIALNO, {_hh_d} FROM hh_seed"
VIEWS["p_d"] = f"SELECT SERIALNO, count(*) AS np, {_p_d} FROM p_seed GROUP BY SERIALNO"
VIEWS["base"] = "SELECT CTFP AS GEOID, hh_d.*, p_d.* EXCLUDE (SERIALNO) FROM xw JOIN hh_d ON PUMA = PUMA5CE JOIN p_d USING (SERIALNO)"
VIEWS["gq_base"] = f"SELECT CTFP AS GEOID, PUMA, SERIALNO || '-' || SPORDER AS SERIALNO, {_gq_d} FROM xw JOIN gq_seed ON PUMA = PUMA5CE"

IPU = fit_chain("ipu", "base", "true_all", (*K2_HH, *K2_P))
IPU_WHOLE = fit_converged("ipuc", "base", "true_all", (*FIT_HH, *FIT_P))
_POPULATED = "(SELECT * FROM gq_targets JOIN (SELECT GEOID FROM gq_targets GROUP BY GEOID HAVING sum(target) > 0) USING (GEOID))"
RAKE = fit_chain("rake", "gq_base", _POPULATED, GQ_ATTRS)
RAKE_WHOLE = fit_converged("rakec", "gq_base", _POPULATED, GQ_ATTRS)


def support(attrs, index: str) -> str:
    """Pattern id of a row: md5 of the positions of its non-zero constraints among those that occur in the targets."""
    parts = [f"CASE WHEN d_{a}_{lv} > 0 THEN (SELECT k FROM {index} WHERE attr = '{a}' AND level = '{lv}') END" for a in attrs for lv in FIT_LEVELS[a]]
    return f"md5(concat_ws(',', {', '.join(parts)}))"


def _index(attrs, targets: str) -> str:
    order = "CASE attr " + " ".join(f"WHEN '{a}' THEN {i}" for i, a in enumerate(attrs)) + " END"
    return f"SELECT attr, level, row_number() OVER (ORDER BY {order}, level) - 1 AS k FROM (SELECT DISTINCT attr, level FROM {targets} WHERE target IS NOT NULL AND attr IN ({quoted(attrs)}))"


def draw_chain(prefix: str, weights: str, attrs, targets: str, seed: int = 42) -> str:
    """Household drawn by each draw: households in order of pattern, then of a hash of the id."""
    VIEWS[f"{prefix}_ix"] = _index(attrs, targets)
    VIEWS[f"{prefix}_m"] = f"SELECT *, {support(attrs, f'{prefix}_ix')} AS sid, cast(round_even(w * 1000000, 0) AS bigint) AS m FROM {weights}"
    return position_chain(prefix, f"(SELECT *, sid || md5(SERIALNO) || SERIALNO AS okey FROM {prefix}_m)", seed)


def position_chain(prefix: str, source: str, seed: int = 42) -> str:
    """``source`` has GEOID, SERIALNO, m and okey, which orders an area's rows."""
    VIEWS[f"{prefix}_c"] = f"SELECT GEOID, SERIALNO, m, cast(sum(m) OVER (PARTITION BY GEOID ORDER BY okey) AS bigint) - m AS lo FROM {source} WHERE m > 0"
    VIEWS[f"{prefix}_n"] = f"SELECT GEOID, cast(sum(m) AS bigint) AS total, (cast(sum(m) AS bigint) + 500000) // 1000000 AS n FROM {prefix}_c GROUP BY GEOID"
    VIEWS[f"{prefix}_k"] = f"SELECT GEOID, total, unnest(range(1, n + 1)) AS new_id FROM {prefix}_n"
    VIEWS[f"{prefix}_p"] = f"SELECT GEOID, new_id, cast('0x' || substr(md5('{seed}|' || GEOID || '|' || new_id), 1, 15) AS bigint) % total AS pos FROM {prefix}_k"
    VIEWS[f"{prefix}_draw"] = f"SELECT p.GEOID, new_id, SERIALNO FROM {prefix}_p p ASOF JOIN {prefix}_c c ON p.GEOID = c.GEOID AND p.pos >= c.lo"
    return f"{prefix}_draw"


VIEWS["rake_ix"] = _index(GQ_ATTRS, "gq_targets")
GQ_DRAW = draw_chain("rakec", RAKE_WHOLE, GQ_ATTRS, "gq_targets")
VIEWS["gq_pop"] = f"""
SELECT d.GEOID, d.new_id, d.SERIALNO, s.* EXCLUDE (SERIALNO, PUMA), d.GEOID || 'GQ' || d.new_id AS p_id
FROM {GQ_DRAW} d JOIN gq_seed s ON d.SERIALNO = s.SERIALNO || '-' || s.SPORDER"""
VIEWS["gq_coded"] = f"""
SELECT g.*, {AGE} AS Age, GQ_Sex AS Sex, {RACE} AS Race, {HISPANIC} AS Hispanic, SCHG AS Grade, {SCHOOL} AS School_Type,
  CASE WHEN OCCP = '0009' THEN 99 ELSE occ_group END AS Occ_Group
FROM gq_pop g LEFT JOIN occ_codes ON OCCP = Code"""
VIEWS["gq_marginals"] = " UNION ALL ".join(
    f"SELECT GEOID, '{a}' AS attr, cast({a} AS varchar) AS level, count(*) AS gq_count FROM gq_coded "
    f"{'WHERE Occ_Group <> 55' if a == 'Occ_Group' else ''} GROUP BY GEOID, {a}"
    for a in P_ATTRS
)


def gq_rows(attrs) -> str:
    own = {"HH_Income": "'0'", "HH_Type": "'GQ_' || GQ_Type", "HH_Size": "cast(NULL AS varchar)"}
    where = " WHERE Occ_Group <> 55" if "Occ_Group" in attrs else ""
    cols = ", ".join(f"{own.get(a, f'cast({a} AS varchar)')} AS {a}" for a in attrs)
    return f"SELECT GEOID, GEOID || '_GQ_' || GQ_Type || '_' || new_id AS hhid, p_id, {cols} FROM gq_coded{where}"


VIEWS["corrected"] = """
SELECT t.GEOID, t.attr, t.level, CASE WHEN target IS NOT NULL THEN greatest(target - coalesce(gq_count, 0), 0) END AS target,
  greatest(coalesce(gq_count, 0) - target, 0) AS shortfall
FROM true_p t LEFT JOIN gq_marginals g ON t.GEOID = g.GEOID AND t.attr = g.attr AND t.level = g.level"""
VIEWS["syn_targets"] = "SELECT * FROM true_hh UNION ALL SELECT GEOID, attr, level, target FROM corrected"
SYN = fit_converged("syn", "base", "syn_targets", (*FIT_HH, *FIT_P))
SYN_DRAW = draw_chain("syn", SYN, (*FIT_HH, *FIT_P), "syn_targets")


def expand(draws: str) -> str:
    attrs = ", ".join(f"cast({a} AS varchar) AS {a}" for a in (*FIT_HH, *FIT_P))
    return f"""SELECT GEOID, GEOID || '_' || new_id AS hhid,
  GEOID || '_' || new_id || '_' || row_number() OVER (PARTITION BY GEOID ORDER BY new_id, p.SPORDER) AS p_id, {attrs}
FROM {draws} d JOIN p_seed p ON d.SERIALNO = p.SERIALNO JOIN hh_seed h ON d.SERIALNO = h.SERIALNO"""


VIEWS["syn_pop"] = f"{expand(SYN_DRAW)} UNION ALL {gq_rows((*FIT_HH, *FIT_P))}"
VIEWS["syn_gen"] = " UNION ALL ".join(
    [f"SELECT GEOID, '{a}' AS attr, {a} AS level, count(*) AS gen FROM (SELECT DISTINCT GEOID, hhid, {a} FROM syn_pop) WHERE {a} IS NOT NULL GROUP BY GEOID, {a}" for a in FIT_HH]
    + [f"SELECT GEOID, '{a}' AS attr, {a} AS level, count(*) AS gen FROM syn_pop WHERE {a} IS NOT NULL GROUP BY GEOID, {a}" for a in FIT_P]
)
VIEWS["area_cmp"] = """
SELECT GEOID, attr, level, coalesce(target, 0) AS obs, coalesce(gen, 0) AS gen FROM true_all FULL JOIN syn_gen USING (GEOID, attr, level)"""
VIEWS["area_err"] = "SELECT GEOID, attr, CASE WHEN sum(obs) <> 0 THEN sum(abs(obs - gen)) / sum(obs) END AS pmiss FROM area_cmp GROUP BY GEOID, attr"

# a cheaper observed / generated pair: totals against seed households counted by home tract
VIEWS["home_gen"] = " UNION ALL ".join(
    f"SELECT GEOID, '{a}' AS attr, cast({a} AS varchar) AS level, count(*) AS gen FROM hh_seed JOIN homes USING (SERIALNO) WHERE {a} IS NOT NULL GROUP BY GEOID, {a}"
    for a in ("HH_Size", "HH_Type", "HH_Income")
)
VIEWS["home_err"] = """
SELECT GEOID, attr, CASE WHEN sum(obs) <> 0 THEN sum(abs(obs - gen)) / sum(obs) END AS pmiss
FROM (SELECT GEOID, attr, level, coalesce(target, 0) / 100 AS obs, coalesce(gen, 0) AS gen FROM hh_targets FULL JOIN home_gen USING (GEOID, attr, level))
GROUP BY GEOID, attr"""


def compose(sql: str) -> str:
    """Prefix a statement with exactly the views it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b\w+\b", text):
            if word in VIEWS and word not in needed and word not in open_views:
                open_views.append(word)
                visit(VIEWS[word])
                needed.append(word)

    open_views: list[str] = []
    visit(sql)
    if not needed:
        return sql
    heads = ", ".join(f"{n} AS {'MATERIALIZED ' if _costly(n) else ''}({VIEWS[n]})" for n in needed)
    return f"WITH RECURSIVE {heads} {sql}"


def _costly(name: str) -> bool:
    return not name.startswith(("dict_", "lk_")) and not re.fullmatch(r"(ipu|rake)_w\d+", name) and not name.endswith("_it")
