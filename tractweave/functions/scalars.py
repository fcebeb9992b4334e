"""Column expressions. Each returns a native ``Column``; NULL handling is stated where it differs from Spark's."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tractweave.config import NOT_WORKING_CODE, NOT_WORKING_GROUP

# Race label fragments in match order, school codes, group-quarters cell positions.
RACE_LABELS = (
    ("White", "1"),
    ("Black", "2"),
    ("American Indian", "3"),
    ("Asian", "6"),
    ("Native Hawaiian", "7"),
    ("Some other", "8"),
    ("Two or more", "9"),
)
SCHOOL_CODES = {"b": "non", "1": "non", "2": "pub", "3": "pvt"}
SCHOOL_VARIABLES = {
    "B14003_003": "pub",
    "B14003_031": "pub",
    "B14003_012": "pvt",
    "B14003_040": "pvt",
    "B14003_021": "non",
    "B14003_049": "non",
}
GQ_CELLS = (4, 9, 14, 19, 24, 29, 35, 40, 45, 50, 55, 60)
GQ_AGE_CELLS = {1: ("04", "09", "35", "40"), 2: ("14", "19", "45", "50"), 3: ("24", "29", "55", "60")}
GRADE_CODES = tuple(f"{i:02d}" for i in range(1, 17)) + ("bb",)


def strict_sum(x: Column) -> Column:
    """Sum that is NULL as soon as one input is NULL."""
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


def is_in(x: Column, values: Iterable) -> Column:
    """Membership that is false, not NULL, for a NULL input."""
    return F.coalesce(x.isin(list(values)), F.lit(False))


def if_else(cond: Column, yes, no) -> Column:
    """Two-sided choice that stays NULL when the condition is NULL."""
    return F.when(cond, yes).when(~cond, no)


def first_match(cases: Iterable[tuple[Column, object]]) -> Column:
    """Value of the first true condition; NULL when none is."""
    return reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), cases, F)


def cut_left(x: Column, breaks: Sequence[float], include_lowest: bool = False) -> Column:
    """1-based code of the left-closed bin holding ``x``; NULL outside the edges.

    With ``include_lowest`` the last bin also holds its upper edge.
    """
    edges = list(zip(breaks[:-1], breaks[1:]))

    def inside(i: int) -> Column:
        lo, hi = edges[i]
        closed = include_lowest and i == len(edges) - 1
        return (x >= F.lit(lo)) & ((x <= F.lit(hi)) if closed else (x < F.lit(hi)))

    return first_match((inside(i), i + 1) for i in range(len(edges)))


def top_code(x: Column, top: int = 7) -> Column:
    return F.when(x >= top, F.lit(top)).otherwise(x).cast("int")


def household_type(hht: Column) -> Column:
    """1 family, 2 everything else, NULL included."""
    return F.when(is_in(hht, ("1", "2", "3")), 1).otherwise(2)


def condense_race(rac1p: Column) -> Column:
    return F.when(rac1p.isin("3", "4", "5"), F.lit("3")).otherwise(rac1p)


def hispanic_flag(hisp: Column) -> Column:
    return if_else(hisp == "01", F.lit(0), F.lit(1))


def school_type(sch: Column) -> Column:
    return first_match((sch == code, name) for code, name in SCHOOL_CODES.items())


def school_variable(variable: Column) -> Column:
    return first_match((variable == code, name) for code, name in SCHOOL_VARIABLES.items())


def occupation_group(occp: Column, group: Column) -> Column:
    """Occupation group with the not-working code moved to its own group."""
    return F.when(occp == NOT_WORKING_CODE, F.lit(NOT_WORKING_GROUP)).otherwise(group)


def race_code(label: Column) -> Column:
    return first_match((label.contains(text), code) for text, code in RACE_LABELS)


def gq_type(schg: Column, occp: Column) -> Column:
    """Non-institutional when in school or in an occupation; NULL only if school is NULL and no occupation is held."""
    return if_else((schg != "bb") | ~is_in(occp, ("0009", "9920")), F.lit("NonInst"), F.lit("Inst"))


def gq_cell_sex(variable: Column) -> Column:
    return F.when(is_in(F.substring(variable, 8, 1), ("4", "9")), 1).otherwise(2)


def gq_cell_age(variable: Column) -> Column:
    cell = F.substring(variable, 7, 2)
    return first_match((cell.isin(*cells), age) for age, cells in GQ_AGE_CELLS.items())


def gq_cell_type(variable: Column) -> Column:
    return F.when(is_in(F.substring(variable, 8, 1), ("4", "5")), "Inst").otherwise("NonInst")


def adjusted_income(hincp: Column, adjinc: Column) -> Column:
    return hincp * adjinc.try_cast("double")


def gq_variable(cell: Column) -> Column:
    """Cell number -> zero-padded variable name."""
    return F.format_string("P04300%02d", cell)


def label_levels(label: Column, n: int) -> list[Column]:
    """First ``n`` parts of a ``!!`` path; missing ones NULL, surplus ones dropped."""
    parts = F.split(label, "!!")
    return [F.try_element_at(parts, F.lit(i)) for i in range(1, n + 1)]


def text_key(text: Column) -> Column:
    """Match key: punctuation and spaces removed, lower case."""
    return F.lower(F.regexp_replace(text, r"[\p{Punct} ]", ""))


def all_numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("([0-9]+)"), 1), lambda s: s.try_cast("double"))


def min_number(text: Column) -> Column:
    """Smallest number in a text; NULL when it holds none."""
    return F.array_min(all_numbers(text))


def max_number(text: Column) -> Column:
    return F.array_max(all_numbers(text))


def money(text: Column) -> Column:
    """Text with thousands separators removed, for the number extractors."""
    return F.regexp_replace(text, ",", "")


def first_number(text: Column) -> Column:
    return F.regexp_extract(text, "([0-9]+)", 1).try_cast("int")


def rel_diff(obs: Column, gen: Column) -> Column:
    """|obs - gen| / obs; NULL when nothing was observed."""
    return F.try_divide(F.abs(obs - gen), obs)


def puma_key(state: Column, puma: Column) -> Column:
    """State number and PUMA code in one, as PUMA codes repeat from state to state."""
    return F.concat(F.lpad(state.cast("string"), 2, "0"), F.lpad(puma.cast("string"), 5, "0"))


def in_region(geoid: Column, fips) -> Column:
    """True for area codes that start with one of the given prefixes; ``None`` keeps every area."""
    if fips is None:
        return F.lit(True)
    prefixes = [fips] if isinstance(fips, str) else list(fips)
    return reduce(lambda a, b: a | b, (geoid.startswith(p) for p in prefixes))
