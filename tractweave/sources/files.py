"""Readers and writers. Columns are found by name and have given types; codes stay text."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractweave.functions import scalars as S
from tractweave.functions.local import small_table
from tractweave.sources.characteristics import acs_tables, pums_columns

# 1-based first and last character of each field, and segment column positions.
GEO_FIELDS = {
    "LOGRECNO": (19, 25),
    "SUMLEV": (9, 11),
    "ST_fips": (28, 29),
    "Cnty_fips": (30, 32),
    "Ct_fips": (55, 60),
}
SEGMENT_RECORD = 5
SEGMENT_FIRST, SEGMENT_CELLS = 179, 63

PUMS_SCHEMA = (
    "SERIALNO string, SPORDER int, PUMA string, SEX string, AGEP int, RAC1P string, HISP string, OCCP string, "
    "SCHG string, SCH string, ADJINC string, HINCP double, HHT string, NP int"
)
ACS_SCHEMA = "GEOID string, variable string, estimate double"
CROSSWALK_SCHEMA = "STATEFP string, COUNTYFP string, TRACTCE string, PUMA5CE string"
CODELIST_SCHEMA = "Code string, Code2 string, Description string"
DICTIONARY_SCHEMA = "name string, label string, concept string"
VERSION_SCHEMA = "number long, folder string"

# States by their two letters, with their numbers.
STATE_FIPS = {
    "AL": "01", "AK": "02", "AZ": "04", "AR": "05", "CA": "06", "CO": "08", "CT": "09", "DE": "10", "DC": "11", "FL": "12",
    "GA": "13", "HI": "15", "ID": "16", "IL": "17", "IN": "18", "IA": "19", "KS": "20", "KY": "21", "LA": "22", "ME": "23",
    "MD": "24", "MA": "25", "MI": "26", "MN": "27", "MS": "28", "MO": "29", "MT": "30", "NE": "31", "NV": "32", "NH": "33",
    "NJ": "34", "NM": "35", "NY": "36", "NC": "37", "ND": "38", "OH": "39", "OK": "40", "OR": "41", "PA": "42", "RI": "44",
    "SC": "45", "SD": "46", "TN": "47", "TX": "48", "UT": "49", "VT": "50", "VA": "51", "WA": "53", "WV": "54", "WI": "55",
    "WY": "56", "PR": "72",
}


def state_number(state: Column) -> Column:
    """Two-digit number of a state given by its letters or its number; NULL for anything else. Partition folders named by
    numbers are read as whole numbers, without the leading zero."""
    known = F.create_map(*[F.lit(x) for pair in STATE_FIPS.items() for x in pair])
    text = F.upper(F.trim(state.cast("string")))
    return F.coalesce(F.try_element_at(known, text), F.when(text.rlike("^[0-9]{1,2}$"), F.lpad(text, 2, "0")))


def _spellings(state: str) -> list[str]:
    """Letters and numbers that data may name a state by."""
    text = str(state).strip().upper()
    if text not in STATE_FIPS and not (text.isdigit() and len(text) <= 2):
        raise ValueError(f"unknown state: {state!r}")
    number = STATE_FIPS.get(text, text.zfill(2))
    letters = [name for name, fips in STATE_FIPS.items() if fips == number]
    return [number, str(int(number)), *letters, *map(str.lower, letters)]


def _state_of(path: Column) -> Column:
    """State of a file named by its two letters and then a digit or ``geo``, upper case; NULL for all other names."""
    code = F.upper(F.regexp_extract(path, r"(?i)/([a-z]{2})(?:geo|[0-9])[^/]*$", 1))
    return F.when(code.isin(list(STATE_FIPS)), code)


def _state(state: str | None) -> Column:
    return F.lit(state.upper()) if state is not None else _state_of(F.col("_metadata.file_path"))


def read_lines(spark: SparkSession, paths: str | Sequence[str], state: str | None = None) -> DataFrame:
    """Text lines, one or many state files. Without ``state`` it is taken from each file's name. No quote or comment rules."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).select("value", _state(state).alias("state"))


def fixed_width(lines: DataFrame, fields: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Cut ``value`` into named fields by character position; other columns are kept."""
    cut = {name: F.substring("value", lo, hi - lo + 1) for name, (lo, hi) in fields.items()}
    return lines.withColumns(cut).drop("value")


def parse_geo(lines: DataFrame) -> DataFrame:
    """Geography records: numeric record number (NULL when malformed) and area code without blanks."""
    code = F.concat(*[F.trim(c) for c in ("ST_fips", "Cnty_fips", "Ct_fips")])
    return fixed_width(lines, GEO_FIELDS).withColumns(
        {"LOGRECNO": F.trim("LOGRECNO").try_cast("long"), "GEOID": code}
    )


def read_geo(spark: SparkSession, paths, state: str | None = None) -> DataFrame:
    return parse_geo(read_lines(spark, paths, state))


def read_segment(spark: SparkSession, paths, state: str | None = None) -> DataFrame:
    """Record number and the 63 cells of a headerless segment file, picked by position."""
    last = SEGMENT_FIRST + SEGMENT_CELLS - 1
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(last)])
    cells = [
        F.col(f"_c{SEGMENT_FIRST - 2 + i}").try_cast("double").alias(f"P04300{i:02d}")
        for i in range(1, SEGMENT_CELLS + 1)
    ]
    raw = spark.read.csv(paths if isinstance(paths, str) else list(paths), schema=schema)
    return raw.select(
        _state(state).alias("state"),
        F.trim(F.col(f"_c{SEGMENT_RECORD - 1}")).try_cast("long").alias("LOGRECNO"),
        *cells,
    )


def _table(spark: SparkSession, path: str, schema: str, fmt: str, names: Sequence[str]) -> DataFrame:
    """Columns ``names``, found by name and cast to the schema's types; one that the data lack is an error.

    All files of a CSV data set must have the same header.
    """
    df = spark.read.csv(path, header=True, enforceSchema=False) if fmt == "csv" else spark.read.parquet(path)
    have = {c.upper(): c for c in df.columns}
    missing = [n for n in names if n.upper() not in have]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    types = {f.name: f.dataType for f in T.StructType.fromDDL(schema)}
    # a column of the right type stays as it is, so that filters still prune partitions
    return df.select(
        *[
            (c if df.schema[have[n.upper()]].dataType == types[n] else c.try_cast(types[n])).alias(n)
            for n in names
            for c in [F.col(have[n.upper()])]
        ]
    )


def _columns_of(spark: SparkSession, path: str, fmt: str) -> set[str]:
    df = spark.read.csv(path, header=True) if fmt == "csv" else spark.read.parquet(path)
    return {c.upper() for c in df.columns}


def _asked(states, year, survey) -> list[str]:
    """Partition columns that a filter needs."""
    return [n for n, v in (("state", states), ("year", year), ("survey", survey)) if v is not None]


def read_pums(
    spark: SparkSession,
    path: str,
    chars: Sequence[str],
    states: Sequence[str] | DataFrame | None = None,
    year: int | None = None,
    survey: str | None = None,
    fmt: str = "parquet",
    state: str | None = None,
) -> DataFrame:
    """Microdata columns of the requested characteristics; ``PUMA`` holds state and PUMA (``puma_key``).

    ``state``, ``year`` and ``survey`` are columns of the data set, normally its partition directories; a filter on a column
    that is not there is an error. States go by letters or numbers, whichever the data have; an unknown one in a list is an
    error. ``states`` may be a frame with a ``state`` column: partitions of other states are then
    pruned when the frame is known. The state of a row is its ``ST`` or ``state`` column, or the argument ``state`` (two
    letters) for data of one state. Rows of an unknown state have no PUMA.
    """
    schema = f"{PUMS_SCHEMA}, ST string, state string, year int, survey string"
    names = ["SERIALNO", "SPORDER", *pums_columns(chars), *_asked(states, year, survey)]
    if state is None:
        have = _columns_of(spark, path, fmt)
        names += [next((n for n in ("ST", "state") if n.upper() in have), "state")]
    rows = _partitions(_table(spark, path, schema, fmt, list(dict.fromkeys(names))), states, year, survey)
    if state is not None:
        number = F.lit(STATE_FIPS[state.upper()])
    elif names[-1] == "ST":
        number = F.col("ST")
    else:
        number = state_number(F.col("state"))
    return select_pums(rows.withColumn("PUMA", S.puma_key(number, F.col("PUMA"))), chars)


def select_pums(pums: DataFrame, chars: Sequence[str]) -> DataFrame:
    return pums.select("SERIALNO", "SPORDER", *pums_columns(chars))


def read_acs(
    spark: SparkSession,
    path: str,
    chars: Sequence[str],
    level: str,
    states: Sequence[str] | DataFrame | None = None,
    year: int | None = None,
    survey: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Area totals of the distinct tables behind the characteristics, at one level of geography."""
    schema = f"{ACS_SCHEMA}, table_id string, level string, state string, year int, survey string"
    names = ["table_id", "level", "GEOID", "variable", "estimate", *_asked(states, year, survey)]
    rows = _partitions(_table(spark, path, schema, fmt, names), states, year, survey)
    return select_acs(rows.filter(F.lower("level") == level.lower()), chars)


def select_acs(acs: DataFrame, chars: Sequence[str]) -> DataFrame:
    return acs.filter(F.col("table_id").isin(acs_tables(chars))).select("table_id", "GEOID", "variable", "estimate")


def _partitions(df: DataFrame, states, year, survey) -> DataFrame:
    if states is not None and not isinstance(states, DataFrame):
        spellings = [spelling for s in states for spelling in _spellings(s)]
        df = df.filter(F.col("state").isNotNull() & F.col("state").isin(spellings))
    if year is not None:
        df = df.filter(F.col("year").isNotNull() & (F.col("year") == year))
    if survey is not None:
        df = df.filter(F.col("survey").isNotNull() & (F.col("survey") == survey))
    if isinstance(states, DataFrame):
        wanted = states.select(state_number(F.col("state")).alias("_wanted")).distinct()
        df = df.join(wanted, state_number(F.col("state")) == F.col("_wanted"), "left_semi")
    return df


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path, CROSSWALK_SCHEMA, "csv", ["STATEFP", "COUNTYFP", "TRACTCE", "PUMA5CE"])


def read_codelist(spark: SparkSession, path: str) -> DataFrame:
    """Occupation code list exported as CSV; its three columns are taken by position."""
    return spark.read.schema(CODELIST_SCHEMA).csv(path, header=True)


def read_dictionary(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _table(spark, path, DICTIONARY_SCHEMA, fmt, ["name", "label", "concept"])


def _versions(spark: SparkSession, path: str) -> Row | None:
    """The latest version of a saved lookup, None if there is none."""
    try:
        return spark.read.schema(VERSION_SCHEMA).json(f"{path}/versions").orderBy(F.desc("number"), F.desc("folder")).first()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def save_lookup(df: DataFrame, path: str) -> None:
    """Save a new version of a lookup. Its rows go to a folder of their own, and the one small file that names the folder is
    written last: if the write dies, readers go on with the version before. Older versions stay until somebody deletes them.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    before = _versions(spark, path)
    df.write.parquet(f"{path}/data/{folder}")
    number = before.number + 1 if before else 1
    pointer = small_table(spark, {"number": pa.array([number], pa.int64()), "folder": [folder]}, VERSION_SCHEMA)
    pointer.coalesce(1).write.mode("append").json(f"{path}/versions")


def load_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of a saved lookup, or a plain Parquet folder. Parquet sizes are known to the planner, which
    broadcasts it only when it is small."""
    version = _versions(spark, path)
    return spark.read.parquet(f"{path}/data/{version.folder}" if version else path)


def gq_cells_long(segment: DataFrame) -> DataFrame:
    """All 63 cells of a segment in long form."""
    values = F.array(*[f"P04300{i:02d}" for i in range(1, SEGMENT_CELLS + 1)])
    return segment.select("LOGRECNO", F.posexplode(values).alias("i", "estimate")).select(
        "LOGRECNO", S.gq_variable(F.col("i") + 1).alias("variable"), "estimate"
    )
