"""Areas of a region, however many prefixes describe it."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractweave.functions import scalars as S
from tractweave.functions.local import small_table

FEW = 8
"""Prefixes given as a short list become a plain filter."""
LONGEST = 15
"""Length of a block's code, the longest there is."""


def region_table(regions: DataFrame) -> DataFrame:
    """Distinct prefixes of which none contains another: the shorter one covers its areas."""
    rows = regions.select(F.col(regions.columns[0]).cast("string").alias("prefix")).filter("prefix IS NOT NULL").distinct()
    shorter = F.explode(F.transform(F.sequence(F.lit(0), F.length("prefix") - 1), lambda n: F.substring("prefix", 1, n)))
    covered = rows.filter("length(prefix) > 0").select(F.col("prefix").alias("inner"), shorter.alias("prefix")).join(rows, "prefix", "left_semi")
    return rows.join(covered.select(F.col("inner").alias("prefix")).distinct(), "prefix", "left_anti")


def in_regions(df: DataFrame, regions: DataFrame | Sequence[str] | str | None, column: str = "GEOID") -> DataFrame:
    """Rows whose code starts with a prefix of the region: one prefix, a list, or a frame whose first column has them.

    A frame of any size is one join: every row offers the beginnings of its code, of which at most one is a prefix.
    ``None`` keeps all rows; a NULL code is in no region.
    """
    if regions is None:
        return df
    if isinstance(regions, str):
        regions = [regions]
    if not isinstance(regions, DataFrame):
        regions = list(regions)
        if len(regions) <= FEW:
            return df.filter(S.in_region(F.col(column), regions)) if regions else df.limit(0)
        regions = small_table(df.sparkSession, {"prefix": pa.array(regions, pa.string())}, "prefix string")
    last = F.least(F.length(column), F.lit(LONGEST))
    beginnings = F.transform(F.sequence(F.lit(0), last), lambda n: F.substring(F.col(column), 1, n))
    offered = df.withColumn("_prefix", F.explode(beginnings))
    table = region_table(regions).withColumnRenamed("prefix", "_prefix")
    return offered.join(table, "_prefix", "left_semi").select(*df.columns)
