"""Long <-> wide helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """One row per (input row, attribute): ``keys``, ``attr``, ``level`` (text). One pass for all attributes."""
    pairs = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("level")) for a in attrs])
    return df.select(*keys, F.explode(pairs).alias("c")).select(*keys, "c.attr", "c.level")


def widen(long: DataFrame, attr: str, levels: Sequence, value: str = "target", key: str = "GEOID") -> DataFrame:
    """One row per area, one column per level. Levels are given, so no extra job finds them."""
    return (
        long.filter(F.col("attr") == attr)
        .groupBy(key)
        .pivot("level", [str(v) for v in levels])
        .agg(F.first(value))
    )


def lengthen(wide: DataFrame, attr: str, key: str = "GEOID", value: str = "target") -> DataFrame:
    """Inverse of :func:`widen`; absent cells come out as NULL values."""
    names = [c for c in wide.columns if c != key]
    return wide.unpivot(key, names, "level", value).select(key, F.lit(attr).alias("attr"), "level", value)


def roll_up(long: DataFrame, n_chars: int, value: Column) -> DataFrame:
    """Totals of the containing areas: area codes cut to ``n_chars``, then aggregated by ``value``."""
    return long.groupBy(F.substring("GEOID", 1, n_chars).alias("GEOID"), "attr", "level").agg(value.alias("target"))
