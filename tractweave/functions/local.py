"""Small tables written down in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def small_table(spark: SparkSession, columns: dict[str, Sequence], schema: str) -> DataFrame:
    """A local relation. Unlike rows shipped through an RDD its size is known, so the planner broadcasts it when small."""
    return spark.createDataFrame(pa.table(dict(columns)), schema)
