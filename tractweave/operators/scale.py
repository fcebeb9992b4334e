"""Building blocks that keep hot groups off a single task: staged tables, split numbering, sliced as-of match."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="tractweave-")


def stage_dir(spark: SparkSession) -> str:
    """Shared folder the cluster names. A local session without one gets a temporary folder; a cluster has to name it."""
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        path = _own_dir()
    return path.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder."""
    return f"{stage_dir(spark)}/tractweave/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs one stage, and gives the planner a true size for later joins. All
    tables of an application lie in one folder; ``drop_stage`` deletes it when the results are written.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete staged tables, or without any all that the application has staged. What still reads them fails."""
    if tables:
        folders = {os.path.dirname(f) for df in tables for f in df.inputFiles()}
    else:
        folders = {f"{stage_dir(spark)}/tractweave/{spark.sparkContext.applicationId}"}
    for folder in folders:
        if f"/tractweave/{spark.sparkContext.applicationId}" not in folder:
            raise ValueError(f"{folder} is not a staged table of this application")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_bits(text: Column, digits: int) -> Column:
    """Leading hex digits of an md5 as a number. The same in every engine, unlike Spark's own hash."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def hex_bucket(hex_text: Column, n_buckets: Column) -> Column:
    """Bucket 0..n-1 of a hex string; buckets follow the order of the strings."""
    lead = F.conv(F.substring(hex_text, 1, 8), 16, 10).cast("long")
    return F.shiftright(lead * n_buckets.cast("long"), 32)


def int_div(a: Column, b: Column) -> Column:
    """Integer division that stays exact for large numbers."""
    return F.call_function("div", a, b)


def ceil_div(a: Column, b: Column) -> Column:
    return int_div(a + b - 1, b)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence, out: str, bucket: Column | None = None) -> DataFrame:
    """0-based number of each row inside its group.

    ``bucket`` splits large groups into consecutive runs: rows are numbered per run and shifted by the size of the runs
    before. It is NULL for groups that need no split, and those take no part in the extra pass.
    """
    if bucket is None:
        return df.withColumn(out, _place(Window.partitionBy(*keys).orderBy(*order)))
    df = df.withColumn("_run", bucket)
    before = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        df.filter("_run IS NOT NULL")
        .groupBy(*keys, "_run")
        .count()
        .withColumn("_shift", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    within = Window.partitionBy(*keys, "_run").orderBy(*order)
    return (
        df.withColumn(out, _place(within))
        .join(shifts, [*keys, "_run"], "left")
        .withColumn(out, F.col(out) + F.coalesce("_shift", F.lit(0)))
        .drop("_run", "_shift")
    )


def _place(window) -> Column:
    return F.row_number().over(window).cast("long") - 1


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before this one in its group."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)))


def match_positions(points: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give every point the span ``[lo, hi)`` it falls into, per key.

    points: keys, ``pos``, ``base``, ``width``, ``p`` (payload); spans: keys, ``lo``, ``hi``, ``base``, ``width``, ``v``.
    The axis of a key is cut into slices of ``width`` from ``base`` on. A span is repeated in each slice it reaches, and
    one sort per (key, slice) carries the last span forward to the points behind it: linear work, no pairs.
    """
    base, width = F.col("base"), F.col("width")

    def slice_of(pos: Column) -> Column:
        return int_div(pos - base, width)

    marks = spans.withColumn(
        "slice", F.explode(F.sequence(slice_of(F.col("lo")), slice_of(F.col("hi") - 1)))
    ).select(
        *keys,
        "slice",
        F.greatest("lo", base + F.col("slice") * width).alias("pos"),
        F.lit(0).alias("kind"),
        F.struct("lo", "v").alias("span"),
    )
    rows = points.select(*keys, slice_of(F.col("pos")).alias("slice"), "pos", F.lit(1).alias("kind"), "p")
    upto = (
        Window.partitionBy(*keys, "slice").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marks.unionByName(rows, allowMissingColumns=True)
        .withColumn("span", F.last("span", ignorenulls=True).over(upto))
        .filter("kind = 1")
        .select(*keys, "p", (F.col("pos") - F.col("span.lo")).alias("into"), "pos", F.col("span.v").alias("v"))
    )


HOT_ROWS = 1000
HOT_KEYS = 10_000
"""A key with more rows than ``HOT_ROWS``, and more than one in ``HOT_KEYS`` of all, is dealt over several tasks. At most
``HOT_KEYS`` keys can have so many rows, which bounds the list that is broadcast."""


def hot_keys(counts: DataFrame, keys: Sequence[str], total: int, rows: str = "n_rows") -> DataFrame:
    """``keys`` and number of ``parts`` of the keys with very many rows; ``total`` is the number of rows, or more."""
    most = F.lit(max(HOT_ROWS, total // HOT_KEYS))
    hot = counts.filter(F.col(rows) > most).select(*keys, ceil_div(F.col(rows), most).cast("int").alias("parts"))
    return F.broadcast(hot)


def join_in_parts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame, spread: Column, how: str = "inner"
) -> DataFrame:
    """``left`` joined with ``right`` on ``keys``. Rows of a hot key are dealt over parts by ``spread``; right has a copy of
    that key's rows for every part. ``hot`` may know only some of the keys."""
    parts, known = F.coalesce("parts", F.lit(1)), [c for c in hot.columns if c != "parts"]
    dealt = left.join(hot, known, "left").withColumn("_deal", F.pmod(F.xxhash64(spread), parts).cast("int")).drop("parts")
    copied = right.join(hot, known, "left").withColumn("_deal", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copied, [*keys, "_deal"], how).drop("_deal")
