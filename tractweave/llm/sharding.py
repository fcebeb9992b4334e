"""Contiguous shards of nearly equal bytes: prefix sums over the whole table from the totals of its partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tractweave.operators.scale import int_div, shuffle_width, stage

ROW_BYTES = 16
"""Bytes counted for a document besides its text."""


def text_bytes(text: str | Column = "text") -> Column:
    """Bytes of the text in UTF-8; NULL has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def assign_shards(docs: DataFrame, n_shards: int, order: str = "doc_id", size: str = "size") -> DataFrame:
    """Add ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (place in the shard, from 0, without gaps) to every row.

    Rows stand in the order of ``order``; a shard is one run of that order. The table is dealt by ranges of ``order``,
    every part gives its bytes and its rows, and the running sums of these few totals shift the running sums inside the
    parts. A row belongs to the shard in whose equal share of all bytes its middle byte lies, so a shard is off its share
    by one row at most.

    Rows with equal or NULL ``order`` are told apart by their place in the input, so one value that is very common is
    spread over parts. NULL comes first, a negative or NULL ``size`` counts as zero, and if all sizes are zero rows count
    alike. Columns named ``shard`` and ``slot`` are replaced; all others stay. No rows give no rows.
    """
    spark = docs.sparkSession
    weight = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    parts = stage(
        docs.drop("shard", "slot")
        .withColumn("_w", weight)
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_width(spark), F.col(order), F.col("_tie"))
        .withColumn("_part", F.spark_partition_id()),
        "shard-parts",
    )
    # one row per part: their number is a setting, not a matter of the data
    all_before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        parts.groupBy("_part")
        .agg(F.sum("_w").alias("_b"), F.count("*").alias("_n"))
        .select(
            "_part",
            F.coalesce(F.sum("_b").over(all_before), F.lit(0)).alias("_b0"),
            F.coalesce(F.sum("_n").over(all_before), F.lit(0)).alias("_n0"),
            F.sum("_b").over(every).alias("_bytes"),
            F.sum("_n").over(every).alias("_rows"),
        )
    )

    def placed(rows: DataFrame) -> DataFrame:
        inside = Window.partitionBy("_part").orderBy(F.col(order), F.col("_tie")).rowsBetween(Window.unboundedPreceding, -1)
        before, at = F.col("_b0") + F.coalesce(F.sum("_w").over(inside), F.lit(0)), F.col("_row")
        by_bytes = int_div((2 * before + F.col("_w")) * n_shards, 2 * F.col("_bytes"))
        by_rows = int_div(at * n_shards, F.col("_rows"))
        return (
            rows.join(F.broadcast(totals), "_part")
            .withColumn("_row", F.col("_n0") + F.count(F.lit(1)).over(inside))
            .withColumn("shard", F.least(F.lit(n_shards - 1), F.when(F.col("_bytes") > 0, by_bytes).otherwise(by_rows)).cast("int"))
        )

    firsts = placed(parts.select(order, "_tie", "_part", "_w")).groupBy("shard").agg(F.min("_row").alias("_first"))
    return (
        placed(parts)
        .join(F.broadcast(firsts), "shard")  # n_shards rows
        .withColumn("slot", F.col("_row") - F.col("_first"))
        .drop("_w", "_tie", "_part", "_b0", "_n0", "_bytes", "_rows", "_row", "_first")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    assigned.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_table(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Which shard and slot every document goes to, without carrying the texts through the shuffles."""
    rows = docs.select(
        "doc_id",
        (text_bytes() + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    return assign_shards(rows, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
