"""Training-data pipeline: toxicity, near duplicates, decontamination, mixing, sharding; each stage stored and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractweave.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from tractweave.llm.queries import table
from tractweave.operators.scale import stage

N_SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at a Jaccard similarity of 0.8, the smallest id stays."""
    return ngram_join.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows are cut out; a document with nothing left goes."""
    return decontaminate.remove_passages(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay as often as their rate for the target weights says."""
    return mixing.mix_documents(docs, table(spark, sf_dir, "labels"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, shard and slot: contiguous shards of nearly equal bytes."""
    sized = docs.withColumn("size", sharding.text_bytes() + sharding.ROW_BYTES).withColumn(
        "text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")))
    )
    return (
        sharding.assign_shards(sized, N_SHARDS)
        .withColumn("law", F.lit("bytes"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

ORACLE_SQL = None
"""Trained models and iterative fits are beyond SQL; tests hold every stage against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
