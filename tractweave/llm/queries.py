"""One query per operator over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tractweave.llm import (
    decontaminate,
    filter_audit,
    licenses,
    line_dedup,
    minhash,
    mixing,
    ngram_join,
    quality_bayes,
    quality_rules,
    sharding,
    substring_dedup,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bayes.quality_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_table(table(spark, sf_dir, "documents"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules_table(table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_table(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_components(table(spark, sf_dir, "documents"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_table(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_table(table(spark, sf_dir, "embeddings"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_toxicity,
        op3_sharding,
        op4_quality,
        op5_mixing,
        op6_licenses,
        op7_rules,
        op8_substrings,
        op9_ngram_join,
        op10_lines,
        op11_filter_audit,
        op12_whitening,
        op13_minhash,
    )
}

ORACLES: dict[str, str] = {
    "op1_decontamination": decontaminate.DECONTAMINATION_SQL,
    "op6_licenses": licenses.license_sql(),
    "op7_rules": quality_rules.RULES_SQL,
    "op10_lines": line_dedup.LINE_SQL,
    "op11_filter_audit": filter_audit.AUDIT_SQL,
}
