"""One query for each operator, applied to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    collocations,
    decontamination,
    exact_dedup,
    language,
    mixing,
    near_dedup,
    periodic,
    quality,
    sharding,
    substring_dedup,
    toxicity,
    url_filter,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op4_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), url_filter.build(url_filter.given_rules(spark)))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op10_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op11_extendible_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(table(spark, sf_dir, "documents"))


ALL = {f.__name__: f for f in (
    op1_quality_rules, op2_minhash_near_dedup, op3_source_mixing, op4_warc_zstd, op5_toxicity_fm,
    op6_substring_fm, op7_decontamination, op8_url_filter, op9_language_id, op10_label_sharding,
    op11_extendible_dedup, op12_collocations, op13_periodic_runs,
)}
