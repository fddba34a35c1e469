"""The operators as queries over whole tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, licenses, linededup, lm, mixing, oracles, quality, sharding, simhash, tokens

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(_documents(spark, sf_dir))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(_documents(spark, sf_dir))


def op3_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_documents(spark, sf_dir))


def op4_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(_documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_table(_documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_table(_documents(spark, sf_dir))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_documents(spark, sf_dir))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_table(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(_documents(spark, sf_dir))


def op10_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_table(_documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    own = (op1_jump_shards, op2_line_quality, op3_log_bilinear_scores, op4_orc_tokens, op5_language_id, op6_license_scan, op7_simhash_groups, op8_decontaminate, op9_fair_mix, op10_fuzzy_line_dedup)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return oracles.oracles()
