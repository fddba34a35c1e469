"""The corpus pipeline: documents through language ID, near-dedup, decontamination, mixing and sharding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of documents. ``run`` writes each stage's rows to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, langid, mixing, sharding, simhash
from tidemark.llm.common import cut, held, release


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text some language's model finds likely enough; those it rejects go."""
    return langid.drop_rejected(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: by SimHash, and by the similarity of five-word shingles."""
    return simhash.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard of eight."""
    return sharding.assign_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("mix_to_weights", mix_sources),
    ("jump_sharding", shard),
]

#: No SQL: the language models and the near copies are beyond it; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        mark = held()
        docs = cut(stage(spark, docs, sf_dir), name)
        release(mark, keep_last=True)  # what the stage wrote on its way
    return docs
