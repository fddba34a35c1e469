"""Sharding by jump consistent hashing.

A stable key is mixed to 64 bits and walked through the jump recurrence (Lamping and Veach, 2014): no ring
table, O(log shards) steps, and going from n to n + 1 shards moves only the rows that the new shard takes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_text

#: Fixed values of the published recurrence: multiplier and the scale 2^31.
JUMP_MULTIPLIER = 2862933555777941757
JUMP_SCALE = 1 << 31
#: Slots are counted in this many buckets a shard, so that no task has to see a whole shard.
SLOT_BUCKETS = 4096


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, for all keys of a batch at once."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.uint64)
    shard = np.full(len(state), -1, dtype=np.int64)
    at = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = at[live]
        state[live] = state[live] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        at[live] = ((shard[live] + 1) * (JUMP_SCALE / draw)).astype(np.int64)
        live = live[at[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Jump hash of any column. Null keys are one key like any other and share a shard."""

    @F.pandas_udf("int")
    def walk(mixed: pd.Series) -> pd.Series:
        return pd.Series(jump(mixed.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return walk(F.xxhash64(key.cast("string")))


def assign_shards(df: DataFrame, key: str = "doc_id", shards: int = 8, name: str = "shard") -> DataFrame:
    """``df`` with its shard, without any shuffle; a column that already has the name is replaced.

    Equal keys always meet in one shard; a null key is a key; an empty table stays empty.
    """
    return df.withColumn(name, shard_of(F.col(key), shards))


def with_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """``df`` with gapless numbers from 0 in each shard, ordered by a hash bucket and then by ``order``.

    Rows are dealt to buckets by a hash of all ``order`` columns: a shard, or one key with a third of the rows,
    is spread over many tasks. Counts of shards x buckets (a bounded table) give each bucket its first slot.
    Rows that are equal in every ``order`` column are interchangeable.
    """
    bucketed = df.withColumn("__bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(SLOT_BUCKETS)))
    counts = bucketed.groupBy(F.col(shard).alias("__shard"), F.col("__bucket").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__shard").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__shard", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(shard, "__bucket").orderBy(*[F.col(c) for c in order])
    ranked = bucketed.withColumn("__rank", F.row_number().over(inside))
    joined = ranked.join(first, (F.col(shard) == F.col("__shard")) & (F.col("__bucket") == F.col("__b")))
    return joined.withColumn(slot, F.col("__first") + F.col("__rank") - 1).drop("__bucket", "__shard", "__b", "__first", "__rank")


def shard_table(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """One row per document: key, size, CRC-32 of the text, law, shard, slot, and the shard with one shard more.

    A null text has no bytes (size 1, checksum 0); repeated rows get slots of their own; null keys share a shard;
    other columns, whatever their names, are not read.
    """
    base = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        crc_text(F.col(text)).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
    )
    slotted = with_slots(base, "shard", ["doc_id", "size", "text_crc32"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
