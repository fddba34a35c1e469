"""Keyed MERGE as DataFrame plans.

A matched row is replaced whole by an insert or update and dropped by a deletion; an unmatched source row is inserted
unless it is a deletion. Null keys match each other. All joins are equi-joins on null-safe keys, so they are
broadcast or sorted by size, and no plan collects rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cdc import DELETE, INSERT, UPDATE
from .keys import MissingKey, check_keys, key_column

OP = "_op"


def _q(name: str) -> str:
    return f"`{name}`"


def _marked(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row struct ``s`` per source row, beside its keys under names of their own."""
    return source.select(*[key_column(source.columns, k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*[F.col(_q(c)) for c in source.columns]).alias("__s"))


def _same(left: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(left)])


def same_keys(columns: Sequence[str], keys: Sequence[str]) -> Column:
    return _same([key_column(columns, k) for k in keys])


def matches(target: DataFrame, source: DataFrame, keys: Sequence[str], file: str) -> DataFrame:
    """(file, _op, __m0, ...) of each target row with a source key: all that a MERGE asks of files it may not touch."""
    ops = source.select(*[key_column(source.columns, k).alias(f"__k{i}") for i, k in enumerate(keys)], OP)
    own = target.select(file, *[key_column(target.columns, k).alias(f"__m{i}") for i, k in enumerate(keys)])
    return own.join(ops, _same([F.col(f"__m{i}") for i in range(len(keys))])).select(file, OP, *[f"__m{i}" for i in range(len(keys))])


def unmatched(source: DataFrame, found: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Source rows, but deletions, whose key is not among those of ``matches``."""
    known = found.select(*[F.col(f"__m{i}").alias(f"__k{i}") for i in range(len(keys))])
    fresh = source.where(F.col(OP) != DELETE).join(known, same_keys(source.columns, keys), "left_anti")
    return fresh.select(*[F.col(_q(c)) if c in source.columns else F.lit(None).alias(c) for c in columns])


def touched(target: DataFrame, source: DataFrame, keys: Sequence[str], file: str) -> DataFrame:
    """The distinct files (column ``file``) that hold a row with a source key."""
    return target.join(_marked(source, keys), same_keys(target.columns, keys), "left_semi").select(file).distinct()


def rewrite(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows after the matches: replaced, dropped or as they were. ``source`` has one row a key."""
    joined = target.join(_marked(source, keys), same_keys(target.columns, keys), "left")
    op = F.col("__s")[OP]
    kept = joined.where(op.isNull() | (op != DELETE))
    return kept.select(*[F.when(op.isNotNull(), F.col("__s")[c] if c in source.columns else F.lit(None)).otherwise(F.col(_q(c))).alias(c) for c in target.columns])


def inserts(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Source rows, but deletions, whose key the target lacks."""
    known = target.select(*[key_column(target.columns, k).alias(f"__m{i}") for i, k in enumerate(keys)])
    return unmatched(source, known, keys, columns or target.columns)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the target after the merge."""
    check_keys(target.schema, keys)
    return rewrite(target, source, keys).unionByName(inserts(target, source, keys))


def counters(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: inserted, updated, deleted, copied and unmatched deletions, in one pass over both sides."""
    left = target.select(*[key_column(target.columns, k).alias(f"__m{i}") for i, k in enumerate(keys)], F.lit(1).alias("__t"))
    joined = left.join(_marked(source, keys), _same([F.col(f"__m{i}") for i in range(len(keys))]), "full_outer")
    op, there = F.col("__s")[OP], F.col("__t").isNotNull()
    count = lambda condition: F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")
    return joined.agg(
        count(~there & op.isin(INSERT, UPDATE)).alias("inserted"), count(there & op.isin(INSERT, UPDATE)).alias("updated"),
        count(there & (op == DELETE)).alias("deleted"), count(there & op.isNull()).alias("copied"), count(~there & (op == DELETE)).alias("unmatched_deletes"),
    )


def key_bounds(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: min_<key>, max_<key> and nulls_<key> of each key."""
    own = {k: key_column(source.columns, k) for k in keys}
    return source.agg(*[f for k in keys for f in (F.min(own[k]).alias(f"min_{k}"), F.max(own[k]).alias(f"max_{k}"), F.count_if(own[k].isNull()).alias(f"nulls_{k}"))])


__all__ = ["OP", "MissingKey", "check_keys", "counters", "inserts", "key_bounds", "matches", "merge", "rewrite", "same_keys", "touched", "unmatched"]
