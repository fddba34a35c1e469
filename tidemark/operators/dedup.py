"""Last writer wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import key_column


def _ordered(kind: T.DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    return _ordered(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def last_writer(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest ``order``, deletions included; null keys are equal.

    Of rows with an equal ``order`` the greatest by all other columns counts, so reruns agree. The greatest row combines
    before the shuffle: a key with very many changes sends one row a task.
    """
    quoted = {c: F.col(f"`{c}`") for c in df.columns}
    rest = [c for c in df.columns if c not in order]
    # Values without an order, such as maps, take part as JSON, and then stand beside the order.
    loose = [c for c in rest if not _ordered(df.schema[c].dataType)]
    place = F.struct(*[quoted[c] for c in order], *[quoted[c] for c in rest if c not in loose], *[F.to_json(F.struct(quoted[c])).alias(c) for c in loose])
    groups = [key_column(df.columns, k).alias(f"__k{i}") for i, k in enumerate(keys)]
    if loose:
        return df.groupBy(*groups).agg(F.max_by(F.struct(*quoted.values()), place).alias("row")).select("row.*")
    return df.groupBy(*groups).agg(F.max(place).alias("row")).select(*[F.col("row")[c].alias(c) for c in df.columns])


def greatest_offsets(df: DataFrame, topic: str = "topic", partition: str = "partition", offset: str = "offset") -> DataFrame:
    """(topic, partition, offset): the greatest offset of each partition."""
    return df.groupBy(F.col(topic).alias("topic"), F.col(partition).alias("partition")).agg(F.max(offset).alias("offset"))


def after_offsets(df: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows of ``df`` beyond the committed offset of their topic and partition; untracked partitions pass whole.

    ``committed`` has one row per partition.
    """
    known = committed.select(F.col("topic").alias("__t"), F.col("partition").alias("__p"), F.col("offset").alias("__o"))
    joined = df.join(known, (F.col("topic") == F.col("__t")) & (F.col("partition") == F.col("__p")), "left")
    return joined.where(F.col("__o").isNull() | (F.col("offset") > F.col("__o"))).drop("__t", "__p", "__o")


def topic_counts(df: DataFrame, topic: str = "topic") -> DataFrame:
    return df.groupBy(topic).agg(F.count(F.lit(1)).alias("n"))
