"""File skipping by statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.logical import days_from_iso, micros_from_iso, micros_of
from .keys import key_column, key_path, key_type
from .stats import MAX_CHARS

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Bounds:
    """Least and greatest source value of a key, in the form of ``comparable``, and whether the source has a null there."""

    low: object
    high: object
    has_null: bool = False


def disjoint(low: Column, high: Column, bounds_low: Column, bounds_high: Column) -> Column:
    """Whether two ranges share no value; touching ranges do. Unknown if a bound is."""
    return (high < bounds_low) | (low > bounds_high)


def comparable(value: Column, kind: T.DataType) -> Column:
    """A key's value in a form that leaves Spark and comes back unchanged: days, microseconds, text of a decimal."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, _TIMES):
        return micros_of(value, kind)
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    return value


def _written(text: Column, kind: T.DataType) -> Column:
    """A bound from its text in the statistics, as ``_given`` has the source's; null where it cannot be read."""
    if isinstance(kind, _WHOLE):
        return text.try_cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.BooleanType, T.DecimalType)):
        return text.try_cast(kind)
    if isinstance(kind, T.DateType):
        return days_from_iso(text)
    if isinstance(kind, _TIMES):
        return micros_from_iso(text)
    if isinstance(kind, T.StringType):
        return text
    return F.lit(None).cast("string")


def _given(value: object, kind: T.DataType) -> Column:
    """A source's bound: a float is one again, as its statistics are."""
    return F.lit(value).cast(kind) if isinstance(kind, (T.FloatType, T.DecimalType)) else F.lit(value)


def bounds_of(source: DataFrame, keys: Sequence[str]) -> tuple[int, dict[str, Bounds]]:
    """(rows, bounds of each key) of the source, in one aggregation."""
    kinds = [key_type(source.schema, k) for k in keys]
    columns = [key_column(source.columns, k) for k in keys]
    found = source.agg(F.count(F.lit(1)), *[comparable(f(c), t) for c, t in zip(columns, kinds, strict=True) for f in (F.min, F.max)], *[F.count_if(c.isNull()) for c in columns]).first()
    n = len(keys)
    return found[0], {k: Bounds(found[1 + 2 * i], found[2 + 2 * i], found[1 + 2 * n + i] > 0) for i, k in enumerate(keys)}


def may_match(stats: Column, bounds: Mapping[str, Bounds], schema: T.StructType) -> Column:
    """Whether a file with these statistics (JSON) may hold a source key.

    A file is skipped if the range of any key is apart from the source's, unless both have nulls in that key; what is
    not known keeps a file. A float's NaN has no bounds in the statistics and so keeps a file.
    """
    keep = F.lit(True)
    for key, own in bounds.items():
        kind = key_type(schema, key)
        path = "".join(f"['{p}']" for p in key_path(schema.names, key))
        at = lambda part, p=path: F.get_json_object(stats, f"$.{part}{p}")
        if own.low is None or own.high is None:
            # Only nulls in the source: files without a null cannot match.
            apart = (at("nullCount").try_cast("long") == 0) if own.has_null else F.lit(False)
        else:
            apart = disjoint(_written(at("minValues"), kind), _written(at("maxValues"), kind), _given(own.low, kind), _given(own.high, kind))
            if own.has_null:
                apart = apart & (at("nullCount").try_cast("long") == 0)
        keep = keep & ~F.coalesce(apart, F.lit(False))
    return keep


def prune(files: DataFrame, bounds: Mapping[str, Bounds], schema: T.StructType, stats: str = "stats") -> DataFrame:
    """The files of ``files`` that may match."""
    return files.where(may_match(F.col(stats), bounds, schema))


__all__ = ["MAX_CHARS", "Bounds", "bounds_of", "comparable", "disjoint", "may_match", "prune"]
