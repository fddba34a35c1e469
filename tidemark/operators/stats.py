"""File statistics: rows, and least, greatest and null count of each leaf column."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.logical import iso_from_micros, micros_of

#: Leaf columns that have statistics, and characters of a text bound.
MAX_COLUMNS = 32
MAX_CHARS = 32
_TOP = "\U0010ffff"


def leaves(schema: T.StructType, most: int = MAX_COLUMNS) -> list[tuple[tuple[str, ...], T.DataType]]:
    """Paths and types of the first leaf columns, depth first; arrays and maps have none."""

    def walk(struct: T.StructType, path: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
        for field in struct.fields:
            if isinstance(field.dataType, T.StructType):
                yield from walk(field.dataType, (*path, field.name))
            elif not isinstance(field.dataType, (T.ArrayType, T.MapType)):
                yield (*path, field.name), field.dataType

    return list(walk(schema, ()))[:most]


def leaf(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def text_min(value: Column) -> Column:
    """A lower bound of at most MAX_CHARS characters: the prefix."""
    return F.left(value, F.lit(MAX_CHARS))


def text_max(value: Column) -> Column:
    """An upper bound of at most MAX_CHARS characters: the prefix with its last character raised by one.

    Greatest characters at the prefix's end are dropped first; a prefix of nothing else has no bound. The code
    points of surrogates are stepped over.
    """
    prefix = F.rtrim(F.left(value, F.lit(MAX_CHARS)), F.lit(_TOP))
    code = F.conv(F.hex(F.encode(F.right(prefix, F.lit(1)), "UTF-32")), 16, 10).cast("long") + 1
    code = F.when(code == 0xD800, 0xE000).otherwise(code)
    last = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    raised = F.concat(F.left(prefix, F.length(prefix) - 1), last)
    return F.when(F.length(value) <= MAX_CHARS, value).when(prefix != "", raised)


def _bound(value: Column, kind: T.DataType, greatest: bool) -> Column:
    """A bound as statistics spell it."""
    if isinstance(kind, T.StringType):
        return text_max(value) if greatest else text_min(value)
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.DateType):
        return value.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return iso_from_micros(micros_of(value, kind))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)  # JSON has no NaN, and a bound that is one says nothing
    return value


def _tree(entries: list[tuple[tuple[str, ...], Column]]) -> Column:
    """A struct that nests the entries by their paths."""
    heads: dict[str, list[tuple[tuple[str, ...], Column]]] = {}
    for path, column in entries:
        heads.setdefault(path[0], []).append((path[1:], column))
    return F.struct(*[(own[0][1] if not own[0][0] else _tree(own)).alias(name) for name, own in heads.items()])


def file_stats(df: DataFrame, by: list[Column]) -> DataFrame:
    """``by`` columns, num_records and ``stats``: the JSON of each group's statistics, in one aggregation."""
    own = leaves(df.schema)
    aggregates = [F.count(F.lit(1)).alias("num_records")]
    for i, (path, kind) in enumerate(own):
        column = leaf(path)
        aggregates.append(F.count_if(column.isNull()).alias(f"n{i}"))
        if not isinstance(kind, T.BinaryType):
            has_nan = isinstance(kind, (T.FloatType, T.DoubleType))
            low = F.min(column)
            # NaN counts as greatest: with it no bound holds.
            aggregates += [(F.when(~F.isnan(F.max(column)), low) if has_nan else low).alias(f"a{i}"), F.max(column).alias(f"b{i}")]
    grouped = df.groupBy(*by).agg(*aggregates)
    bounded = [(i, path, kind) for i, (path, kind) in enumerate(own) if not isinstance(kind, T.BinaryType)]
    parts = [F.col("num_records").alias("numRecords")]
    if bounded:
        parts += [_tree([(path, _bound(F.col(f"{side}{i}"), kind, side == "b")) for i, path, kind in bounded]).alias(name) for side, name in (("a", "minValues"), ("b", "maxValues"))]
    if own:
        parts.append(_tree([(path, F.col(f"n{i}")) for i, (path, _) in enumerate(own)]).alias("nullCount"))
    names = [c for c in grouped.columns if c not in {"num_records"} and not any(c == f"{x}{i}" for x in "nab" for i in range(len(own)))]
    return grouped.select(*names, "num_records", F.to_json(F.struct(*parts)).alias("stats"))
