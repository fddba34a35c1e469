"""Merge keys: columns by name, or fields of structs by a dotted path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingKey(ValueError):
    """A merge key that is not a column."""


def key_path(columns: Sequence[str], key: str) -> tuple[str, ...]:
    """A column that has the whole name comes before a field of a struct."""
    return (key,) if key in columns else tuple(key.split("."))


def key_column(columns: Sequence[str], key: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in key_path(columns, key)))


def key_type(schema: T.StructType, key: str) -> T.DataType:
    kind: T.DataType = schema
    for part in key_path(schema.names, key):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            raise MissingKey(f"Merge key column '{key}' not found in schema")
        kind = kind[part].dataType
    return kind


def check_keys(schema: T.StructType, keys: Sequence[str]) -> None:
    if not keys:
        raise MissingKey("at least one merge key is needed")
    for key in keys:
        key_type(schema, key)
