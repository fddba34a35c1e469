"""Table schemas: JSON codec, evolution rules, and schemas of incoming records."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class IncompatibleSchema(ValueError):
    """An incoming schema that the table's cannot evolve to."""


@dataclass(frozen=True)
class Evolution:
    """The schema after a merge, and whether it differs from the table's."""

    schema: T.StructType
    changed: bool


def to_json(schema: T.StructType) -> str:
    return schema.json()


def from_json(text: str) -> T.StructType:
    """Parse a table's schema; field metadata may be missing or null, the top level must be a struct."""

    def with_metadata(node):
        if isinstance(node, list):
            return [with_metadata(x) for x in node]
        if isinstance(node, dict):
            node = {k: with_metadata(v) for k, v in node.items()}
            if "name" in node and "type" in node:
                node["metadata"] = node.get("metadata") or {}
                node.setdefault("nullable", True)
        return node

    parsed = json.loads(text)
    if not isinstance(parsed, dict) or parsed.get("type") != "struct":
        raise ValueError("the top level of a schema must be a struct")
    return T.StructType.fromJson(with_metadata(parsed))


def nullable(kind: T.DataType) -> T.DataType:
    """A type whose fields may all be null, in depth: files promise no more, whatever an expression knows of its nulls."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    return T.MapType(kind.keyType, nullable(kind.valueType), True) if isinstance(kind, T.MapType) else kind


_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def widen(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds values of both, if the table's type may become it; None if not.

    byte < short < int < long, float < double; a decimal may grow if neither its scale nor its whole digits shrink.
    The narrower type may also come in later: the table's stays. Nested types must be equal.
    """
    if old == new:
        return old
    if type(old) in _WHOLE and type(new) in _WHOLE:
        return max(old, new, key=lambda t: _WHOLE.index(type(t)))
    if {type(old), type(new)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        for a, b in ((old, new), (new, old)):
            if b.scale >= a.scale and b.precision - b.scale >= a.precision - a.scale:
                return b
    return None


def merge(existing: T.StructType, incoming: T.StructType) -> Evolution:
    """Columns keep their order; new ones, which must be nullable, follow; missing ones stay; either side's null counts.

    Names are compared exactly; names that differ only by case are refused, as Spark could not tell them apart.
    """
    found = {f.name: f for f in incoming.fields}
    folded: dict[str, str] = {}
    for name in [f.name for f in existing.fields] + list(found):
        if folded.setdefault(name.lower(), name) != name:
            raise IncompatibleSchema(f"columns '{folded[name.lower()]}' and '{name}' differ only by case")
    fields = []
    for old in existing.fields:
        new = found.pop(old.name, None)
        if new is None:
            fields.append(old)
            continue
        kind = widen(old.dataType, new.dataType)
        if kind is None:
            raise IncompatibleSchema(f"column '{old.name}' cannot change from {old.dataType.simpleString()} to {new.dataType.simpleString()}")
        fields.append(T.StructField(old.name, kind, old.nullable or new.nullable, old.metadata))
    for new in incoming.fields:
        if new.name in found:
            if not new.nullable:
                raise IncompatibleSchema(f"new column '{new.name}' must be nullable")
            fields.append(new)
    schema = T.StructType(fields)
    return Evolution(schema, schema != existing)


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns and types of ``schema``: missing ones are null, others are dropped."""
    own = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both in the merged schema."""
    schema = merge(old.schema, new.schema).schema
    return project(old, schema).unionByName(project(new, schema))


#: Names of logical types in change records -> Spark types. Times of day stay numbers of their unit.
LOGICAL_TYPES = {
    "org.apache.kafka.connect.data.Date": T.DateType(),
    "org.apache.kafka.connect.data.Timestamp": T.TimestampType(),
    "org.apache.kafka.connect.data.Time": T.LongType(),
    "io.debezium.time.Date": T.DateType(),
    "io.debezium.time.Timestamp": T.TimestampType(),
    "io.debezium.time.MicroTimestamp": T.TimestampType(),
    "io.debezium.time.NanoTimestamp": T.TimestampType(),
    "io.debezium.time.ZonedTimestamp": T.StringType(),
    "io.debezium.time.Time": T.LongType(),
    "io.debezium.time.MicroTime": T.LongType(),
    "io.debezium.time.NanoTime": T.LongType(),
    "io.debezium.data.VariableScaleDecimal": T.StringType(),
}
DECIMAL = "org.apache.kafka.connect.data.Decimal"
_PRIMITIVES = {"int8": T.IntegerType(), "int16": T.IntegerType(), "int32": T.IntegerType(), "int64": T.LongType(), "float": T.FloatType(), "float32": T.FloatType(), "double": T.DoubleType(), "float64": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType()}


def from_record_schema(block: dict) -> T.DataType:
    """The Spark type of a JSON schema block of a record ({type, optional, name, parameters, fields, ...})."""
    name = block.get("name")
    if name == DECIMAL:
        given = block.get("parameters") or {}
        return T.DecimalType(int(given.get("connect.decimal.precision", 38)), int(given.get("scale", 0)))
    if name in LOGICAL_TYPES:
        return LOGICAL_TYPES[name]
    kind = block["type"]
    if kind == "struct":
        return T.StructType([T.StructField(f["field"], from_record_schema(f), bool(f.get("optional"))) for f in block.get("fields", ())])
    if kind == "array":
        return T.ArrayType(from_record_schema(block["items"]), bool(block["items"].get("optional")))
    if kind == "map":
        return T.MapType(T.StringType(), from_record_schema(block["values"]), bool(block["values"].get("optional")))
    if kind not in _PRIMITIVES:
        raise ValueError(f"unsupported type '{kind}'")
    return _PRIMITIVES[kind]


def raw_schema(block: dict) -> T.DataType:
    """The Spark type of a record's values as JSON spells them, before logical types are converted."""
    kind = block["type"]
    if kind == "struct":
        return T.StructType([T.StructField(f["field"], raw_schema(f)) for f in block.get("fields", ())])
    if kind == "array":
        return T.ArrayType(raw_schema(block["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), raw_schema(block["values"]))
    if kind not in _PRIMITIVES:
        raise ValueError(f"unsupported type '{kind}'")
    return _PRIMITIVES[kind]


def payload_schema(value: T.DataType, envelope: str = "debezium_full") -> T.StructType:
    """The row schema of a record: an envelope's 'after', else 'before'; a flat record without its __ columns."""
    if not isinstance(value, T.StructType):
        raise ValueError("a record must be a struct")
    if envelope != "debezium_full":
        return T.StructType([f for f in value.fields if not f.name.startswith("__")])
    for name in ("after", "before"):
        if name in value.names and isinstance(value[name].dataType, T.StructType):
            return value[name].dataType
    raise ValueError("an envelope needs 'after' or 'before'")
