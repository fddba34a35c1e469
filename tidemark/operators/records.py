"""Change records and plain records to rows with an operation.

A converter takes a table of records (value, and where known topic, partition, offset, headers) to ``Converted``:
rows with ``_op`` and ``_seq``, and the rejected records with the reason. Records without a value are skipped.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cdc import DELETE, INSERT, UPDATE, flat_operation, operation, payload
from ..functions.logical import convert_block
from ..schema import from_record_schema, nullable, payload_schema, raw_schema

META = ("topic", "partition", "offset")
CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Converted:
    """Rows and rejects, and the table of judged records that both are read from: persist it to convert once."""

    rows: DataFrame
    rejects: DataFrame
    judged: DataFrame


class RecordConverter(Protocol):
    """What a converter of records is."""

    def convert(self, records: DataFrame) -> Converted: ...

    def row_schema(self) -> T.StructType: ...


def arrival(records: DataFrame) -> Column:
    """The order of records: by offset, then topic and partition, so that equal offsets of two partitions have an order
    that reruns keep. A column _seq goes before."""
    own = set(records.columns)
    if "_seq" in own:
        return F.col("_seq")
    return F.struct(*[F.col(c) if c in own else F.lit(None).cast("string" if c == "topic" else "long").alias(c) for c in ("offset", "topic", "partition")])


def _meta(records: DataFrame) -> list[Column]:
    own = set(records.columns)
    return [F.col(c) if c in own else F.lit(None).cast("string" if c == "topic" else "long").alias(c) for c in META]


def parse(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """``records`` with ``value`` read from JSON where it is text; text that is no JSON object sets CORRUPT."""
    if not isinstance(records.schema[value].dataType, (T.StringType, T.BinaryType)):
        return records if CORRUPT in records.columns else records.withColumn(CORRUPT, F.lit(None).cast("string"))
    text = F.col(value).cast("string")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    wide = T.StructType([T.StructField(f.name, f.dataType, True) for f in wide.fields])
    parsed = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    read = records.withColumn("__parsed", parsed)
    bad = F.when(text.isNotNull() & F.coalesce(F.col("__parsed")[CORRUPT].isNotNull(), F.lit(True)), text)
    own = F.when(text.isNotNull(), F.struct(*[F.col("__parsed")[f.name].alias(f.name) for f in schema.fields]))
    return read.withColumn(CORRUPT, bad).withColumn(value, own).drop("__parsed")


def _split(table: DataFrame, error: Column, keep: Column, row: Column, schema: T.StructType) -> Converted:
    """``row`` and the verdict of each record are settled in one projection; rows and rejects only choose from it."""
    judged = table.select(*META, CORRUPT, "_op", "_seq", row.alias("__row"), error.alias("__error"), F.coalesce(keep, F.lit(False)).alias("__keep"))
    good = judged.where(F.col("__error").isNull() & F.col("__keep"))
    rows = good.select(*[F.col("__row")[f.name].cast(f.dataType).alias(f.name) for f in schema.fields], F.col("_op"), F.col("_seq"), *META)
    rejects = judged.where(F.col("__error").isNotNull()).select(*META, F.col("__error").alias("error"), F.col(CORRUPT).alias("value"))
    return Converted(rows, rejects, judged)


@dataclass(frozen=True)
class EnvelopeConverter:
    """Full envelopes {before, after, op}. A deletion takes the row before, others the row after; without it the record
    is rejected by its offset; unknown operations are skipped; deletions may be switched off."""

    payload_schema: T.StructType
    delete_enabled: bool = True

    def row_schema(self) -> T.StructType:
        return self.payload_schema

    def value_schema(self) -> T.StructType:
        return T.StructType([T.StructField("before", self.payload_schema), T.StructField("after", self.payload_schema), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])

    def convert(self, records: DataFrame) -> Converted:
        seq = arrival(records)
        read = parse(records, self.value_schema())
        table = read.select(*_meta(read), "value", CORRUPT, seq.alias("_seq"), operation(F.col("value.op")).alias("_op"))
        row = payload(F.col("_op"), F.col("value.before"), F.col("value.after"))
        table = table.withColumn("__row", row)
        wanted = F.col("_op").isNotNull() & ((F.col("_op") != DELETE) | F.lit(self.delete_enabled))
        missing = wanted & F.col("__row").isNull()
        side = F.when(F.col("_op") == DELETE, "before").otherwise("after")
        error = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable value")).when(missing, F.concat(F.lit("missing '"), side, F.lit("' at offset "), F.coalesce(F.col("offset").cast("string"), F.lit("?"))))
        return _split(table, error, F.col("value").isNotNull() & wanted, F.col("__row"), self.payload_schema)


@dataclass(frozen=True)
class FlattenedConverter:
    """Flat rows. The operation is the header's, then a true __deleted, then __op's, else an insert; columns that begin
    with __ are dropped."""

    value_schema: T.StructType
    delete_enabled: bool = True
    header: str | None = "header_op"

    def row_schema(self) -> T.StructType:
        return T.StructType([f for f in self.value_schema.fields if not f.name.startswith("__")])

    def convert(self, records: DataFrame) -> Converted:
        seq = arrival(records)
        read = parse(records, self.value_schema)
        names = set(self.value_schema.names)
        nothing = F.lit(None).cast("string")
        header = F.col(self.header) if self.header and self.header in records.columns else nothing
        op = flat_operation(header, F.col("value.__deleted") if "__deleted" in names else nothing, F.col("value.__op") if "__op" in names else nothing)
        table = read.select(*_meta(read), "value", CORRUPT, seq.alias("_seq"), op.alias("_op"))
        error = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable value"))
        wanted = F.col("value").isNotNull() & ((F.col("_op") != DELETE) | F.lit(self.delete_enabled))
        return _split(table, error, wanted, F.col("value"), self.row_schema())


@dataclass(frozen=True)
class PlainConverter:
    """Plain records: every value is an insert."""

    schema: T.StructType

    def row_schema(self) -> T.StructType:
        return self.schema

    def convert(self, records: DataFrame) -> Converted:
        seq = arrival(records)
        read = parse(records, self.schema)
        table = read.select(*_meta(read), "value", CORRUPT, seq.alias("_seq"), F.lit(INSERT).alias("_op"))
        error = F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable value"))
        return _split(table, error, F.col("value").isNotNull(), F.col("value"), self.schema)


@dataclass(frozen=True)
class BlockConverter:
    """A converter by a record's JSON schema block: raw values are parsed by it and converted to their logical types.

    ``mode`` and ``envelope`` are the settings write.mode and cdc.envelope.format.
    """

    block: dict
    mode: str = "cdc"
    envelope: str = "debezium_full"
    delete_enabled: bool = True

    def row_schema(self) -> T.StructType:
        whole = from_record_schema(self.block)
        return payload_schema(whole, self.envelope) if self.mode == "cdc" else T.StructType(whole.fields)

    def convert(self, records: DataFrame) -> Converted:
        raw = raw_schema(self.block)
        typed = parse(records, raw)
        whole = from_record_schema(self.block)
        values = F.when(F.col("value").isNotNull(), convert_block(self.block, F.col("value"))).cast(nullable(whole))
        typed = typed.withColumn("value", values)
        return converter(whole, self.mode, self.envelope, self.delete_enabled).convert(typed)


def converter(value: T.StructType | dict, mode: str = "cdc", envelope: str = "debezium_full", delete_enabled: bool = True) -> RecordConverter:
    """The converter that the settings ask for. ``value`` is the schema of the records' values, whole: a Spark type or a
    record's JSON schema block."""
    if isinstance(value, dict):
        return BlockConverter(value, mode, envelope, delete_enabled)
    if mode != "cdc":
        return PlainConverter(value)
    if envelope == "debezium_full":
        return EnvelopeConverter(payload_schema(value, envelope), delete_enabled)
    return FlattenedConverter(value, delete_enabled)


__all__ = ["BlockConverter", "arrival", "converter", "DELETE", "INSERT", "UPDATE", "Converted", "EnvelopeConverter", "FlattenedConverter", "PlainConverter", "RecordConverter", "parse"]
