"""Values of logical types, as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MS = 86_400_000
DAY_US = 86_400_000_000


def date_from_millis(value: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(value / DAY_MS).cast("int"))


def date_from_days(value: Column) -> Column:
    return F.date_from_unix_date(value.cast("int"))


def timestamp_from_millis(value: Column) -> Column:
    return F.timestamp_millis(value.cast("long"))


def timestamp_from_micros(value: Column) -> Column:
    return F.timestamp_micros(value.cast("long"))


def micros_from_nanos(value: Column) -> Column:
    """Whole division that truncates toward zero."""
    return F.when(value < 0, -F.floor(-value.cast("decimal(20,0)") / 1000).cast("long")).otherwise(F.floor(value.cast("decimal(20,0)") / 1000).cast("long"))


def timestamp_from_nanos(value: Column) -> Column:
    return F.timestamp_micros(micros_from_nanos(value))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that it names often but that is computed once."""
    return F.transform(F.array(value), f)[0]


def _filled(value: Column, digits: int) -> Column:
    """Hexadecimal digits of two's-complement bytes, filled by their sign to ``digits``."""
    given = F.hex(value)
    return F.when(F.substring(given, 1, 1) >= "8", F.lpad(given, digits, "F")).otherwise(F.lpad(given, digits, "0"))


def _whole(value: Column) -> Column:
    """The whole number, as DECIMAL(38, 0), of big-endian two's-complement bytes; null beyond 38 digits.

    Longer values must be filled by their sign, else they are beyond. Sixteen bytes are read as a signed and an unsigned
    half; decimals of 38 digits hold all of their sum.
    """
    long = F.length(value) > 16
    head = F.hex(F.substring(value, F.lit(1), F.greatest(F.length(value) - 16, F.lit(0))))
    text = _filled(F.when(long, F.substring(value, F.length(value) - 15, F.lit(16))).otherwise(value), 32)
    negative = F.substring(text, 1, 1) >= "8"
    spare = ~long | (F.rtrim(head, F.when(negative, "F").otherwise("0")) == "") & ((F.substring(F.hex(value), 1, 1) >= "8") == negative)
    high = F.conv(F.substring(text, 1, 16), 16, -10).cast("decimal(19,0)")
    low = F.conv(F.substring(text, 17, 16), 16, 10).cast("decimal(20,0)")
    total = F.try_add(F.try_multiply(high, F.lit(Decimal(1 << 64)).cast("decimal(20,0)")).cast("decimal(38,0)"), low.cast("decimal(38,0)")).try_cast("decimal(38,0)")
    return F.when(F.length(value) == 0, F.lit(0).cast("decimal(38,0)")).when(spare, total)


def _shifted(whole: Column, scale: Column) -> Column:
    """Plain text of whole / 10**scale, for scales of any sign."""
    digits = F.abs(whole).cast("string")
    filled = F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
    cut = F.length(filled) - scale
    fraction = F.concat(F.substring(filled, F.lit(1), cut), F.lit("."), F.substring(filled, cut + 1, scale))
    plain = F.when(scale > 0, fraction).when((scale < 0) & (whole != 0), F.concat(digits, F.repeat(F.lit("0"), -scale))).otherwise(digits)
    return F.when(whole < 0, F.concat(F.lit("-"), plain)).otherwise(plain)


def decimal_from_bytes(value: Column, precision: int = 38, scale: int = 0) -> Column:
    """Decimal of big-endian two's-complement bytes, read as hexadecimal numbers; null beyond the precision."""
    return _once(_whole(value), lambda whole: _shifted(whole, F.lit(scale)).try_cast(T.DecimalType(precision, scale)))


def text_from_variable_decimal(value: Column) -> Column:
    """Plain text of a struct of scale and unscaled bytes; null beyond 38 digits."""
    return _once(_whole(value["value"]), lambda whole: _shifted(whole, value["scale"].cast("int")))


#: Logical type name -> conversion of its raw value.
CONVERSIONS = {
    "org.apache.kafka.connect.data.Date": date_from_millis,
    "org.apache.kafka.connect.data.Timestamp": timestamp_from_millis,
    "org.apache.kafka.connect.data.Time": lambda c: c.cast("long"),
    "io.debezium.time.Date": date_from_days,
    "io.debezium.time.Timestamp": timestamp_from_millis,
    "io.debezium.time.MicroTimestamp": timestamp_from_micros,
    "io.debezium.time.NanoTimestamp": timestamp_from_nanos,
    "io.debezium.time.ZonedTimestamp": lambda c: c.cast("string"),
    "io.debezium.time.Time": lambda c: c.cast("long"),
    "io.debezium.time.MicroTime": lambda c: c.cast("long"),
    "io.debezium.time.NanoTime": lambda c: c.cast("long"),
    "io.debezium.data.VariableScaleDecimal": text_from_variable_decimal,
}


def convert(name: str | None, value: Column, precision: int = 38, scale: int = 0) -> Column:
    """A logical value by the type's name; unknown names leave the value as it is; nulls stay null."""
    if name == "org.apache.kafka.connect.data.Decimal":
        return decimal_from_bytes(value, precision, scale)
    return CONVERSIONS[name](value) if name in CONVERSIONS else value


def convert_block(block: dict, value: Column) -> Column:
    """A value of a record by its JSON schema block: logical types, and structs, arrays and maps in depth.

    Small whole numbers widen to int; map keys become text.
    """
    name = block.get("name")
    if name in CONVERSIONS or name == "org.apache.kafka.connect.data.Decimal":
        given = block.get("parameters") or {}
        return convert(name, value, int(given.get("connect.decimal.precision", 38)), int(given.get("scale", 0)))
    kind = block["type"]
    if kind == "struct":
        return F.when(value.isNotNull(), F.struct(*[convert_block(f, value[f["field"]]).alias(f["field"]) for f in block["fields"]]))
    if kind == "array":
        return F.transform(value, lambda x: convert_block(block["items"], x))
    if kind == "map":
        texts = F.transform_keys(value, lambda k, _: k.cast("string"))
        return F.transform_values(texts, lambda _, v: convert_block(block["values"], v))
    return value.cast("int") if kind in ("int8", "int16", "int32") else value


def micros_of(value: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a timestamp; one without a zone counts as UTC, whatever the session's zone."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    second = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
    minutes = F.hour(value).cast("long") * 60 + F.minute(value)
    return F.unix_date(value.cast("date")).cast("long") * DAY_US + minutes * 60_000_000 + second


def iso_from_micros(value: Column) -> Column:
    """UTC text of microseconds since 1970, whatever the session's zone; null stays null."""
    rest = F.pmod(value, F.lit(DAY_US))
    day = F.date_from_unix_date(F.round((value - rest) / DAY_US).cast("int")).cast("string")
    part = lambda unit, most: F.floor(rest / unit) % most
    time = F.format_string("T%02d:%02d:%02d.%06dZ", part(3_600_000_000, 24), part(60_000_000, 60), part(1_000_000, 60), rest % 1_000_000)
    return F.concat(day, time)  # null with the day; format_string alone would write the word


def micros_from_iso(text: Column) -> Column:
    """Microseconds of an ISO timestamp with its zone; null where it cannot be read."""
    return F.unix_micros(text.try_cast("timestamp"))


def days_from_iso(text: Column) -> Column:
    """Days since 1970 of an ISO date; null where it cannot be read."""
    return F.unix_date(text.try_cast("date"))


def iso_from_days(value: Column) -> Column:
    return F.date_from_unix_date(value.cast("int")).cast("string")


def nested(document: Column, path: str) -> Column:
    """Text at a dotted path of a JSON document; null if a part is missing."""
    return F.get_json_object(document, "$." + path)
