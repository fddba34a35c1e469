"""Scans of Parquet files and of a table's log."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """All rows; with a schema only its columns, in its types, null where a file lacks one."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        if schema is None:
            raise ValueError("no files and no schema")
        return spark.createDataFrame([], schema)
    if schema is None:
        return spark.read.parquet(*paths)
    open_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.read.schema(open_schema).parquet(*paths)


def rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> Iterator[Row]:
    """Rows one by one, a partition at a time; closing the iterator stops the scan."""
    yield from scan(spark, path, schema).toLocalIterator()


def commit_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(version, line, action) of commit files, for logs too long to replay on the driver."""
    files = spark.read.text(list(paths), wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"(\d{20})", 1).cast("long").alias("version"), "value")
    lines = files.select("version", F.posexplode(F.split("value", "\n")).alias("line", "action"))
    return lines.where(F.trim("action") != "")
