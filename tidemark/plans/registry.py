"""Where queries and their SQL are registered, and what they share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cdc
from ..table import Table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_totalprice, o_orderstatus, _op, _seq): every key occurs twice, often with different operations."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id") % 7
    op = F.when(n == 0, cdc.DELETE).when(n <= 3, cdc.UPDATE).otherwise(cdc.INSERT)
    return e.select((F.floor(F.col("event_id") / 2) * 4).alias("o_orderkey"), F.col("value").alias("o_totalprice"), F.upper(F.left("event_type", F.lit(1))).alias("o_orderstatus"), op.alias("_op"), F.col("event_id").alias("_seq"))


CHG = "chg AS (SELECT (event_id // 2) * 4 AS o_orderkey, value AS o_totalprice, upper(left(event_type, 1)) AS o_orderstatus, CASE WHEN event_id % 7 = 0 THEN 'DELETE' WHEN event_id % 7 <= 3 THEN 'UPDATE' ELSE 'INSERT' END AS _op, event_id AS _seq FROM events)"
SRC = CHG + ", src AS (SELECT * FROM chg QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY _seq DESC) = 1), tgt AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders)"
MERGED = "SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN s._op IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, CASE WHEN s._op IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey WHERE s._op IS NULL OR s._op <> 'DELETE'"


@cache
def _own_root() -> str:
    """A folder of this process, which goes when it ends."""
    root = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch(spark: SparkSession) -> str:
    """A fresh folder in the shared place; only a local session has one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _own_root()
    return f"{root.rstrip('/')}/tidemark-tables/{uuid.uuid4().hex}"


def scratch_table(spark: SparkSession, **options) -> Table:
    return Table(spark, scratch(spark), **options)


def report(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few facts that a run has come to know on the driver, such as versions and errors."""
    return spark.createDataFrame(list(rows), schema)
