"""Each operator as a query over the test tables, and the same in SQL.

The change feed is derived from ``events``: every key occurs twice, often with different operations, so that the last
writer matters. Queries of tables and their log, of types and schemas, and of the sink are in modules of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as schemas
from ..functions import cdc, logical, names
from ..log.snapshot import replay
from ..operators import dedup, merge, stats
from ..operators.prune import bounds_of, prune
from ..operators.records import EnvelopeConverter, FlattenedConverter, PlainConverter
from ..sources.parquet import scan
from .registry import CHG, MERGED, QUERIES, SQL, SRC, changes, query
from .registry import orders as _orders
from .registry import scratch_table as _scratch_table
from .registry import table as _table


def latest(spark, sf_dir):
    return dedup.last_writer(changes(spark, sf_dir), ["o_orderkey"], ["_seq"]).drop("_seq")


@query("SELECT * FROM region")
def q_scan_full(spark, sf_dir):
    return scan(spark, f"{sf_dir}/region.parquet")


@query("SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS n_comment_new FROM nation")
def q_scan_project(spark, sf_dir):
    own = spark.read.parquet(f"{sf_dir}/nation.parquet").schema
    wanted = T.StructType([own["n_nationkey"], own["n_name"], T.StructField("n_comment_new", T.StringType())])
    return scan(spark, f"{sf_dir}/nation.parquet", wanted)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def q_table_scan(spark, sf_dir):
    table, orders = _scratch_table(spark), _orders(spark, sf_dir)
    for part in range(3):
        table.append(orders.where(F.col("o_orderkey") % 3 == part))
    return table.read()


@query(f"WITH {SRC} {MERGED}")
def q_table_merge(spark, sf_dir):
    """The whole way: append to files, MERGE the feed into them, read the table."""
    table = _scratch_table(spark)
    table.append(_orders(spark, sf_dir).repartitionByRange(6, "o_orderkey"))
    table.merge(changes(spark, sf_dir), ["o_orderkey"])
    return table.read()


@query(f"WITH {CHG} SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM chg WHERE _op = 'INSERT'")
def q_append(spark, sf_dir):
    table = _scratch_table(spark)
    table.append(_orders(spark, sf_dir))
    table.append(changes(spark, sf_dir).where(F.col("_op") == cdc.INSERT).drop("_op", "_seq"))
    return table.read()


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_score FROM customer")
def q_project_schema(spark, sf_dir):
    wanted = T.StructType.fromDDL("c_custkey long, c_name string, c_nationkey long, c_score double")
    return schemas.project(_table(spark, sf_dir, "customer"), wanted)


PAYLOAD = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType())])


def envelopes(spark, sf_dir) -> DataFrame:
    """JSON envelopes of the events: 0 deletes, 1 is unknown, 2 is a tombstone, 3 lacks its row, 4 is broken."""
    e = _table(spark, sf_dir, "events")
    n = F.col("event_id") % 11
    row = F.struct(F.col("event_id").alias("id"), F.col("value"))
    op = F.when(n == 0, "d").when(n == 1, "x").when(n <= 5, "u").when(n <= 8, "c").otherwise("r")
    envelope = F.struct(F.when(n == 0, row).alias("before"), F.when((n != 0) & (n != 3), row).alias("after"), op.alias("op"), F.lit(1).alias("ts_ms"))
    value = F.when(n == 2, F.lit(None).cast("string")).when(n == 4, F.lit('{"op": "c", "after": ')).otherwise(F.to_json(envelope))
    return e.select(F.lit("t").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), value.alias("value"))


@query("SELECT event_id AS id, value, CASE WHEN event_id % 11 = 0 THEN 'DELETE' WHEN event_id % 11 <= 5 THEN 'UPDATE' ELSE 'INSERT' END AS _op FROM events WHERE event_id % 11 NOT IN (1, 2, 3, 4)")
def q_cdc_envelope(spark, sf_dir):
    return EnvelopeConverter(PAYLOAD).convert(envelopes(spark, sf_dir)).rows.select("id", "value", "_op")


@query("SELECT event_id AS id, value, CASE WHEN event_id % 11 <= 5 THEN 'UPDATE' ELSE 'INSERT' END AS _op FROM events WHERE event_id % 11 NOT IN (0, 1, 2, 3, 4)")
def q_cdc_no_delete(spark, sf_dir):
    return EnvelopeConverter(PAYLOAD, delete_enabled=False).convert(envelopes(spark, sf_dir)).rows.select("id", "value", "_op")


@query("SELECT event_id AS \"offset\", CASE WHEN event_id % 11 = 4 THEN 'unreadable value' ELSE 'missing ''after'' at offset ' || event_id END AS error FROM events WHERE event_id % 11 IN (3, 4)")
def q_dlq_split(spark, sf_dir):
    return EnvelopeConverter(PAYLOAD).convert(envelopes(spark, sf_dir)).rejects.select("offset", "error")


@query("SELECT event_id AS id, value, CASE WHEN event_id % 5 = 0 THEN CASE event_id % 3 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'UPDATE' ELSE 'INSERT' END WHEN event_id % 4 = 0 THEN 'DELETE' WHEN event_id % 3 = 0 THEN 'UPDATE' ELSE 'INSERT' END AS _op FROM events")
def q_cdc_flattened(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    k = F.col("event_id")
    header = F.when(k % 5 == 0, F.when(k % 3 == 0, "d").when(k % 3 == 1, "u").otherwise("zz"))
    value = F.struct(k.alias("id"), F.col("value"), F.when(k % 4 == 0, "true").otherwise("false").alias("__deleted"), F.when(k % 3 == 0, "u").alias("__op"))
    records = e.select(k.alias("offset"), header.alias("header_op"), value.alias("value"))
    return FlattenedConverter(records.schema["value"].dataType).convert(records).rows.select("id", "value", "_op")


@query("SELECT event_id AS id, value FROM events WHERE event_id % 6 <> 0")
def q_plain_records(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 6 != 0, F.struct(F.col("event_id").alias("id"), F.col("value")))
    return PlainConverter(PAYLOAD).convert(e.select(F.col("event_id").alias("offset"), value.alias("value"))).rows.select("id", "value")


@query("SELECT code, CASE WHEN code IN ('r', 'c') THEN 'INSERT' WHEN code = 'u' THEN 'UPDATE' WHEN code = 'd' THEN 'DELETE' END AS op, count(*) AS n FROM (SELECT substr('rcudx', CAST(event_id % 5 AS INT) + 1, 1) AS code FROM events) GROUP BY ALL")
def q_op_map(spark, sf_dir):
    code = F.substring(F.lit("rcudx"), (F.col("event_id") % 5 + 1).cast("int"), F.lit(1))
    return _table(spark, sf_dir, "events").select(code.alias("code")).withColumn("op", cdc.operation(F.col("code"))).groupBy("code", "op").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SRC} SELECT * FROM src")
def q_dedup_lww(spark, sf_dir):
    return dedup.last_writer(changes(spark, sf_dir), ["o_orderkey"], ["_seq"])


@query(f"WITH {SRC} {MERGED}")
def q_merge_full(spark, sf_dir):
    return merge.merge(_orders(spark, sf_dir), latest(spark, sf_dir), ["o_orderkey"])


@query(f"WITH {SRC} SELECT t.o_orderkey, CASE WHEN s._op IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice, CASE WHEN s._op IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus FROM tgt t LEFT JOIN src s ON t.o_orderkey = s.o_orderkey AND s._op <> 'DELETE'")
def q_merge_update(spark, sf_dir):
    return merge.rewrite(_orders(spark, sf_dir), latest(spark, sf_dir).where(F.col("_op") != cdc.DELETE), ["o_orderkey"])


@query(f"WITH {SRC} SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_orderkey = t.o_orderkey AND s._op = 'DELETE')")
def q_merge_delete(spark, sf_dir):
    return merge.rewrite(_orders(spark, sf_dir), latest(spark, sf_dir).where(F.col("_op") == cdc.DELETE), ["o_orderkey"])


@query(f"WITH {SRC} SELECT o_orderkey, o_totalprice, o_orderstatus FROM src s WHERE _op <> 'DELETE' AND NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey)")
def q_merge_insert(spark, sf_dir):
    return merge.inserts(_orders(spark, sf_dir), latest(spark, sf_dir), ["o_orderkey"])


LINES = "li AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY ALL), ch AS (SELECT l_orderkey + (l_orderkey % 3) * 1000000 AS l_orderkey, l_linenumber, q + 1 AS q, CASE WHEN l_linenumber % 3 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS _op FROM li WHERE l_orderkey % 2 = 0)"


@query(f"WITH {LINES} SELECT coalesce(t.l_orderkey, s.l_orderkey) AS l_orderkey, coalesce(t.l_linenumber, s.l_linenumber) AS l_linenumber, CASE WHEN s._op IS NULL THEN t.q ELSE s.q END AS q FROM li t FULL JOIN ch s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber WHERE s._op IS NULL OR s._op <> 'DELETE'")
def q_merge_composite(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    op = F.when(F.col("l_linenumber") % 3 == 0, cdc.DELETE).otherwise(cdc.UPDATE)
    ch = li.where(F.col("l_orderkey") % 2 == 0).select((F.col("l_orderkey") + (F.col("l_orderkey") % 3) * 1000000).alias("l_orderkey"), "l_linenumber", (F.col("q") + 1).alias("q"), op.alias("_op"))
    return merge.merge(li, ch, ["l_orderkey", "l_linenumber"])


@query(f"WITH {SRC}, t AS (SELECT nullif(o_orderkey, 8) AS k, o_totalprice AS v FROM tgt), s AS (SELECT nullif(o_orderkey, 4) AS k, o_totalprice AS v, _op FROM src) SELECT CAST(CASE WHEN s._op IS NULL THEN t.k ELSE s.k END AS VARCHAR) AS k, CASE WHEN s._op IS NULL THEN t.v ELSE s.v END AS v FROM t FULL JOIN s ON coalesce(t.k, -1) = coalesce(s.k, -1) WHERE s._op IS NULL OR s._op <> 'DELETE'")
def q_merge_null_key(spark, sf_dir):
    t = _orders(spark, sf_dir).select(F.nullif("o_orderkey", F.lit(8)).alias("k"), F.col("o_totalprice").alias("v"))
    s = latest(spark, sf_dir).select(F.nullif("o_orderkey", F.lit(4)).alias("k"), F.col("o_totalprice").alias("v"), "_op")
    return merge.merge(t, s, ["k"]).withColumn("k", F.col("k").cast("string"))


@query(f"WITH {SRC} SELECT DISTINCT o_orderkey // 1000 AS bucket FROM tgt t WHERE EXISTS (SELECT 1 FROM src s WHERE s.o_orderkey = t.o_orderkey AND s.o_orderkey < 6000)")
def q_merge_touched_files(spark, sf_dir):
    t = _orders(spark, sf_dir).withColumn("bucket", F.floor(F.col("o_orderkey") / 1000))
    return merge.touched(t, latest(spark, sf_dir).where("o_orderkey < 6000"), ["o_orderkey"], "bucket")


@query(f"WITH {SRC} SELECT count(*) FILTER (t.o_orderkey IS NULL AND s._op <> 'DELETE') AS inserted, count(*) FILTER (t.o_orderkey IS NOT NULL AND s._op IN ('INSERT', 'UPDATE')) AS updated, count(*) FILTER (t.o_orderkey IS NOT NULL AND s._op = 'DELETE') AS deleted, count(*) FILTER (t.o_orderkey IS NOT NULL AND s._op IS NULL) AS copied, count(*) FILTER (t.o_orderkey IS NULL AND s._op = 'DELETE') AS unmatched_deletes FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey")
def q_merge_metrics(spark, sf_dir):
    return merge.counters(_orders(spark, sf_dir), latest(spark, sf_dir), ["o_orderkey"])


@query(f"WITH {SRC}, f AS (SELECT o_orderkey // 1000 AS bucket, min(o_orderkey) AS low, max(o_orderkey) AS high FROM tgt GROUP BY 1), b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM src WHERE o_orderkey BETWEEN 500 AND 900) SELECT bucket, low, high FROM f, b WHERE NOT (high < lo OR low > hi)")
def q_prune_files(spark, sf_dir):
    """File skipping on the statistics themselves."""
    own = _orders(spark, sf_dir).withColumn("bucket", F.floor(F.col("o_orderkey") / 1000))
    files = stats.file_stats(own, [F.col("bucket")])
    _, bounds = bounds_of(latest(spark, sf_dir).where("o_orderkey BETWEEN 500 AND 900"), ["o_orderkey"])
    kept = prune(files, bounds, own.schema)
    part = lambda side: F.get_json_object("stats", f"$.{side}.o_orderkey").cast("long")
    return kept.select("bucket", part("minValues").alias("low"), part("maxValues").alias("high"))


@query(f"WITH {SRC} SELECT min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey, count(*) FILTER (o_orderkey IS NULL) AS nulls_o_orderkey FROM src")
def q_key_bounds(spark, sf_dir):
    return merge.key_bounds(latest(spark, sf_dir), ["o_orderkey"])


def _read_stats(df: DataFrame, by: str, *columns: tuple[str, str, str]) -> DataFrame:
    """Statistics by group, with parts of the JSON as columns: (name, JSON path, type)."""
    found = stats.file_stats(df, [F.col(by).alias("file")])
    return found.select("file", "num_records", *[F.get_json_object("stats", path).cast(kind).alias(name) for name, path, kind in columns])


@query("SELECT o_orderkey // 1000 AS file, count(*) AS num_records, min(o_orderkey) AS low, max(o_orderkey) AS high, min(o_totalprice) AS low_price, max(o_totalprice) AS high_price FROM orders GROUP BY 1")
def q_stats(spark, sf_dir):
    df = _orders(spark, sf_dir).withColumn("b", F.floor(F.col("o_orderkey") / 1000))
    return _read_stats(df, "b", ("low", "$.minValues.o_orderkey", "long"), ("high", "$.maxValues.o_orderkey", "long"), ("low_price", "$.minValues.o_totalprice", "double"), ("high_price", "$.maxValues.o_totalprice", "double"))


@query("SELECT o_orderkey // 1000 AS file, count(*) AS num_records, count(*) FILTER (o_orderkey % 7 = 0) AS nulls FROM orders GROUP BY 1")
def q_stats_nulls(spark, sf_dir):
    df = _orders(spark, sf_dir).select(F.floor(F.col("o_orderkey") / 1000).alias("b"), F.struct(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price")).alias("inner"))
    return _read_stats(df, "b", ("nulls", "$.nullCount.inner.price", "long"))


@query("SELECT source AS file, count(*) AS num_records, left(min(text), 32) AS low, CASE WHEN length(max(text)) <= 32 THEN max(text) ELSE left(max(text), 31) || chr(unicode(substr(max(text), 32, 1)) + 1) END AS high FROM documents GROUP BY 1")
def q_stats_strings(spark, sf_dir):
    return _read_stats(_table(spark, sf_dir, "documents").select("source", "text"), "source", ("low", "$.minValues.text", "string"), ("high", "$.maxValues.text", "string"))


@query("SELECT event_type AS file, count(*) AS num_records, strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS low, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS high, strftime(min(CAST(ts AS DATE)), '%Y-%m-%d') AS low_day FROM events GROUP BY 1")
def q_stats_temporal(spark, sf_dir):
    df = _table(spark, sf_dir, "events").select("event_type", "ts", F.col("ts").cast("date").alias("day"))
    return _read_stats(df, "event_type", ("low", "$.minValues.ts", "string"), ("high", "$.maxValues.ts", "string"), ("low_day", "$.minValues.day", "string"))


@query("SELECT event_id, (epoch_us(ts) // 1000) * 1000 AS from_ms, epoch_us(ts) AS from_us, CAST(trunc((event_id - 5000) * 1234567 / 1000.0) AS BIGINT) AS from_ns, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS days FROM events")
def q_ts_units(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select("event_id", F.unix_micros(logical.timestamp_from_millis(F.floor(us / 1000))).alias("from_ms"), F.unix_micros(logical.timestamp_from_micros(us)).alias("from_us"), F.unix_micros(logical.timestamp_from_nanos((F.col("event_id") - 5000) * 1234567)).alias("from_ns"), F.unix_date(logical.date_from_millis(F.floor(us / 1000))).cast("long").alias("days"))


@query("SELECT event_id, CAST(CAST((event_id - 5000) / 100.0 AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM events")
def q_decimal_bytes(spark, sf_dir):
    """Unscaled two's-complement bytes to decimals."""
    raw = F.unhex(F.lpad(F.hex(F.col("event_id") - 5000), 16, "0"))
    return _table(spark, sf_dir, "events").select("event_id", logical.decimal_from_bytes(raw, 18, 2).cast("double").alias("amount"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing.k') AS missing FROM events")
def q_nested_path(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", logical.nested(F.col("props"), "k").alias("k"), logical.nested(F.col("props"), "missing.k").alias("missing"))


@query("SELECT path, version FROM (SELECT 'part-' || (user_id % 997) AS path, event_id // 10 AS version, event_id % 10 AS line, event_id % 3 <> 0 AS is_add FROM events QUALIFY row_number() OVER (PARTITION BY user_id % 997 ORDER BY event_id DESC) = 1) WHERE is_add")
def q_log_replay(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    return replay(e.select(F.concat(F.lit("part-"), F.col("user_id") % 997).alias("path"), F.floor(F.col("event_id") / 10).alias("version"), (F.col("event_id") % 10).alias("line"), (F.col("event_id") % 3 != 0).alias("is_add")))


def _records(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), "value")


@query("SELECT event_type AS topic, user_id % 4 AS partition, max(event_id) AS \"offset\", 'sink:' || event_type || ':' || (user_id % 4) AS app_id FROM events GROUP BY 1, 2, 4")
def q_offsets(spark, sf_dir):
    found = dedup.greatest_offsets(_records(spark, sf_dir))
    return found.withColumn("app_id", names.app_id_column(F.col("topic"), F.col("partition")))


@query("WITH r AS (SELECT event_type AS topic, user_id % 4 AS partition, event_id AS \"offset\", value FROM events), c AS (SELECT topic, partition, max(\"offset\") AS o FROM r WHERE \"offset\" < 600 AND partition < 3 GROUP BY 1, 2) SELECT r.* FROM r LEFT JOIN c USING (topic, partition) WHERE o IS NULL OR \"offset\" > o")
def q_offset_filter(spark, sf_dir):
    r = _records(spark, sf_dir)
    return dedup.after_offsets(r, dedup.greatest_offsets(r.where("offset < 600 AND partition < 3")))


@query("SELECT event_type AS topic, count(*) AS n FROM events GROUP BY 1")
def q_topic_counts(spark, sf_dir):
    return dedup.topic_counts(_records(spark, sf_dir))


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST(NULL AS VARCHAR) AS email FROM customer UNION ALL SELECT c_custkey + 1000000, CAST(c_nationkey AS BIGINT), NULL, c_name FROM customer WHERE c_custkey % 2 = 0")
def q_schema_evolve(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    old = c.select("c_custkey", "c_nationkey", "c_acctbal")
    new = c.where("c_custkey % 2 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), F.col("c_nationkey").cast("long").alias("c_nationkey"), F.col("c_name").alias("email"))
    return schemas.union_evolved(old, new)


from . import sink_queries, table_queries, type_queries  # noqa: E402, F401  (they register themselves)

__all__ = ["QUERIES", "SQL", "DataFrame"]
