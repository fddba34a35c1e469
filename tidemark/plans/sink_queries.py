"""Queries of the sink: what its tables, folders, metrics and settings are after real batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CatalogSync, StatementCatalog, StatementFailed, StatementTimeout
from ..config import Config, ConfigError
from ..log.store import CommitConflict, HadoopLogStore, LocalLogStore, LogStore, register_store, store_for
from ..metrics import NAMES, Metrics
from ..operators.dedup import last_writer
from ..operators.records import EnvelopeConverter, PlainConverter
from ..streaming.sink import RejectedRecords, Retriable, TableSink
from .registry import query, report, scratch, table

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType())])


def _settings(spark, mode: str, **more) -> Config:
    root = scratch(spark)
    given = {"storage.path": f"{root}/lake", "write.mode": mode, "dead.letter.path": f"{root}/dead", **{k.replace("_", "."): v for k, v in more.items()}}
    return Config.of(given if mode == "append" else {"merge.keys": "id", **given})


def _plain(spark, sf_dir) -> DataFrame:
    """Events as plain records, a topic for each type; every id twice in a topic."""
    e = table(spark, sf_dir, "events")
    value = F.to_json(F.struct(F.floor(F.col("event_id") / 10).alias("id"), "value"))
    return e.select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), value.alias("value"))


def _envelopes(spark, sf_dir) -> DataFrame:
    """Change envelopes: two changes a key; some deletions, tombstones, unknown operations, and broken or empty ones."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id") % 11
    row = F.struct(F.floor(F.col("event_id") / 2).alias("id"), F.col("value"))
    op = F.when(n == 0, "d").when(n == 1, "x").when(n <= 5, "u").when(n <= 8, "c").otherwise("r")
    envelope = F.struct(F.when(n == 0, row).alias("before"), F.when((n != 0) & (n != 3), row).alias("after"), op.alias("op"), F.lit(1).alias("ts_ms"))
    value = F.when(n == 2, F.lit(None).cast("string")).when(n == 4, F.lit('{"op": "c", "after": ')).otherwise(F.to_json(envelope))
    return e.select(F.lit("t").alias("topic"), (F.col("event_id") % 4).alias("partition"), F.col("event_id").alias("offset"), value.alias("value"))


ENVELOPE = T.StructType([T.StructField("before", ROW), T.StructField("after", ROW), T.StructField("op", T.StringType())])
CHANGES = "c AS (SELECT event_id // 2 AS id, value, event_id AS o, CASE WHEN event_id % 11 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS op FROM events WHERE event_id % 11 NOT IN (1, 2, 3, 4))"


def _tables(sink: TableSink, topics) -> DataFrame:
    return reduce(DataFrame.unionByName, [sink.table(t).read().withColumn("topic", F.lit(t)) for t in sorted(topics)])


def _in_two(sink: TableSink, records: DataFrame) -> None:
    """Two batches, the second with the later offsets."""
    edge = records.agg(F.max("offset")).first()[0] // 2
    sink.process(records.where(F.col("offset") <= edge), 0)
    sink.process(records.where(F.col("offset") > edge), 1)


def _topics(spark, sf_dir) -> list[str]:
    return [r[0] for r in table(spark, sf_dir, "events").select("event_type").distinct().collect()]


@query("SELECT event_type AS topic, event_id // 10 AS id, value FROM events")
def q_sink_append(spark, sf_dir):
    """Plain records in two batches, routed to a table a topic."""
    topics = _topics(spark, sf_dir)
    sink = TableSink.configured(spark, _settings(spark, "append"), dict.fromkeys(topics, ROW))
    _in_two(sink, _plain(spark, sf_dir))
    return _tables(sink, topics).select("topic", "id", "value")


@query("SELECT event_type AS topic, event_id // 10 AS id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, event_id // 10 ORDER BY event_id DESC) = 1")
def q_sink_upsert(spark, sf_dir):
    """Plain records by key: the last one of each id stays, whichever batch has it."""
    topics = _topics(spark, sf_dir)
    sink = TableSink.configured(spark, _settings(spark, "upsert"), dict.fromkeys(topics, ROW))
    _in_two(sink, _plain(spark, sf_dir))
    return _tables(sink, topics).select("topic", "id", "value")


@query(f"WITH {CHANGES} SELECT id, value FROM (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY o DESC) = 1) WHERE op <> 'DELETE'")
def q_sink_cdc(spark, sf_dir):
    sink = TableSink.configured(spark, _settings(spark, "cdc"), {"t": ENVELOPE})
    sink.process(_envelopes(spark, sf_dir))
    return sink.table("t").read()


@query(f"WITH {CHANGES} SELECT id, value FROM c WHERE op <> 'DELETE' QUALIFY row_number() OVER (PARTITION BY id ORDER BY o DESC) = 1")
def q_sink_no_delete(spark, sf_dir):
    """Deletions switched off by the settings."""
    sink = TableSink.configured(spark, _settings(spark, "cdc", merge_delete_enabled="false"), {"t": ENVELOPE})
    sink.process(_envelopes(spark, sf_dir))
    return sink.table("t").read()


@query(f"WITH {CHANGES} SELECT id, value FROM c WHERE op <> 'DELETE' QUALIFY row_number() OVER (PARTITION BY id ORDER BY o DESC) = 1")
def q_sink_upsert_never_deletes(spark, sf_dir):
    """An upsert whose converter yields deletions, as a caller's own may."""
    sink = TableSink(spark, _settings(spark, "upsert"), lambda topic: EnvelopeConverter(ROW))
    sink.process(_envelopes(spark, sf_dir))
    return sink.table("t").read()


@query("SELECT event_id AS id, value FROM events WHERE event_id % 4 <> 0")
def q_sink_flattened(spark, sf_dir):
    """Flat change records: the setting of the envelope's format chooses the converter."""
    e = table(spark, sf_dir, "events")
    value = F.to_json(F.struct(F.col("event_id").alias("id"), "value", F.when(F.col("event_id") % 4 == 0, "true").otherwise("false").alias("__deleted")))
    schema = T.StructType([*ROW.fields, T.StructField("__deleted", T.StringType())])
    sink = TableSink.configured(spark, _settings(spark, "cdc", cdc_envelope_format="debezium_flattened"), {"t": schema})
    sink.process(e.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), value.alias("value")))
    return sink.table("t").read()


@query("SELECT event_id AS id, value, 2::BIGINT AS version FROM events WHERE event_id % 11 NOT IN (0, 1, 2, 3, 4)")
def q_sink_exactly_once(spark, sf_dir):
    """Batches that are run again, whole, in part and out of order, change nothing. A table that grew by two commits
    (made, and one batch) is at version 1, and an overlapping batch adds one more."""
    sink = TableSink.configured(spark, _settings(spark, "append"), {"t": ROW})
    e = table(spark, sf_dir, "events").where("event_id % 11 NOT IN (0, 1, 2, 3, 4)")
    records = e.select(F.lit("t").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), F.to_json(F.struct(F.col("event_id").alias("id"), "value")).alias("value"))
    edge = records.agg(F.max("offset")).first()[0] // 2
    first = records.where(F.col("offset") <= edge)
    for batch in (first, first, first.where("offset % 3 = 0"), records, records, first):
        sink.process(batch)
    return sink.table("t").read().withColumn("version", F.lit(sink.table("t").snapshot().version).cast("long"))


@query("SELECT topic, partition, max(o) AS \"offset\" FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'a:b' END AS topic, user_id % 4 AS partition, event_id AS o FROM events) GROUP BY 1, 2")
def q_sink_offsets(spark, sf_dir):
    """Two topics in one table, one's name the beginning of the other's: offsets stay apart."""
    sink = TableSink(spark, _settings(spark, "append", table_name="both"), lambda topic: PlainConverter(ROW))
    e = table(spark, sf_dir, "events")
    records = e.select(F.when(F.col("event_id") % 3 == 0, "a").otherwise("a:b").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), F.to_json(F.struct(F.col("event_id").alias("id"), "value")).alias("value"))
    sink.process(records)
    return report(spark, [(t, p, o) for t in ("a", "a:b") for p, o in sink.committed_offsets(t).items()], "topic string, partition long, offset long")


@query("SELECT event_id AS \"offset\", CASE WHEN event_id % 11 = 4 THEN 'unreadable value' ELSE 'missing ''after'' at offset ' || event_id END AS error FROM events WHERE event_id % 11 IN (3, 4)")
def q_sink_dead_letters(spark, sf_dir):
    settings = _settings(spark, "cdc")
    TableSink.configured(spark, settings, {"t": ENVELOPE}).process(_envelopes(spark, sf_dir), 5)
    return spark.read.parquet(f"{settings['dead.letter.path']}/topic=t/batch=5").select("offset", "error")


@query(f"WITH {CHANGES}, l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY o DESC) = 1), n AS (SELECT count(*)::DOUBLE AS received FROM events) SELECT name, CASE name WHEN 'records.received' THEN received WHEN 'records.converted' THEN (SELECT count(*) FROM c) WHEN 'records.flushed' THEN (SELECT count(*) FROM c) WHEN 'records.dlq' THEN (SELECT count(*) FROM events WHERE event_id % 11 IN (3, 4)) WHEN 'commit.version' THEN 1 WHEN 'merge.inserted' THEN (SELECT count(*) FROM l WHERE op <> 'DELETE') ELSE 0 END::DOUBLE AS value FROM n, (VALUES ('records.received'), ('records.converted'), ('records.dlq'), ('records.flushed'), ('commit.version'), ('merge.inserted'), ('merge.updated'), ('merge.deleted'), ('merge.files.rewritten'), ('merge.files.skipped'), ('schema.evolutions')) t(name)")
def q_sink_metrics(spark, sf_dir):
    """The sink's metrics, but for the time that a flush takes."""
    metrics = Metrics()
    sink = TableSink.configured(spark, _settings(spark, "cdc"), {"t": ENVELOPE}, metrics)
    sink.process(_envelopes(spark, sf_dir))
    assert metrics.get("flush.latency", "t") > 0
    return report(spark, [(n, float(metrics.get(n, "t"))) for n in NAMES if n != "flush.latency"], "name string, value double")


@query("SELECT event_id // 10 AS id, value FROM events")
def q_stream(spark, sf_dir):
    """Files as a stream: drained by two queries over one checkpoint, the second of which finds new files only."""
    root = scratch(spark)
    records = _plain(spark, sf_dir).withColumn("topic", F.lit("t")).withColumn("partition", F.col("offset") % 2)
    sink = TableSink.configured(spark, _settings(spark, "append"), {"t": ROW})
    for part in range(2):
        records.where(F.col("partition") == part).coalesce(1).write.mode("append").json(f"{root}/in")
        stream = spark.readStream.schema("topic string, partition long, offset long, value string").option("maxFilesPerTrigger", 1).json(f"{root}/in")
        sink.start(stream, f"{root}/checkpoint", available_now=True).awaitTermination(300)
    return sink.table("t").read()


@query("SELECT what, value FROM (VALUES ('batch', '123'), ('interval', '5000 milliseconds'), ('default batch', '50000')) t(what, value)")
def q_triggers(spark, sf_dir):
    """What the settings make of a stream: a bound of its batches, and the time between them."""
    sink = TableSink.configured(spark, _settings(spark, "append", merge_batch_size="123", merge_interval_ms="5000"), {"t": ROW})
    other = TableSink.configured(spark, _settings(spark, "append"), {"t": ROW})
    return report(spark, [("batch", sink.read_options()["maxOffsetsPerTrigger"]), ("interval", f"{sink.config['merge.interval.ms']} milliseconds"), ("default batch", other.read_options()["maxOffsetsPerTrigger"])], "what string, value string")


class _Busy(LocalLogStore):
    """Another writer is always first."""

    def write_commit(self, table: str, version: int, data: bytes) -> None:
        if version:
            raise CommitConflict(table, version)
        super().write_commit(table, version, data)


class _Broken(LocalLogStore):
    def write_commit(self, table: str, version: int, data: bytes) -> None:
        raise OSError("no such device")


@query("SELECT name, error FROM (VALUES ('conflict', 'retriable'), ('storage', 'retriable'), ('bad record', 'rejected'), ('incompatible', 'IncompatibleSchema')) t(name, error)")
def q_sink_errors(spark, sf_dir):
    """What may be tried again, and what may not."""
    good = report(spark, [("t", 0, 1, '{"id": 1, "value": 2.0}')], "topic string, partition long, offset long, value string")
    bad = good.withColumn("value", F.lit("{"))
    out = []
    for name, store, batch in (("conflict", _Busy(), good), ("storage", _Broken(), good), ("bad record", None, bad), ("incompatible", None, good)):
        settings = _settings(spark, "append", dead_letter_path="")
        sink = TableSink.configured(spark, settings, {"t": ROW})
        if store is not None:
            own = sink.table("t")
            own.store = store
            sink.table = lambda topic, own=own: own
        if name == "incompatible":
            sink.table("t").append(report(spark, [("x",)], "id string"))
        try:
            sink.process(batch)
            out.append((name, "none"))
        except Retriable:
            out.append((name, "retriable"))
        except RejectedRecords:
            out.append((name, "rejected"))
        except Exception as e:
            out.append((name, type(e).__name__))
    return report(spark, out, "name string, error string")


CASES = (
    ("good", {}, ""), ("no path", {"storage.path": None}, "storage.path"), ("no keys", {"merge.keys": ""}, "merge.keys"), ("append needs no keys", {"merge.keys": "", "write.mode": "append"}, ""),
    ("batch", {"merge.batch.size": 0}, "merge.batch.size"), ("interval", {"merge.interval.ms": 999}, "merge.interval.ms"), ("checkpoint", {"checkpoint.interval": 0}, "checkpoint.interval"),
    ("sync", {"catalog.sync.interval.ms": 9999}, "catalog.sync.interval.ms"), ("mode", {"write.mode": "no"}, "write.mode"), ("format", {"cdc.envelope.format": "no"}, "cdc.envelope.format"),
    ("number", {"merge.batch.size": "many"}, "merge.batch.size"), ("truth", {"schema.evolution": "maybe"}, "schema.evolution"), ("unknown", {"no.such.key": 1}, "no.such.key"),
    ("catalog", {"catalog.enabled": "true"}, "catalog.name,catalog.schema"), ("container", {"storage.path": "abfss:///x"}, "storage.path"), ("secret", {"storage.path": "abfss://c@a/x", "storage.auth": "key"}, "storage.secret"),
)


@query("SELECT name, keys FROM (VALUES " + ", ".join(f"('{n}', '{k}')" for n, _, k in CASES) + ") t(name, keys)")
def q_settings(spark, sf_dir):
    """Settings that are refused, by the key that the message is under."""
    out = []
    for name, change, _ in CASES:
        given = {k: v for k, v in ({"storage.path": "/x", "merge.keys": "id"} | change).items() if v is not None}
        try:
            Config.of(given)
            out.append((name, ""))
        except ConfigError as e:
            out.append((name, ",".join(sorted(e.errors))))
    return report(spark, out, "name string, keys string")


@query("SELECT auth, options::BIGINT AS options, kind FROM (VALUES ('key', 2, 'SharedKey'), ('sas', 2, 'SAS'), ('identity', 2, 'OAuth'), ('', 0, '')) t(auth, options, kind)")
def q_blob_options(spark, sf_dir):
    """Settings of the blob store's access that a sink hands to its session."""
    out = []
    for auth in ("key", "sas", "identity", ""):
        own = spark.newSession()
        settings = Config.of({"storage.path": "abfss://box@host.example/base", "write.mode": "append", "storage.auth": auth, "storage.secret": "s"})
        TableSink.configured(own, settings, {"t": ROW})
        given = settings.hadoop_options()
        out.append((auth, sum(own.conf.get(k, None) == v for k, v in given.items()), own.conf.get("fs.azure.account.auth.type.host.example", "") if given else ""))
    return report(spark, out, "auth string, options long, kind string")


@query("SELECT place::BIGINT AS place, word, what FROM (VALUES (0, 'CREATE', 'sent'), (1, 'MSCK', 'sent'), (2, 'CREATE', 'sent'), (3, 'failed', 'StatementFailed'), (4, 'pending', 'StatementTimeout')) t(place, word, what)")
def q_catalog(spark, sf_dir):
    """A table is registered once and refreshed after the interval; failures are logged and go no further."""
    sent, state, now = [], ["SUCCEEDED"], [0.0]
    client = StatementCatalog(lambda sql: (sent.append(sql.split()[0]), (state[0], None))[1])
    sync = CatalogSync(client, 10, lambda: now[0])
    for t in (0, 5, 11):
        now[0] = t
        sync.committed("lake.orders", "/p")
    state[0] = "FAILED"
    sync.committed("lake.other", "/q")
    out = [(i, w, "sent") for i, w in enumerate(sent)]
    for word, s, kind in (("failed", "FAILED", StatementFailed), ("pending", "PENDING", StatementTimeout)):
        state[0] = s
        try:
            client.refresh("lake.orders")
        except StatementFailed as e:
            out.append((len(out), word, type(e).__name__ if isinstance(e, kind) else "other"))
    return report(spark, out, "place long, word string, what string")


@query("SELECT scheme, store FROM (VALUES ('file', 'LocalLogStore'), ('plain', 'LocalLogStore'), ('hdfs', 'HadoopLogStore'), ('busy', '_Busy'), ('abstract', 'TypeError')) t(scheme, store)")
def q_stores(spark, sf_dir):
    """The store of a path's scheme; a store must have all of the interface."""
    register_store("busy", lambda _: _Busy())
    out = [(s, type(store_for(spark, p)).__name__) for s, p in (("file", "file:///x"), ("plain", "/x"), ("hdfs", "hdfs://h/x"), ("busy", "BUSY://x"))]
    assert isinstance(store_for(spark, "s3a://b/x"), HadoopLogStore)
    try:
        LogStore()
    except TypeError as e:
        out.append(("abstract", type(e).__name__))
    return report(spark, out, "scheme string, store string")


@query("SELECT event_id // 8 AS id, max_by(value, event_id // 8 * 0 + event_id % 8) AS value FROM events GROUP BY 1")
def q_arrival(spark, sf_dir):
    """Partitions whose offsets are equal: topic and partition settle the order, on every run."""
    e = table(spark, sf_dir, "events")
    records = e.select(F.lit("t").alias("topic"), (F.col("event_id") % 8).alias("partition"), F.lit(0).cast("long").alias("offset"), F.to_json(F.struct(F.floor(F.col("event_id") / 8).alias("id"), "value")).alias("value"))
    rows = PlainConverter(ROW).convert(records.repartition(5)).rows
    return last_writer(rows.select("id", "value", "_seq"), ["id"], ["_seq"]).select("id", "value")
