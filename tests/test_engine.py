"""Tables, log, MERGE, schema evolution, records, sink and settings."""

import json
import random
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as schemas
from tidemark.catalog import CatalogSync, StatementCatalog, StatementFailed, StatementTimeout
from tidemark.config import Config, ConfigError
from tidemark.functions import logical, names
from tidemark.log import snapshot as snapshots
from tidemark.log.actions import AddFile, CommitInfo, Metadata, RemoveFile, SetTransaction, parse, serialise
from tidemark.log.store import CommitConflict, HadoopLogStore, LocalLogStore
from tidemark.metrics import Metrics
from tidemark.operators.merge import MissingKey
from tidemark.operators.stats import file_stats
from tidemark.operators.records import EnvelopeConverter, PlainConverter
from tidemark.streaming.sink import RejectedRecords, TableSink
from tidemark.table import Table

ROW = "id int, name string, value int"


def rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=repr)


def source(spark, data, schema=ROW):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], schema + ", _op string, _seq int")


@pytest.fixture
def table(spark, tmp_path):
    own = Table(spark, str(tmp_path / "t"))
    own.append(spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], ROW).coalesce(1))
    return own


def test_mixed_merge(spark, table):
    result = table.merge(source(spark, [(1, "A", 11, "UPDATE"), (2, None, None, "DELETE"), (4, "d", 40, "INSERT"), (99, None, None, "DELETE"), (4, "D", 41, "UPDATE")]), ["id"])
    assert rows(table) == [(1, "A", 11), (3, "c", 30), (4, "D", 41)]
    assert (result.inserted, result.updated, result.deleted, result.copied) == (1, 1, 1, 1)


def test_null_keys_match_and_are_not_skipped(spark, tmp_path):
    table = Table(spark, str(tmp_path / "n"))
    table.append(spark.createDataFrame([(None, "a", 1)], ROW))
    table.append(spark.createDataFrame([(5, "b", 2)], ROW))
    table.merge(source(spark, [(None, "x", 9, "INSERT"), (700, "y", 8, "UPDATE")]), ["id"])
    assert rows(table) == [(5, "b", 2), (700, "y", 8), (None, "x", 9)]


def test_only_touched_files_are_rewritten(spark, tmp_path):
    table = Table(spark, str(tmp_path / "f"))
    for start in (0, 200, 400):
        table.append(spark.range(start, start + 200).select(F.col("id").cast("int").alias("id"), F.lit("n").alias("name"), F.lit(1).alias("value")).coalesce(1))
    result = table.merge(source(spark, [(210, "u", 2, "UPDATE"), (399, "u", 2, "UPDATE")]), ["id"])
    assert (result.files_rewritten, result.files_skipped, result.updated, result.copied) == (1, 2, 2, 198)
    assert table.read().count() == 600
    with pytest.raises(MissingKey, match="Merge key column 'nonexistent' not found in schema"):
        table.merge(source(spark, [(1, "a", 1, "INSERT")]), ["nonexistent"])


def test_random_merges_against_a_dictionary(spark, tmp_path):
    rng, table, model = random.Random(3), Table(spark, str(tmp_path / "r"), interval=3), {}
    for _ in range(4):
        batch = [(rng.choice([None, *range(12)]), rng.choice("xyz"), rng.randint(0, 9), rng.choice(["INSERT", "UPDATE", "DELETE"])) for _ in range(12)]
        table.merge(source(spark, batch), ["id"])
        for key, name, value, op in batch:
            model.pop(key, None)
            if op != "DELETE":
                model[key] = (key, name, value)
        assert rows(table) == sorted(model.values(), key=repr)


def test_evolution_reads_old_files(spark, table):
    before = table.snapshot().metadata.id
    table.append(spark.createDataFrame([(4, "d", 2**40, "e")], "id int, name string, value long, email string"))
    assert (4, "d", 2**40, "e") in rows(table) and (1, "a", 10, None) in rows(table)
    table.merge(source(spark, [(1, "z", 2**41, "UPDATE")], "id int, name string, value long"), ["id"])
    assert (1, "z", 2**41, None) in rows(table) and table.snapshot().metadata.id == before
    with pytest.raises(schemas.IncompatibleSchema):
        table.append(spark.createDataFrame([(1, 5, 1)], "id int, name int, value int"))
    with pytest.raises(schemas.IncompatibleSchema):
        table.append(spark.createDataFrame([(1, 5)], "id int, more int"), evolution=False)


@pytest.mark.parametrize(
    ("old", "new", "want"),
    [("byte", "short", "smallint"), ("int", "long", "bigint"), ("long", "int", "bigint"), ("float", "double", "double"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "decimal(10,4)", None), ("int", "string", None), ("struct<a:int>", "struct<a:int,b:int>", None)],
)
def test_widening(old, new, want):
    a, b = (T.StructType.fromDDL(f"c {x}") for x in (old, new))
    if want is None:
        with pytest.raises(schemas.IncompatibleSchema):
            schemas.merge(a, b)
    else:
        assert schemas.merge(a, b).schema["c"].dataType.simpleString() == want


def test_new_columns_must_be_nullable_and_case_must_differ_in_more():
    a = T.StructType([T.StructField("id", T.IntegerType(), False)])
    with pytest.raises(schemas.IncompatibleSchema):
        schemas.merge(a, T.StructType([*a.fields, T.StructField("x", T.IntegerType(), False)]))
    with pytest.raises(schemas.IncompatibleSchema):
        schemas.merge(a, T.StructType([T.StructField("ID", T.IntegerType(), True)]))
    assert schemas.from_json(schemas.to_json(a)) == a


def test_actions_round_trip():
    own = [AddFile("a", {}, 5, 6, True, '{"numRecords":1}'), RemoveFile("b", 7), SetTransaction("app", 3, 9), Metadata("id", "{}"), CommitInfo(1, "WRITE", {"k": "v"}, "e", True)]
    assert parse(serialise(own)) == own
    assert parse(b'\n{"add":{"path":"x","later":1}}\n') == [AddFile("x")]
    with pytest.raises(ValueError, match="unknown action"):
        parse(b'{"other":{}}')


def test_checkpoint_and_broken_pointer(spark, tmp_path):
    table = Table(spark, str(tmp_path / "c"), interval=2)
    for i in range(5):
        table.append(spark.createDataFrame([(i, "n", i)], ROW).coalesce(1), [SetTransaction("app", i)])
    at = table.snapshot()
    assert at.version == 5 and len(at.files) == 5 and at.committed("app") == 4
    assert json.loads(table.store.read_pointer(table.path))["version"] == 4
    table.store.write_pointer(table.path, b"no json")
    assert table.snapshot().files.keys() == at.files.keys()
    assert table.create_or_replace(T.StructType.fromDDL("x int")) == 6
    assert table.snapshot().files == {} and table.read().columns == ["x"]


@pytest.mark.parametrize("kind", ["local", "hadoop"])
def test_one_of_many_writers_wins_a_version(spark, tmp_path, kind):
    store = LocalLogStore() if kind == "local" else HadoopLogStore(spark)
    path, won = str(tmp_path / "w"), []

    def write(n):
        try:
            store.write_commit(path, 0, b"%d" % n)
            won.append(n)
        except CommitConflict:
            pass

    many = [threading.Thread(target=write, args=(n,)) for n in range(8)]
    [t.start() for t in many]
    [t.join() for t in many]
    write(99)
    assert len(won) == 1 and store.read_commit(path, 0) == b"%d" % won[0]
    assert store.list_commits(path) == [0] and store.read_commit(path, 1) is None


def test_appends_rebase_and_merges_conflict(spark, table):
    at = table.snapshot()
    early, merge = table.start(at).add(AddFile("p1")), table.start(at).add(AddFile("p2"))
    table.append(spark.createDataFrame([(9, "i", 90)], ROW))
    assert early.commit("WRITE") == at.version + 2
    with pytest.raises(CommitConflict):
        merge.commit("MERGE")
    with pytest.raises(ValueError):
        table.start().commit()


def test_statistics(spark):
    data = spark.createDataFrame([("x" * 100, Decimal("1.50"), float("nan"), b"1", (None,)), ("a" * 100, None, 1.0, b"2", (7,))], "s string, d decimal(5,2), f double, b binary, n struct<i:int>")
    own = json.loads(file_stats(data, [F.lit(1).alias("g")]).first()["stats"])
    assert own["numRecords"] == 2 and own["minValues"]["s"] == "a" * 32 and own["maxValues"]["s"] == "x" * 31 + "y"
    assert "f" not in own["maxValues"] and "b" not in own["minValues"] and own["nullCount"] == {"s": 0, "d": 1, "f": 0, "b": 0, "n": {"i": 1}}
    assert own["minValues"]["n"] == {"i": 7} and own["maxValues"]["d"] == "1.50"


def test_logical_values(spark):
    big = (10**37).to_bytes(16, "big")
    data = spark.createDataFrame([(big, (3, (-12345).to_bytes(3, "big", signed=True)), 1609459200000, -1500)], "b binary, v struct<scale:int,value:binary>, ms long, ns long")
    r = data.select(logical.decimal_from_bytes(F.col("b"), 38, 2).alias("d"), logical.text_from_variable_decimal(F.col("v")).alias("v"), F.unix_micros(logical.timestamp_from_millis(F.col("ms"))).alias("us"), logical.micros_from_nanos(F.col("ns")).alias("n")).first()
    assert r.d == Decimal(10**37).scaleb(-2) and r.v == "-12.345" and r.us == 1609459200000000 and r.n == -1


def test_names():
    assert names.scheme("ABFSS://c@a/p") == "abfss" and names.scheme("/x") == "file"
    assert names.container_and_path("abfss://c@acc.dfs/base/x") == ("c", "base/x") and names.commit_file(7) == "0" * 19 + "7.json"


def settings(tmp_path, **more):
    return Config.of({"storage.path": str(tmp_path / "lake"), "merge.keys": "id", **{k.replace("_", "."): v for k, v in more.items()}})


def test_settings(tmp_path):
    assert settings(tmp_path).deletes and not settings(tmp_path, write_mode="upsert").deletes
    with pytest.raises(ConfigError) as e:
        Config.of({"storage.path": "/x", "write.mode": "cdc"})
    assert "merge.keys" in e.value.errors
    for bad in ({"merge.batch.size": 0}, {"merge.interval.ms": 10}, {"write.mode": "no"}, {"catalog.enabled": "true"}):
        with pytest.raises(ConfigError):
            Config.of({"storage.path": "/x", "merge.keys": "id", **bad})


def records(spark, data):
    return spark.createDataFrame([("t", 0, i, None if v is None else v if isinstance(v, str) else json.dumps(v)) for i, v in data], "topic string, partition long, offset long, value string")


def test_sink_is_exactly_once_and_rejects_to_its_folder(spark, tmp_path):
    sink = TableSink(spark, settings(tmp_path, dead_letter_path=str(tmp_path / "dlq")), lambda topic: EnvelopeConverter(T.StructType.fromDDL(ROW)), Metrics())
    row = lambda i, n: {"id": i, "name": n, "value": i}
    first = records(spark, [(0, {"op": "c", "after": row(1, "a")}), (1, {"op": "u", "after": row(1, "b")}), (2, "{broken"), (3, None), (4, {"op": "d", "before": row(7, "x")}), (5, {"op": "c", "after": row(2, "c")})])
    sink.process(first, 0)
    version = sink.table("t").snapshot().version
    sink.process(first, 0)
    assert sink.table("t").snapshot().version == version
    assert rows(sink.table("t")) == [(1, "b", 1), (2, "c", 2)] and sink.committed_offsets("t") == {0: 5}
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == 1 and sink.metrics.get("records.dlq", "t") == 1
    sink.process(records(spark, [(5, {"op": "c", "after": row(9, "old")}), (6, {"op": "d", "before": row(1, "b")})]), 1)
    assert rows(sink.table("t")) == [(2, "c", 2)]
    bare = TableSink(spark, settings(tmp_path / "b"), lambda topic: EnvelopeConverter(T.StructType.fromDDL(ROW)))
    with pytest.raises(RejectedRecords):
        bare.process(first, 0)


def test_stream(spark, tmp_path):
    data = [(i, {"id": i, "name": "n", "value": i}) for i in range(6)]
    for part in (data[:3], data[3:]):
        records(spark, part).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    sink = TableSink(spark, settings(tmp_path, write_mode="append"), lambda topic: PlainConverter(T.StructType.fromDDL(ROW)))
    stream = spark.readStream.schema("topic string, partition long, offset long, value string").option("maxFilesPerTrigger", 2).json(str(tmp_path / "in"))
    for _ in range(2):
        sink.start(stream, str(tmp_path / "cp"), available_now=True).awaitTermination(120)
    assert len(rows(sink.table("t"))) == 6


@pytest.mark.parametrize("driver_commits", [100, 0])
def test_snapshots_replayed_by_driver_and_executors_agree(spark, tmp_path, driver_commits):
    """Adds, removals, marks and metadata on top of a checkpoint, and without one."""
    for interval in (4, 100):
        table = Table(spark, str(tmp_path / f"{driver_commits}-{interval}"), interval=interval)
        for i in range(5):
            table.append(spark.createDataFrame([(i, "n", i)], ROW).coalesce(1), [SetTransaction(f"app{i % 2}", i)])
        table.merge(source(spark, [(1, "x", 9, "UPDATE"), (2, None, None, "DELETE"), (8, "y", 8, "INSERT")]), ["id"])
        at = snapshots.load(spark, table.store, table.path, driver_commits)
        assert at.version == 6 and {a: t.version for a, t in at.transactions.items()} == {"app0": 4, "app1": 3}
        assert at.commit_info.operation == "MERGE" and len(at.schema) == 3 and at.protocol.minWriterVersion == 2
        assert sorted(tuple(r) for r in table.read(at).collect()) == [(0, "n", 0), (1, "x", 9), (3, "n", 3), (4, "n", 4), (8, "y", 8)]
        assert at.files.keys() == at.sizes(spark).keys()
        if not driver_commits and interval == 100:
            table.store.write_commit(table.path, 7, b'{"other":{}}')
            with pytest.raises(ValueError, match="unknown action"):
                snapshots.load(spark, table.store, table.path, 0)


def test_catalog_sync():
    sent, states, now = [], {"next": ("SUCCEEDED", None)}, [0.0]
    catalog = StatementCatalog(lambda sql: (sent.append(sql), states["next"])[1])
    sync = CatalogSync(catalog, 10, lambda: now[0])
    for t in (0, 5, 11):
        now[0] = t
        sync.committed("a.b", "/p")
    assert len(sent) == 2 and sent[0].startswith("CREATE TABLE IF NOT EXISTS `a`.`b`") and sent[1].startswith("MSCK REPAIR")
    states["next"] = ("FAILED", "x")
    sync.committed("c", "/p")
    with pytest.raises(StatementFailed):
        catalog.refresh("c")
    states["next"] = ("PENDING", None)
    with pytest.raises(StatementTimeout):
        catalog.refresh("c")
    assert snapshots.Snapshot().version == -1
