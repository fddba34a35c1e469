"""Queries of tables and their log: what a table says after real commits, merges and checkpoints."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import commit_file
from ..log import snapshot as snapshots
from ..log.actions import ROW, AddFile, CommitInfo, Metadata, Protocol, RemoveFile, SetTransaction, parse, serialise
from ..log.store import CommitConflict, HadoopLogStore, LocalLogStore
from ..log.txn import write_commit
from ..operators.stats import file_stats
from ..sources.parquet import commit_lines, rows
from ..table import Table
from .registry import CHG, MERGED, SRC, changes, orders, query, report, scratch, scratch_table, table

#: Type of a merge key -> (the key from the id, files that statistics skip, zone of the session).
KEYS = {
    "int": ("cast(id as int)", 1, None),
    "long": ("id * 10000000000", 1, None),
    "short": ("cast(id as smallint)", 1, None),
    "float": ("cast(id as float) + cast(0.1 as float)", 1, None),
    "double": ("id + 0.1D", 1, None),
    "decimal": ("cast(id as decimal(20, 3)) / 8", 1, None),
    "string": ("concat(lpad(cast(id as string), 6, '0'), repeat('é', 40))", 1, None),
    "date": ("date_from_unix_date(cast(id * 10 - 800000 as int))", 1, None),
    "timestamp": ("timestamp_micros(id * 9000000000 - 31000000000000001)", 1, None),
    "timestamp_zoned": ("timestamp_micros(id * 1800000000 + 1700000000000001)", 1, "America/Los_Angeles"),
    "timestamp_ntz": ("cast('2024-03-10 00:00:00' as timestamp_ntz) + make_dt_interval(0, 0, cast(id as int) * 7, 0.000001)", 1, "America/Los_Angeles"),
    "struct_field": ("named_struct('a', named_struct('b', id))", 1, None),
    "binary": ("cast(lpad(cast(id as string), 6, '0') as binary)", 0, None),
}
PRUNED = "SELECT o_orderkey AS id, o_totalprice AS v, {skipped}::BIGINT AS skipped FROM orders WHERE o_orderkey < 400 AND NOT o_orderkey BETWEEN 250 AND 300 UNION ALL SELECT id, -id, {skipped} FROM (SELECT unnest(range(250, 301)) AS id UNION ALL SELECT unnest(range(390000, 390011)))"


def _pruned(expression: str, zone: str | None, nested: bool):
    def run(spark, sf_dir) -> DataFrame:
        own = spark.newSession() if zone else spark
        if zone:
            own.conf.set("spark.sql.session.timeZone", zone)
        target = scratch_table(own)
        base = table(own, sf_dir, "orders").where("o_orderkey < 400").select(F.col("o_orderkey").alias("id"), F.expr(expression.replace("id", "o_orderkey")).alias("k"), F.col("o_totalprice").alias("v"))
        for part in ("id < 200", "id >= 200"):
            target.append(base.where(part).coalesce(1))
        fresh = own.range(250, 301).unionAll(own.range(390000, 390011)) if "smallint" not in expression else own.range(250, 301)
        source = fresh.select("id", F.expr(expression).alias("k"), (-F.col("id")).cast("double").alias("v"), F.lit("UPDATE").alias("_op"), F.lit(1).alias("_seq"))
        if "smallint" in expression:
            source = source.unionAll(own.range(390000, 390011).select("id", F.expr("cast(id - 380000 as smallint)"), (-F.col("id")).cast("double"), F.lit("UPDATE"), F.lit(1)))
        result = target.merge(source, ["k.a.b" if nested else "k"])
        return target.read().select("id", "v", F.lit(result.files_skipped).cast("long").alias("skipped"))

    return run


for _name, (_expression, _skipped, _zone) in KEYS.items():
    query(PRUNED.format(skipped=_skipped), f"q_merge_pruned_{_name}")(_pruned(_expression, _zone, _name == "struct_field"))


@query("SELECT k, CASE WHEN k THEN -1.0::DOUBLE ELSE n END AS n FROM (SELECT o_orderkey % 2 = 0 AS k, count(*)::DOUBLE AS n FROM orders GROUP BY 1)", "q_merge_pruned_boolean")
def q_merge_boolean(spark, sf_dir):
    target = scratch_table(spark)
    target.append(table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 2 == 0).alias("k")).agg(F.count(F.lit(1)).cast("double").alias("n")))
    target.merge(report(spark, [(True, -1.0, "UPDATE", 1)], "k boolean, n double, _op string, _seq int"), ["k"])
    return target.read()


def _parts(spark, sf_dir, n: int, **options) -> Table:
    """Orders in a table of n commits, a file each."""
    own = scratch_table(spark, **options)
    for part in range(n):
        own.append(orders(spark, sf_dir).where(F.col("o_orderkey") % n == part).coalesce(1), [SetTransaction("app", part)])
    return own


@query("SELECT sum(n)::BIGINT AS n, min(low) AS low, max(high) AS high, 0::BIGINT AS nulls, count(*) AS files FROM (SELECT o_orderkey % 3, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders GROUP BY 1)")
def q_table_stats(spark, sf_dir):
    """Statistics that appends left in the log."""
    stats = _parts(spark, sf_dir, 3).snapshot().file_table(spark)
    part = lambda path: F.get_json_object("stats", path).cast("long")
    return stats.agg(F.sum(part("$.numRecords")).alias("n"), F.min(part("$.minValues.o_orderkey")).alias("low"), F.max(part("$.maxValues.o_orderkey")).alias("high"), F.sum(part("$.nullCount.o_totalprice")).alias("nulls"), F.count(F.lit(1)).alias("files"))


@query("SELECT 3::BIGINT AS files, 0::BIGINT AS other_sizes")
def q_file_bytes(spark, sf_dir):
    """Sizes in the log against the files' bytes."""
    own = _parts(spark, sf_dir, 3)
    named = own.snapshot().file_table(spark).select(F.substring_index("path", "/", -1).alias("name"), "size")
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.parquet").load(own.path).select(F.substring_index("path", "/", -1).alias("name"), "length")
    return named.join(there, "name").agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("size") != F.col("length")).alias("other_sizes"))


@query("SELECT version::BIGINT AS version, 3::BIGINT AS actions FROM (VALUES (0), (1), (2), (3)) t(version)")
def q_commit_lines(spark, sf_dir):
    """Commits as the store lists and Spark reads them: create (info, protocol, metadata), then info, file and mark."""
    own = _parts(spark, sf_dir, 3)
    versions = own.store.list_commits(own.path)
    return commit_lines(spark, [own.store.log_path(own.path, commit_file(v)) for v in versions]).groupBy("version").agg(F.count(F.lit(1)).alias("actions"))


@query("SELECT 3::BIGINT AS latest, 4::BIGINT AS commits, 1::BIGINT AS first_from_3, TRUE AS absent_is_null, (-1)::BIGINT AS none")
def q_versions(spark, sf_dir):
    own, empty = _parts(spark, sf_dir, 3), scratch_table(spark)
    listed = own.store.list_commits(own.path)
    return report(spark, [(own.snapshot().version, len(listed), len(own.store.list_commits(own.path, 3)), own.store.read_commit(own.path, 9) is None, empty.snapshot().version)], "latest long, commits long, first_from_3 long, absent_is_null boolean, none long")


@query(f"WITH {SRC} {MERGED}")
def q_log_load(spark, sf_dir):
    """A table read from a snapshot that executors have replayed, commit by commit, after appends and a MERGE."""
    own = _parts(spark, sf_dir, 3)
    own.merge(changes(spark, sf_dir), ["o_orderkey"])
    return own.read(snapshots.load(spark, own.store, own.path, driver_commits=0))


@query(f"WITH {SRC} {MERGED}")
def q_log_load_after_checkpoint(spark, sf_dir):
    """The same on top of a checkpoint, whose files stay in Spark."""
    own = _parts(spark, sf_dir, 3, interval=2)
    own.merge(changes(spark, sf_dir), ["o_orderkey"])
    own.append(orders(spark, sf_dir).limit(0))
    return own.read(snapshots.load(spark, own.store, own.path, driver_commits=0))


@query("SELECT kind, n::BIGINT AS n FROM (VALUES ('add', 4), ('metaData', 1), ('protocol', 1), ('txn', 1)) t(kind, n)")
def q_checkpoint(spark, sf_dir):
    """Rows of the checkpoint that the fourth commit wrote."""
    own = _parts(spark, sf_dir, 4, interval=2)
    raw = spark.read.schema(ROW).parquet(own.store.checkpoint_path(own.path, 4))
    kind = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in ROW.names])
    return raw.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 4::BIGINT AS version, 7::BIGINT AS size, 9::BIGINT AS overwritten")
def q_checkpoint_pointer(spark, sf_dir):
    own = _parts(spark, sf_dir, 4, interval=2)
    found = snapshots.read_pointer(own.store, own.path)
    own.store.write_pointer(own.path, b'{"version": 9, "size": 1, "later": true}')
    return report(spark, [(found["version"], found["size"], snapshots.read_pointer(own.store, own.path)["version"])], "version long, size long, overwritten long")


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def q_corrupt_checkpoint(spark, sf_dir):
    """A pointer that cannot be read: the log is replayed from its start."""
    own = _parts(spark, sf_dir, 3, interval=2)
    own.store.write_pointer(own.path, b"{broken")
    return own.read()


@query("SELECT r_regionkey::BIGINT AS k, r_name AS name, 4::BIGINT AS version, 2::BIGINT AS removed FROM region")
def q_create_or_replace(spark, sf_dir):
    """A table is replaced: its files go, the next version has the new schema."""
    own = _parts(spark, sf_dir, 2)
    version = own.create_or_replace(T.StructType.fromDDL("k long, name string"))
    removed = sum(isinstance(a, RemoveFile) for a in parse(own.store.read_commit(own.path, version)))
    own.append(table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("k"), F.col("r_name").alias("name")))
    return own.read().select("k", "name", F.lit(own.snapshot().version).cast("long").alias("version"), F.lit(removed).cast("long").alias("removed"))


@query("SELECT name, outcome FROM (VALUES ('append', 'version 4'), ('append after a merge', 'version 6'), ('merge after an append', 'conflict'), ('same path', 'conflict'), ('same application', 'conflict'), ('metadata', 'conflict'), ('nothing', 'error'), ('no retries', 'conflict')) t(name, outcome)")
def q_commit_rules(spark, sf_dir):
    """Commits planned on an old snapshot: blind appends go to the next version, the rest conflicts where it must."""
    own = _parts(spark, sf_dir, 2)
    out = []

    def attempt(name, txn, operation="WRITE", retries=5):
        try:
            out.append((name, f"version {txn.commit(operation, retries=retries)}"))
        except CommitConflict:
            out.append((name, "conflict"))
        except ValueError:
            out.append((name, "error"))

    at = own.snapshot()
    path = next(iter(at.sizes(spark)))
    early, merged, blocked, hurried = (own.start(at) for _ in range(4))
    own.append(orders(spark, sf_dir).limit(1))
    attempt("append", early.add(AddFile("p1")))
    attempt("merge after an append", merged.add(AddFile("p2")), "MERGE")
    attempt("no retries", hurried.add(AddFile("p9")), retries=0)
    late = own.start().add(AddFile("p3"))
    own.start().add(RemoveFile(path, 1)).commit("MERGE")
    attempt("append after a merge", late)
    attempt("same path", blocked.add(RemoveFile(path, 1)))
    marked, renamed = own.start().add(SetTransaction("app", 9)), own.start().add(AddFile("p5"))
    own.start().add(SetTransaction("app", 8)).commit()
    attempt("same application", marked)
    own.start().add(own.snapshot().metadata).commit()
    attempt("metadata", renamed)
    attempt("nothing", own.start())
    return report(spark, out, "name string, outcome string")


@query("SELECT store, 1::BIGINT AS winners, 7::BIGINT AS conflicts, TRUE AS whole FROM (VALUES ('local'), ('hadoop')) t(store)")
def q_put_if_absent(spark, sf_dir):
    """Eight threads write one version: one wins, and what is read is whole."""
    out = []
    for name, store in (("local", LocalLogStore()), ("hadoop", HadoopLogStore(spark))):
        path, won, lost = scratch(spark), [], []

        def write(n, store=store, path=path, won=won, lost=lost):
            try:
                store.write_commit(path, 0, str(n).encode() * 1000)
                won.append(n)
            except CommitConflict:
                lost.append(n)

        many = [threading.Thread(target=write, args=(n,)) for n in range(8)]
        [t.start() for t in many]
        [t.join() for t in many]
        out.append((name, len(won), len(lost), store.read_commit(path, 0) == str(won[0]).encode() * 1000))
    return report(spark, out, "store string, winners long, conflicts long, whole boolean")


@query("SELECT 'app-' || p AS app, max(event_id) AS version FROM (SELECT user_id % 4 AS p, event_id FROM events) GROUP BY 1")
def q_latest_txn(spark, sf_dir):
    """The latest mark of each application, over several commits."""
    own = scratch_table(spark)
    e = table(spark, sf_dir, "events")
    half = e.agg(F.max("event_id")).first()[0] // 2
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        marks = e.where(part).groupBy((F.col("user_id") % 4).alias("p")).agg(F.max("event_id").alias("o")).collect()
        own.append(e.where(part).select("event_id").limit(3), [SetTransaction(f"app-{r['p']}", r["o"]) for r in marks])
    return report(spark, [(a, t.version) for a, t in own.snapshot().transactions.items()], "app string, version long")


@query("SELECT 2::BIGINT AS columns, TRUE AS same_id, 'WRITE' AS operation, 1::BIGINT AS reader, TRUE AS checkpoint_has_no_info")
def q_latest_metadata(spark, sf_dir):
    own = scratch_table(spark, interval=2)
    own.append(table(spark, sf_dir, "region").select("r_regionkey"))
    first = own.snapshot().metadata.id
    own.append(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    at = snapshots.read_checkpoint(spark, own.store, own.path, 2)
    own.append(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    now = own.snapshot()
    return report(spark, [(len(now.schema), now.metadata.id == first, now.commit_info.operation, now.protocol.minReaderVersion, at.commit_info is None)], "columns long, same_id boolean, operation string, reader long, checkpoint_has_no_info boolean")


@query("SELECT kind, whole FROM (VALUES ('add', TRUE), ('remove', TRUE), ('txn', TRUE), ('metaData', TRUE), ('protocol', TRUE), ('commitInfo', TRUE), ('unknown field', TRUE), ('unknown action', FALSE), ('no actions', FALSE)) t(kind, whole)")
def q_action_codec(spark, sf_dir):
    own = {"add": AddFile("a", {"p": "1"}, 5, 6, True, '{"numRecords":1}'), "remove": RemoveFile("b", 7), "txn": SetTransaction("app", 3, 9), "metaData": Metadata("id", "{}"), "protocol": Protocol(), "commitInfo": CommitInfo(1, "WRITE", {"k": "v"}, "e", True)}
    out = [(name, parse(serialise([a])) == [a] and json.loads(serialise([a])).keys() == {name}) for name, a in own.items()]
    out.append(("unknown field", parse(b'\n{"add":{"path":"x","later":1}}\n\n') == [AddFile("x")]))
    for name, f in (("unknown action", lambda: parse(b'{"other":{}}')), ("no actions", lambda: write_commit(LocalLogStore(), scratch(spark), 0, []))):
        try:
            f()
            out.append((name, True))
        except ValueError:
            out.append((name, False))
    return report(spark, out, "kind string, whole boolean")


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def q_row_iterator(spark, sf_dir):
    own = rows(spark, f"{sf_dir}/nation.parquet", T.StructType.fromDDL("n_nationkey int, n_name string"))
    return report(spark, [(r["n_nationkey"], r["n_name"]) for r in own], "n_nationkey long, n_name string")


@query("SELECT 32::BIGINT AS counted, 31::BIGINT AS bounded, count(*) AS n FROM orders")
def q_stats_leaves(spark, sf_dir):
    """Forty leaf columns, an array and a binary column: 32 are counted, and the binary one has no bounds."""
    wide = orders(spark, sf_dir).select(F.array("o_orderkey").alias("list"), F.col("o_orderstatus").cast("binary").alias("raw"), F.struct(*[(F.col("o_orderkey") + i).alias(f"c{i}") for i in range(20)]).alias("s"), *[(F.col("o_orderkey") * i).alias(f"d{i}") for i in range(20)])
    found = file_stats(wide, [F.lit(1).alias("g")])
    keys = lambda part: F.size(F.json_object_keys(F.get_json_object("stats", part))).cast("long")
    return found.select((keys("$.nullCount") + keys("$.nullCount.s") - 1).alias("counted"), (keys("$.minValues") + keys("$.minValues.s") - 1).alias("bounded"), F.col("num_records").alias("n"))


@query(f"WITH {CHG} SELECT o_orderkey, o_totalprice, o_orderstatus FROM chg QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_totalprice DESC, o_orderstatus DESC, _op DESC) = 1")
def q_dedup_ties(spark, sf_dir):
    """All changes of a key have one place in the order: the greatest row counts, on every run."""
    from ..operators.dedup import last_writer

    tied = changes(spark, sf_dir).withColumn("_seq", F.lit(0)).repartition(7)
    return last_writer(tied, ["o_orderkey"], ["_seq"]).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("SELECT updated, 1::BIGINT AS rewritten, 2::BIGINT AS skipped, total - updated AS copied FROM (SELECT count(*) FILTER (o_orderkey % 10 = 0) AS updated, count(*) AS total FROM orders WHERE o_orderkey < 500)")
def q_merge_file_counters(spark, sf_dir):
    own = scratch_table(spark)
    o = orders(spark, sf_dir)
    for low, high in ((0, 500), (500, 1000), (1000, 1 << 60)):
        own.append(o.where(F.col("o_orderkey").between(low, high - 1)).coalesce(1))
    source = o.where("o_orderkey < 500 AND o_orderkey % 10 = 0").withColumn("_op", F.lit("UPDATE")).withColumn("_seq", F.lit(1))
    r = own.merge(source, ["o_orderkey"])
    return report(spark, [(r.updated, r.files_rewritten, r.files_skipped, r.copied)], "updated long, rewritten long, skipped long, copied long")


@query("SELECT name, outcome FROM (VALUES ('last', 'version 1'), ('in between', 'error')) t(name, outcome)")
def q_empty_commit(spark, sf_dir):
    """A commit without content does not count while it is the last, and is an error once others follow."""
    own = _parts(spark, sf_dir, 1)
    out = []
    for name, versions in (("last", [2]), ("in between", [3])):
        for v in versions:
            own.store.write_commit(own.path, v, b"" if v == 2 else serialise([AddFile("x")]))
        try:
            out.append((name, f"version {own.snapshot().version}"))
        except snapshots.CorruptCommit:
            out.append((name, "error"))
    return report(spark, out, "name string, outcome string")
