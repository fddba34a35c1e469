"""Tables: Parquet files under a root path, and the log that says which of them count."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schema as schemas
from .functions.cdc import DELETE
from .log import snapshot as snapshots
from .log.actions import Action, AddFile, Metadata, Protocol, RemoveFile
from .log.store import LogStore, store_for
from .log.txn import Transaction
from .operators import merge as merging
from .operators.dedup import last_writer
from .operators.prune import bounds_of, may_match
from .operators.stats import file_stats
from .sources.parquet import scan

ROW_GROUP_BYTES = 128 << 20


@dataclass(frozen=True)
class MergeResult:
    """What a MERGE did, and its actions."""

    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    copied: int = 0
    files_rewritten: int = 0
    files_created: int = 0
    files_skipped: int = 0
    actions: tuple[Action, ...] = ()
    version: int = -1


class Table:
    """A table by its root path; opening it reads nothing."""

    def __init__(self, spark: SparkSession, path: str, store: LogStore | None = None, clock: Callable[[], float] = time.time, interval: int = 10) -> None:
        self.spark, self.path, self.clock, self.interval = spark, path.rstrip("/"), clock, interval
        self.store = store or store_for(spark, path)
        self.schema_text: str | None = None  # as of the last write

    # -- reading

    def snapshot(self) -> snapshots.Snapshot:
        return snapshots.load(self.spark, self.store, self.path)

    def absolute(self, path: str) -> str:
        return path if "://" in path or path.startswith("/") else f"{self.path}/{path}"

    def read(self, at: snapshots.Snapshot | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """The active files' rows in the table's schema; old files' narrower types and missing columns are filled in."""
        at = at or self.snapshot()
        if at.schema is None:
            return self.spark.createDataFrame([], T.StructType([]))
        schema = at.schema if columns is None else T.StructType([at.schema[c] for c in columns])
        return scan(self.spark, [self.absolute(p) for p in at.sizes(self.spark)], schema)

    # -- transactions

    def start(self, at: snapshots.Snapshot | None = None) -> Transaction:
        return Transaction(self.spark, self.store, self.path, at or self.snapshot(), self.clock, self.interval)

    def _now(self) -> int:
        return int(self.clock() * 1000)

    def create_or_replace(self, schema: T.StructType, partition_columns: Sequence[str] = (), configuration: dict | None = None, name: str | None = None) -> int:
        """A new table at version 0, or an existing one with a new schema and no files at its next version."""
        at = self.snapshot()
        txn = self.start(at).add(Protocol(), Metadata(str(uuid.uuid4()), schemas.to_json(schema), name, partitionColumns=list(partition_columns), configuration=configuration or {}, createdTime=self._now()))
        txn.add(*[RemoveFile(p, self._now(), True, size=size) for p, size in at.sizes(self.spark).items()])
        return txn.commit("CREATE TABLE" if at.version < 0 else "REPLACE TABLE")

    def evolve(self, at: snapshots.Snapshot, incoming: T.StructType, enabled: bool = True) -> Metadata | None:
        """New metadata if the schema has to grow; id, partition columns and configuration are carried over."""
        grown = schemas.merge(at.schema, incoming)
        if not grown.changed:
            return None
        if not enabled:
            raise schemas.IncompatibleSchema("the schema would have to change, and evolution is off")
        old = at.metadata
        return Metadata(old.id, schemas.to_json(grown.schema), old.name, old.description, old.format, old.partitionColumns, old.configuration, old.createdTime)

    # -- writing files

    def write_files(self, df: DataFrame) -> tuple[list[AddFile], int]:
        """Write rows to new data files with statistics: (add actions, rows). A failure leaves nothing behind.

        The executors write into a folder of this write's own, where the files stay: nothing is moved. Statistics read
        the leaf columns that have them, and no others, in one aggregation by file.
        """
        folder = f"data-{uuid.uuid4().hex}"
        place = f"{self.path}/{folder}"
        try:
            df.write.option("compression", "snappy").option("parquet.block.size", ROW_GROUP_BYTES).parquet(place)
            files = [(n, size) for n, size in self.store.list_files(place) if n.endswith(".parquet")]
            found = {}
            if files:
                written = scan(self.spark, [f"{place}/{n}" for n, _ in files], df.schema)
                found = {r["file"]: r for r in file_stats(written, [F.col("_metadata.file_name").alias("file")]).collect()}
        except BaseException:
            self.store.delete(place)
            raise
        if not found:
            self.store.delete(place)
        # A file without rows has no statistics and is left out.
        adds = [AddFile(f"{folder}/{n}", {}, size, self._now(), True, found[n]["stats"]) for n, size in files if n in found]
        return adds, sum(r["num_records"] for r in found.values())

    def _settled(self, incoming: T.StructType, evolution: bool) -> tuple[snapshots.Snapshot, Metadata | None, T.StructType]:
        """The snapshot to write on, after a table that is missing was made; new metadata if the schema grows; the schema."""
        at = self.snapshot()
        if at.metadata is None:
            self.create_or_replace(incoming)
            at = self.snapshot()
        grown = self.evolve(at, incoming, evolution)
        self.schema_text = (grown or at.metadata).schemaString
        return at, grown, schemas.from_json(self.schema_text)

    def append(self, df: DataFrame, extra: Sequence[Action] = (), evolution: bool = True) -> int:
        """Append rows, growing the schema if allowed; ``extra`` actions go into the same commit."""
        at, grown, schema = self._settled(schemas.nullable(df.schema), evolution)
        adds, _ = self.write_files(schemas.project(df, schema))
        txn = self.start(at).add(*([grown] if grown else []), *adds, *extra)
        return txn.commit("WRITE", {"mode": "Append"}) if txn.actions else at.version

    # -- merging

    def plan_merge(self, source: DataFrame, keys: Sequence[str], at: snapshots.Snapshot, schema: T.StructType | None = None) -> MergeResult:
        """Merge ``source`` (columns, _op, _seq) into the files of a snapshot, without committing.

        The last writer of each key counts. Statistics skip files, one join on the keys finds the matches in the others,
        and only files with a match are rewritten; the rest of the source is inserted.
        """
        schema = schema or at.schema
        merging.check_keys(schema, keys)
        src = last_writer(source, keys, ["_seq"]).drop("_seq")
        src = schemas.project(src, T.StructType([*schema.fields, T.StructField(merging.OP, T.StringType())])).persist(StorageLevel.MEMORY_AND_DISK)
        found = None
        try:
            counted, bounds = bounds_of(src, keys)
            if not counted:
                return MergeResult()
            total, candidates = self._candidates(at, bounds, schema)
            adds: list[AddFile] = []
            removes: list[RemoveFile] = []
            copied = updated = deleted = 0
            fresh = src.where(F.col(merging.OP) != DELETE).drop(merging.OP)
            if candidates:
                # One pass over the keys of the files that may match tells which do, what happens to their rows, and
                # which source keys are left to insert; only files with a match are read whole.
                named = scan(self.spark, [self.absolute(p) for p in candidates], schema).withColumn("__file", F.col("_metadata.file_path"))
                found = merging.matches(named, src, keys, "__file").persist(StorageLevel.MEMORY_AND_DISK)
                tally = found.groupBy("__file").agg(F.count_if(F.col(merging.OP) != DELETE).alias("updated"), F.count_if(F.col(merging.OP) == DELETE).alias("deleted")).collect()
                hit = {_tail(unquote(r["__file"])) for r in tally}
                updated, deleted = (sum(r[c] for r in tally) for c in ("updated", "deleted"))
                rewritten = [p for p in candidates if _tail(self.absolute(p)) in hit]
                if rewritten:
                    new, kept = self.write_files(merging.rewrite(scan(self.spark, [self.absolute(p) for p in rewritten], schema), src, keys))
                    copied = kept - updated
                    adds += new
                    removes = [RemoveFile(p, self._now(), True, size=candidates[p]) for p in rewritten]
                fresh = merging.unmatched(src, found, keys, schema.names)
            more, inserted = self.write_files(fresh)
            adds += more
            return MergeResult(inserted, updated, deleted, copied, len(removes), len(adds), total - len(candidates), (*removes, *adds))
        finally:
            src.unpersist()
            if found is not None:
                found.unpersist()

    def _candidates(self, at: snapshots.Snapshot, bounds: dict, schema: T.StructType) -> tuple[int, dict[str, int]]:
        """(active files, path and bytes of those that statistics do not skip); the statistics stay in Spark."""
        keep = may_match(F.col("stats"), bounds, schema)
        row = at.file_table(self.spark).agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.when(keep, F.struct("path", "size"))).alias("kept")).first()
        return row["n"], {r["path"]: r["size"] for r in row["kept"]}

    def merge(self, source: DataFrame, keys: Sequence[str], extra: Sequence[Action] = (), evolution: bool = True) -> MergeResult:
        """MERGE and commit; ``extra`` actions go into the same commit."""
        incoming = schemas.nullable(T.StructType([f for f in source.schema.fields if f.name not in (merging.OP, "_seq")]))
        at, grown, schema = self._settled(incoming, evolution)
        result = self.plan_merge(source, keys, at, schema)
        txn = self.start(at).add(*([grown] if grown else []), *result.actions, *extra)
        version = txn.commit("MERGE", {"matchedPredicates": json.dumps(list(keys))}) if txn.actions else at.version
        return replace(result, version=version)


def _tail(path: str) -> tuple[str, ...]:
    """Folder and name of a file, which tell the files of a table apart however its root is spelt."""
    return tuple(path.rsplit("/", 2)[-2:])
