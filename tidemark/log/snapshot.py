"""Snapshots: the state that a table's log adds up to."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as schemas
from ..functions.names import commit_file
from ..sources.parquet import commit_lines
from .actions import INFO, ROW, Action, AddFile, CommitInfo, Metadata, Protocol, RemoveFile, SetTransaction, as_dict, from_dict, from_row, parse
from .store import LogStore

log = logging.getLogger(__name__)
#: Commits after the checkpoint that are replayed on the driver; a longer tail is replayed by the executors.
DRIVER_COMMITS = 32
_ADD = ROW["add"].dataType


class BadPointer(ValueError):
    """A checkpoint pointer that cannot be read."""


class CorruptCommit(ValueError):
    """A commit without content that others follow."""


@dataclass
class Snapshot:
    """The table at a version; version -1 is a table without commits.

    Active files are those of ``base``, a table of add actions that stays in Spark, and those of ``tail``, what the
    commits since say of a path: its action, or None where it was removed.
    """

    version: int = -1
    metadata: Metadata | None = None
    protocol: Protocol | None = None
    transactions: dict[str, SetTransaction] = field(default_factory=dict)
    commit_info: CommitInfo | None = None
    base: DataFrame | None = None
    tail: dict[str, AddFile | None] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType | None:
        return schemas.from_json(self.metadata.schemaString) if self.metadata else None

    def apply(self, actions: Iterable[Action]) -> Snapshot:
        """Apply actions in order: the last one of a path, an application or a kind counts."""
        for action in actions:
            if isinstance(action, AddFile):
                self.tail[action.path] = action
            elif isinstance(action, RemoveFile):
                self.tail[action.path] = None
            elif isinstance(action, Metadata):
                self.metadata = action
            elif isinstance(action, Protocol):
                self.protocol = action
            elif isinstance(action, SetTransaction):
                self.transactions[action.appId] = action
            elif isinstance(action, CommitInfo):
                self.commit_info = action
        return self

    def committed(self, app: str) -> int | None:
        return self.transactions[app].version if app in self.transactions else None

    def file_table(self, spark: SparkSession) -> DataFrame:
        """The add actions of the active files, as a table."""
        own = spark.createDataFrame([as_dict(a) for a in self.tail.values() if a is not None], _ADD)
        if self.base is None:
            return own
        if not self.tail:
            return self.base
        # The tail is what the driver has read of a few commits.
        touched = spark.createDataFrame([(p,) for p in self.tail], "path string")
        return self.base.join(F.broadcast(touched), "path", "left_anti").select(*_ADD.names).unionByName(own)

    def sizes(self, spark: SparkSession) -> dict[str, int]:
        """Path and bytes of each active file."""
        if self.base is None:
            return {p: a.size for p, a in self.tail.items() if a is not None}
        return {r["path"]: r["size"] for r in self.file_table(spark).select("path", "size").collect()}

    @cached_property
    def files(self) -> dict[str, AddFile]:
        """All active files with their statistics, on the driver; MERGE and scans do without."""
        if self.base is None:
            return {p: a for p, a in self.tail.items() if a is not None}
        return {r["path"]: from_dict("add", r.asDict(recursive=True)) for r in self.file_table(self.base.sparkSession).collect()}

    def small_actions(self) -> list[Action]:
        """What a checkpoint holds besides the files."""
        return [a for a in (self.protocol, self.metadata) if a is not None] + list(self.transactions.values())


def read_pointer(store: LogStore, table: str) -> dict | None:
    data = store.read_pointer(table)
    if data is None:
        return None
    try:
        own = json.loads(data)
        return {"version": int(own["version"]), "size": int(own["size"]), "parts": own.get("parts")}
    except (ValueError, KeyError, TypeError) as e:
        raise BadPointer(str(e)) from e


def read_checkpoint(spark: SparkSession, store: LogStore, table: str, version: int) -> Snapshot:
    """The snapshot that a checkpoint holds: its files stay in Spark, the rest (a row per application) comes here."""
    raw = spark.read.schema(ROW).parquet(store.checkpoint_path(table, version))
    small = [from_row(r) for r in raw.where("add is null and remove is null").collect()]
    return Snapshot(version, base=raw.where("add is not null").select("add.*")).apply(small)


def replay(actions: DataFrame) -> DataFrame:
    """Active files of a table of file actions (version, line, path, is_add): the last action of a path counts.

    One row of a path leaves each task.
    """
    last = actions.groupBy("path").agg(F.max_by("is_add", F.struct("version", "line")).alias("is_add"), F.max("version").alias("version"))
    return last.where("is_add").select("path", "version")


def replay_commits(spark: SparkSession, store: LogStore, table: str, versions: list[int], base: Snapshot) -> Snapshot:
    """``base`` and the commits ``versions``, replayed by the executors; for logs of any length."""
    lines = commit_lines(spark, [store.log_path(table, commit_file(v)) for v in versions])
    read = lines.select("version", "line", F.from_json("action", T.StructType([*ROW.fields, T.StructField("commitInfo", INFO)])).alias("a")).select("version", "line", "a.*")
    at = F.struct("version", "line")
    kinds = ("metaData", "protocol", "commitInfo")
    known = F.greatest(*[F.col(n).isNotNull().cast("int") for n in [*ROW.names, "commitInfo"]])
    last = read.agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), at)).alias(n) for n in kinds], F.max("version").alias("version"), F.count_if(known == 0).alias("unknown")).first()
    if last["unknown"]:
        raise ValueError(f"{last['unknown']} unknown actions in the log of {table}")
    out = Snapshot(max([base.version, *versions]), base.metadata, base.protocol, dict(base.transactions), base.commit_info)
    out.apply([from_dict(n, last[n].asDict(recursive=True)) for n in kinds if last[n] is not None])
    marks = read.where("txn is not null").groupBy("txn.appId").agg(F.max_by("txn", at).alias("txn")).collect()  # one row an application
    out.apply([from_dict("txn", r["txn"].asDict()) for r in marks])
    path = F.coalesce("add.path", "remove.path")
    # A path's removal and addition in one commit stand on different lines; the later one counts.
    latest = read.where("add is not null or remove is not null").groupBy(path.alias("p")).agg(F.max_by(F.struct("add"), at).alias("x"))
    if base.base is None:
        out.base = latest.where("x.add is not null").select("x.add.*")
    else:
        touched = latest.select("p", "x.add")
        old = base.base.join(touched.select(F.col("p").alias("path")), "path", "left_anti").select(*_ADD.names)
        out.base = old.unionByName(touched.where("add is not null").select("add.*"))
    return out


def load(spark: SparkSession, store: LogStore, table: str, driver_commits: int = DRIVER_COMMITS) -> Snapshot:
    """The latest snapshot: the checkpoint that the pointer names, if it can be read, and the commits after it.

    Commits that are missing in between are passed over; without a checkpoint the log is replayed from its start. A last
    commit without content is one that its writer has not finished, and does not count; elsewhere it is an error.
    """
    snapshot, start = Snapshot(), 0
    try:
        pointer = read_pointer(store, table)
        if pointer is not None:
            snapshot = read_checkpoint(spark, store, table, pointer["version"])
            start = pointer["version"] + 1
    except Exception as e:  # a checkpoint only shortens the way
        log.warning("checkpoint of %s unusable, replaying all: %s", table, str(e)[:200])
    versions = store.list_commits(table, start)
    if len(versions) > driver_commits:
        if not (store.read_commit(table, versions[-1]) or b"").strip():
            versions.pop()
        return replay_commits(spark, store, table, versions, snapshot)
    for version in versions:
        data = store.read_commit(table, version)
        if data is None:
            continue
        if not data.strip():
            if version == versions[-1]:
                break
            raise CorruptCommit(f"commit {version} of {table} is empty")
        snapshot.apply(parse(data))
        snapshot.version = version
    return snapshot
