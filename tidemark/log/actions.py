"""Log actions: one JSON object a line, one key an object."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field, fields

from pyspark.sql import types as T


@dataclass
class AddFile:
    path: str
    partitionValues: dict = field(default_factory=dict)
    size: int = 0
    modificationTime: int = 0
    dataChange: bool = True
    stats: str | None = None
    tags: dict | None = None


@dataclass
class RemoveFile:
    path: str
    deletionTimestamp: int | None = None
    dataChange: bool = True
    extendedFileMetadata: bool | None = None
    partitionValues: dict | None = None
    size: int | None = None


@dataclass
class Metadata:
    id: str
    schemaString: str
    name: str | None = None
    description: str | None = None
    format: dict = field(default_factory=lambda: {"provider": "parquet", "options": {}})
    partitionColumns: list = field(default_factory=list)
    configuration: dict = field(default_factory=dict)
    createdTime: int | None = None


@dataclass
class Protocol:
    minReaderVersion: int = 1
    minWriterVersion: int = 2
    readerFeatures: list | None = None
    writerFeatures: list | None = None


@dataclass
class SetTransaction:
    appId: str
    version: int
    lastUpdated: int | None = None


@dataclass
class CommitInfo:
    timestamp: int | None = None
    operation: str | None = None
    operationParameters: dict | None = None
    engineInfo: str | None = None
    isBlindAppend: bool | None = None


#: The log's names of the actions.
KINDS = {"add": AddFile, "remove": RemoveFile, "metaData": Metadata, "protocol": Protocol, "txn": SetTransaction, "commitInfo": CommitInfo}
_NAMES = {kind: name for name, kind in KINDS.items()}
Action = AddFile | RemoveFile | Metadata | Protocol | SetTransaction | CommitInfo


def as_dict(action: Action) -> dict:
    """An action's fields that are set."""
    return {f.name: v for f in fields(action) if (v := getattr(action, f.name)) is not None}


def from_dict(name: str, values: dict) -> Action:
    """Fields that are not known are ignored; an action that is not known is an error."""
    if name not in KINDS:
        raise ValueError(f"unknown action '{name}'")
    kind = KINDS[name]
    known = {f.name for f in fields(kind)}
    return kind(**{k: v for k, v in values.items() if k in known and v is not None})


def serialise(actions: Iterable[Action]) -> bytes:
    return "".join(json.dumps({_NAMES[type(a)]: as_dict(a)}, separators=(",", ":"), ensure_ascii=False) + "\n" for a in actions).encode()


def parse(data: bytes) -> list[Action]:
    found = []
    for line in data.decode().splitlines():
        if line.strip():
            for name, values in json.loads(line).items():
                found.append(from_dict(name, values))
    return found


_TEXTS = T.MapType(T.StringType(), T.StringType())
_NAMES_LIST = T.ArrayType(T.StringType())


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


#: One row of a checkpoint, or one line of a commit: exactly one of the columns is set.
ROW = _struct(
    add=_struct(path=T.StringType(), partitionValues=_TEXTS, size=T.LongType(), modificationTime=T.LongType(), dataChange=T.BooleanType(), stats=T.StringType(), tags=_TEXTS),
    remove=_struct(path=T.StringType(), deletionTimestamp=T.LongType(), dataChange=T.BooleanType(), extendedFileMetadata=T.BooleanType(), partitionValues=_TEXTS, size=T.LongType()),
    metaData=_struct(id=T.StringType(), name=T.StringType(), description=T.StringType(), format=_struct(provider=T.StringType(), options=_TEXTS), schemaString=T.StringType(), partitionColumns=_NAMES_LIST, configuration=_TEXTS, createdTime=T.LongType()),
    protocol=_struct(minReaderVersion=T.IntegerType(), minWriterVersion=T.IntegerType(), readerFeatures=_NAMES_LIST, writerFeatures=_NAMES_LIST),
    txn=_struct(appId=T.StringType(), version=T.LongType(), lastUpdated=T.LongType()),
)
#: What a line of a commit may hold besides.
INFO = _struct(timestamp=T.LongType(), operation=T.StringType(), operationParameters=_TEXTS, engineInfo=T.StringType(), isBlindAppend=T.BooleanType())


def to_row(action: Action) -> dict:
    return {n: (as_dict(action) if _NAMES[type(action)] == n else None) for n in ROW.names}


def from_row(row) -> Action:
    for name in ROW.names:
        if row[name] is not None:
            return from_dict(name, row[name].asDict(recursive=True))
    raise ValueError("a checkpoint row without an action")
