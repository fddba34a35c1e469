"""Checkpoints: a snapshot in one Parquet file, and the pointer to it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .actions import ROW, to_row
from .snapshot import Snapshot
from .store import LogStore

INTERVAL = 10


def write(spark: SparkSession, store: LogStore, table: str, snapshot: Snapshot) -> int:
    """Write the checkpoint of a snapshot and point to it; the number of its rows.

    It holds protocol, metadata, active files and transactions, but no removed files and no commit info. The files go
    from the snapshot's table to the checkpoint without passing the driver.
    """
    small = spark.createDataFrame([to_row(a) for a in snapshot.small_actions()], ROW)
    files = snapshot.file_table(spark).select(F.struct(*ROW["add"].dataType.names).alias("add"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in ROW.fields if f.name != "add"])
    draft = f"{table.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    target = store.checkpoint_path(table, snapshot.version)
    try:
        small.unionByName(files).coalesce(1).write.parquet(draft)
        size = spark.read.schema(ROW).parquet(draft).count()
        name = next(n for n, _ in store.list_files(draft) if n.endswith(".parquet"))
        if not store.exists(target):
            store.move(f"{draft}/{name}", target)
    finally:
        store.delete(draft)
    store.write_pointer(table, json.dumps({"version": snapshot.version, "size": size}).encode())
    return size
