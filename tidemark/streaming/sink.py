"""The sink: micro-batches of change records or plain records to tables, exactly once."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..catalog import Catalog, CatalogSync
from ..config import Config
from ..functions.cdc import DELETE
from ..functions.names import app_id, table_name
from ..log.actions import SetTransaction
from ..log.snapshot import Snapshot
from ..log.store import CommitConflict
from ..metrics import Metrics
from ..operators.dedup import after_offsets, greatest_offsets
from ..operators.records import Converted, RecordConverter, converter
from ..table import Table

log = logging.getLogger(__name__)


class Retriable(RuntimeError):
    """A batch that may succeed if it is run again."""


class RejectedRecords(ValueError):
    """Records that cannot be converted, and no place to put them."""


@dataclass
class TableSink:
    """Writes batches (columns topic, partition, offset, value, and what the converter reads) to one table a topic.

    The commit that holds a batch's rows also holds, for each partition, its greatest offset, records that were skipped
    included. Records at or below the offsets in the table are dropped, so a batch that is run again, by Spark or by
    another process, changes nothing. Whatever the converter yields, deletions only pass where the settings let them.
    """

    spark: SparkSession
    config: Config
    converter: Callable[[str], RecordConverter]
    metrics: Metrics = field(default_factory=Metrics)
    catalog: CatalogSync | None = None

    def __post_init__(self) -> None:
        for key, value in self.config.hadoop_options().items():
            self.spark.conf.set(key, value)

    @classmethod
    def configured(cls, spark: SparkSession, config: Config, schemas: Mapping[str, T.StructType | dict], metrics: Metrics | None = None, catalog: Catalog | None = None) -> TableSink:
        """A sink whose converters, deletions, blob store and catalog follow the settings. ``schemas`` has the schema of
        each topic's values, as a Spark type or as a record's JSON schema block."""
        made = {topic: converter(own, str(config["write.mode"]), str(config["cdc.envelope.format"]), config.deletes) for topic, own in schemas.items()}
        sync = CatalogSync(catalog, int(config["catalog.sync.interval.ms"]) / 1000) if catalog and config["catalog.enabled"] else None
        return cls(spark, config, made.__getitem__, metrics or Metrics(), sync)

    def read_options(self) -> dict[str, str]:
        """Options of a stream of records that keep a micro-batch at merge.batch.size records."""
        return {"maxOffsetsPerTrigger": str(self.config["merge.batch.size"])}

    def read_stream(self, source: str = "kafka", **options: str) -> DataFrame:
        """A stream of records, in batches of the configured size."""
        return self.spark.readStream.format(source).options(**self.read_options(), **options).load()

    def table(self, topic: str) -> Table:
        name = table_name(str(self.config["table.name"]), topic)
        return Table(self.spark, f"{str(self.config['storage.path']).rstrip('/')}/{name}", interval=int(self.config["checkpoint.interval"]))

    def process(self, batch: DataFrame, batch_id: int = 0) -> None:
        """One micro-batch: offsets are filtered and rows written topic by topic. For ``foreachBatch``."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = {r["topic"]: r["n"] for r in batch.groupBy("topic").agg(F.count(F.lit(1)).alias("n")).collect()}
            for topic in sorted(counts):
                self.metrics.count("records.received", topic, counts[topic])
                self._flush(topic, batch.where(F.col("topic") == topic), batch_id)
        except (CommitConflict, OSError) as e:
            raise Retriable(str(e)) from e
        finally:
            batch.unpersist()

    def committed_offsets(self, topic: str) -> dict[int, int]:
        """The greatest offset in the table of each partition."""
        return _offsets(topic, self.table(topic).snapshot())

    def _flush(self, topic: str, records: DataFrame, batch_id: int) -> None:
        table, evolution = self.table(topic), bool(self.config["schema.evolution"])
        before = table.snapshot()
        known = [(topic, p, o) for p, o in _offsets(topic, before).items()]
        fresh = after_offsets(records, self.spark.createDataFrame(known, "topic string, partition long, offset long"))
        offsets = greatest_offsets(fresh).collect()  # one row a partition
        if not offsets:
            return
        where = {"topic": topic, "partition": ",".join(str(r["partition"]) for r in offsets), "table": table.path}
        converted = self.converter(topic).convert(fresh)
        judged = converted.judged.persist(StorageLevel.MEMORY_AND_DISK)  # each record is converted once
        try:
            with self.metrics.timed("flush.latency", topic):
                rows = converted.rows if self.config.deletes else converted.rows.where(F.col("_op") != DELETE)
                tally = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
                self._reject(topic, converted, batch_id)
                rows = rows.drop("topic", "partition", "offset")
                marks = [SetTransaction(app_id(topic, r["partition"]), r["offset"], int(table.clock() * 1000)) for r in offsets]
                if self.config["write.mode"] == "append":
                    version = table.append(rows.drop("_op", "_seq"), marks, evolution)
                else:
                    result = table.merge(rows, list(self.config["merge.keys"]), marks, evolution)
                    version = result.version
                    for name, n in (("inserted", result.inserted), ("updated", result.updated), ("deleted", result.deleted), ("files.rewritten", result.files_rewritten), ("files.skipped", result.files_skipped)):
                        self.metrics.count(f"merge.{name}", topic, n)
                self.metrics.count("records.converted", topic, tally)
                self.metrics.count("records.flushed", topic, tally)
                self.metrics.gauge("commit.version", topic, version)
                if before.metadata and before.metadata.schemaString != table.schema_text:
                    self.metrics.count("schema.evolutions", topic)
        finally:
            judged.unpersist()
        log.info("flushed %s", where, extra=where | {"version": version})
        if self.catalog:
            parts = [str(self.config["catalog.name"]), str(self.config["catalog.schema"]), table_name(str(self.config["table.name"]), topic)]
            self.catalog.committed(".".join(p for p in parts if p), table.path)

    def _reject(self, topic: str, converted: Converted, batch_id: int) -> None:
        """Rejected records go to the dead-letter folder of topic and batch; without one they stop the batch."""
        first = converted.rejects.agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("error")).first()
        if not first["n"]:
            return
        path = str(self.config["dead.letter.path"])
        if not path:
            raise RejectedRecords(f"{topic}: {first['error']}")
        converted.rejects.write.mode("overwrite").parquet(f"{path.rstrip('/')}/topic={topic}/batch={batch_id}")
        self.metrics.count("records.dlq", topic, first["n"])

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        """Run on a stream; its trigger is the configured interval, or all that is there and then the end."""
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{self.config['merge.interval.ms']} milliseconds").start()


def _offsets(topic: str, at: Snapshot) -> dict[int, int]:
    """Offsets by partition: a topic's applications end in a number after its name, so 'a' is not 'a:b'."""
    own = re.compile(re.escape(app_id(topic, 0)[:-1]) + r"(\d+)")
    return {int(m[1]): t.version for a, t in at.transactions.items() if (m := own.fullmatch(a))}
