"""What the text operators share: word rules, Arrow batches, and tables that cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the task: words are runs of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

#: Rows and bytes of an Arrow batch; long documents make ten thousand rows too many for a worker's memory.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20

_scratch: list[tuple[SparkSession, str]] = []


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough that a batch of long documents fits in a Python worker.

    A plan reads the setting when it runs, so it must last until then; a smaller bound that the session has stays.
    """
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(name, None)
        if not now or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Without spark.checkpoint.dir only a local session has one of its own:
    on a cluster, executors would each write to their own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed by ``release`` or at the end of the process."""
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: computed once, and no executor's loss undoes it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held() -> int:
    """How many tables ``cut`` has in the shared folder: a mark for ``release``."""
    return len(_scratch)


def release(since: int = 0, keep_last: bool = False) -> None:
    """Delete the tables written after the mark ``since``, but the last if ``keep_last``; results that still read them must
    have been written."""
    last = _scratch.pop() if keep_last and len(_scratch) > since else None
    while len(_scratch) > since:
        spark, path = _scratch.pop()
        try:
            if spark.sparkContext._jsc is None:
                continue
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
        except Exception:  # the session has ended: nothing left to ask
            continue
    if last:
        _scratch.append(last)


atexit.register(release)


def crc_text(column: Column) -> Column:
    """Unsigned CRC-32 of a value's text; a null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def chunks(texts: list[bytes | None], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``limit`` bytes each; a longer text is a range of its own."""
    start = total = 0
    for i, text in enumerate(texts):
        size = len(text or b"")
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(texts) > start:
        yield start, len(texts)


def text_chunks(batch: pa.RecordBatch, name: str, limit: int) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of parts of a batch with about ``limit`` bytes each; a longer text is a part of its own."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column if pa.types.is_string(column.type) else column.cast(pa.string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64))
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield start, column.slice(start, stop - start)
        start = stop


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    """A record batch with the types of ``schema`` from lists or arrays."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z lowered. ``bytes.split`` and ``bytes.lower`` know ASCII only, as the rule asks."""
    return (text or b"").lower().split()
