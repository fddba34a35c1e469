"""Token identifiers in ORC files.

Documents are dealt to files by ranges of their id and sorted in them, so files and rows follow ascending id. A row
holds the id, the number of token ids before it in its file, and its token ids. ORC writes whole numbers in run
lengths (RLE v2), keeps least and greatest values in stripe footers and row indexes, and Bloom filters on the id:
stripes are read in parallel, and a search for some ids skips the others' stripes and row groups.
"""

from __future__ import annotations

import array
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, cut, new_path, record_batch, text_chunks

#: Fixed by the task.
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: Pieces of text whose token ids a worker remembers.
MEMORY_PIECES = 800_000
#: ORC: bytes of a stripe, rows of a row group, share of false positives of the Bloom filters.
STRIPE_BYTES = 64 << 20
GROUP_ROWS = 1000
BLOOM_FPP = 0.01

FILE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

#: Fixed value: the published pre-tokenizer pattern of byte-level BPE.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Two white-space characters of which the second is a blank: there, a cut before a blank may split a piece. Spelt out, as
#: Arrow's patterns know ASCII white space only.
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = _SPACES + " "
#: Text (bytes) that is encoded at once.
CHUNK_BYTES = 8 << 20


def byte_letters() -> dict[int, int]:
    """The published map of bytes to printable characters of byte-level BPE: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


class PieceEncoder:
    """Encodes whole texts with a tokenizer of the tokenizers library; frequent pieces are encoded once.

    No piece of the pre-tokenizer has a blank after a character that is not white space, so a text may be cut
    before such blanks and its parts encoded on their own. Parts' ids are remembered, as bytes of little-endian
    unsigned 32-bit numbers. A text with special tokens or blanks after white space goes to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        before = config.get("pre_tokenizer") or {}
        self.cuttable = config.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        self.special = [t["content"] for t in config.get("added_tokens") or ()]
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def part(self, text: str) -> bytes:
        """The ids of one part: its pieces by the library's model, or the library's whole way for rare letters."""
        if text and max(text) > "ɏ":
            return self.whole(text)
        ids: list[int] = []
        for piece in PIECES.findall(text):
            ids += [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        return array.array("I", ids).tobytes()

    def _ids(self, known: dict[str, bytes], parts: list[str], blank: str) -> list[bytes]:
        """Ids of distinct parts, remembered as far as there is room."""
        out = list(map(known.get, parts))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            out[i] = self.part(blank + parts[i])
            if len(known) < MEMORY_PIECES:
                known[parts[i]] = out[i]
        return out

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); ``end`` follows each text, a null is empty.

        All texts are cut at once and each distinct part is looked up once; the texts' ids are then gathered as numbers.
        """
        n, texts = len(texts), pc.fill_null(texts, "")
        odd = np.ones(n, dtype=bool)
        if self.cuttable and n:
            odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False).copy()
            for special in self.special:
                odd |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        lists = pc.split_pattern(plain, " ")
        counts = np.zeros(n, dtype=np.int64)
        counts[~odd] = pc.list_value_length(lists).to_numpy()
        parts = pc.list_flatten(lists)
        starts = (np.cumsum(counts[~odd]) - counts[~odd]).astype(np.int64)
        later = np.ones(len(parts), dtype=bool)
        later[starts] = False
        coded = parts.filter(pa.array(later)).dictionary_encode()
        # Entries: distinct later parts, each cut text's first part, each other text whole, and the end.
        wholes = [self.whole(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        entries = [*self._ids(self.later, coded.dictionary.to_pylist(), " "), *self._ids(self.first, parts.take(pa.array(starts)).to_pylist(), ""), *wholes, np.array([end], dtype="<u4").tobytes()]
        lengths = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // 4
        first_part, whole = len(coded.dictionary), len(coded.dictionary) + len(starts)
        # The entries of each text, with the end.
        per_text = np.where(odd, 1, counts) + 1
        stops = np.cumsum(per_text)
        order = np.empty(int(stops[-1]) if n else 0, dtype=np.int64)
        order[stops - 1] = len(entries) - 1
        begins = stops - per_text
        order[begins[odd]] = whole + np.arange(int(odd.sum()))
        order[begins[~odd]] = first_part + np.arange(len(starts))
        middle = np.ones(len(order), dtype=bool)
        middle[stops - 1] = middle[begins] = False
        order[middle] = coded.indices.to_numpy()
        sizes = lengths[order]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        # Where each entry's ids lie, for each id: a chunk's numbers fit 32 bits unless one text is very long.
        kind = np.int32 if max(total, int(lengths.sum())) < 1 << 31 else np.int64
        at = np.repeat(((np.cumsum(lengths) - lengths)[order] - (ends - sizes)).astype(kind), sizes)
        at += np.arange(total, dtype=kind)
        ids = np.frombuffer(b"".join(entries), dtype="<u4")[at]
        return ids, np.add.reduceat(sizes, begins) if n else np.empty(0, np.int64)


_encoders: dict[str, PieceEncoder] = {}


def encoder(name: str) -> PieceEncoder:
    """A worker's encoder: ``name`` is a path, or the name of a public vocabulary installed on every machine."""
    if name not in _encoders:
        path = name
        if "/" not in name:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _encoders[name] = PieceEncoder(path)
    return _encoders[name]


def write_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Encode every whole text and write ORC files in ascending id order; nulls are empty texts, null ids come first.

    Ties of the id are ordered by a hash of the text and then by input place, so that rows of one id may fill
    several files; repeated rows stay; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.field("element", pa.int32(), nullable=False)))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, before = encoder(vocabulary), 0
        for batch in batches:
            for first, texts in text_chunks(batch, "t", CHUNK_BYTES):
                flat, sizes = own.encode(texts, end_id)
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int32)), type=schema.field("ids").type)
                yield record_batch(schema, [batch.column(0).slice(first, len(texts)), pa.array(before + offsets[:-1]), ids])
                before += int(offsets[-1])

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("tie"), F.monotonically_increasing_id().alias("place"))
    ordered = narrow.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place").select("doc_id", "t")
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(BLOOM_FPP), "orc.stripe.size": str(STRIPE_BYTES), "orc.row.index.stride": str(GROUP_ROWS), "compression": "zstd"}
    ordered.mapInArrow(encode, FILE_SCHEMA).write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, with ``file``: its place in the order of files. Filters on doc_id reach the stripes."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    return rows.select("doc_id", "offset", "ids", number.alias("file"))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the ids of all files before, by a sum over one row a file, plus the offset in the file.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("file", pa.int32()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, ends = np.asarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4"), lists.offsets.to_numpy()
            raw = memoryview(flat).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
            yield record_batch(schema, [batch.column(0), batch.column(1), batch.column(3), pa.array(np.diff(ends).astype(np.int64)), crc])

    bounded_batches(spark)
    rows = cut(read_tokens(spark, path).mapInArrow(check, "doc_id long, offset long, file int, n_tokens long, ids_crc32 long"), "token-index")
    sizes = rows.groupBy("file").agg(F.max(F.col("offset") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col("file").alias("f"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    return rows.join(first, F.col("file") == F.col("f")).select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and return what the files say."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, key, text, vocabulary)
    return token_index(docs.sparkSession, path)
