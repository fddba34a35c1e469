"""SimHash near-duplicates: pigeonhole blocks, a join on the blocks, then the Hamming distance itself.

Fingerprints that differ in at most ``bits`` bits agree in at least ``blocks - bits`` of ``blocks`` blocks. Every
choice of that many blocks gives one key; fingerprints that share a key are compared. Only distinct fingerprints
take part, and from the rows of a key only the edges of a spanning forest leave the task, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bands
from .common import bounded_batches, cut, record_batch, utf8, words_of
from .graph import connected_components
from .sieve import matching, sifted

#: Fixed by the task: seed of the shingle hash, words in a shingle, bits that linked fingerprints may differ in.
SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
#: Blocks of a fingerprint: of 5, linked ones share 2 (25 bits) in one of 10 ways. More blocks make longer keys.
BLOCKS = 5
#: Up to so many distinct fingerprints a key are compared in one task; more take the path by neighbouring values.
BUCKET_ROWS = 8192


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint: bit j is set if set in over half the shingles' hashes. No words: zero."""
    words = words_of(text)
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    width = min(shingle_words, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, key: str, text: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; the fingerprint is a signed long.

    A null text has the hash of nothing and, as a text without words, fingerprint zero; repeated rows stay; an empty table
    gives an empty one; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle_words) for t in utf8(batch, "t")], dtype=np.uint64)
            yield record_batch(schema, [batch.column(0), batch.column(1), pa.array(values.view(np.int64))])

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("t"))
    return narrow.mapInArrow(scan, "doc_id long, text_hash long, fp long")


def with_sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text_hash, fp, size, keys) for every row: with the size and the band keys of its shingle set, which a text
    without words does not have. Otherwise as ``with_fingerprints``."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64()), ("size", pa.int32()), ("keys", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch, "t")
            values = np.array([fingerprint(t, bands.SHINGLE_WORDS) for t in texts], dtype=np.uint64)
            sets = [bands.shingle_set(t) for t in texts]
            yield record_batch(schema, [batch.column(0), batch.column(1), pa.array(values.view(np.int64)), [len(s) for s in sets], [bands.band_keys(s) for s in sets]])

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("t"))
    return narrow.mapInArrow(scan, "doc_id long, text_hash long, fp long, size int, keys array<long>")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_masks(blocks: int = BLOCKS, bits: int = MAX_BITS) -> list[int]:
    """The bit masks of all choices of ``blocks - bits`` blocks, as unsigned integers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - bits)]


def forest(values: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the values (uint64, distinct) linked at ``bits`` or fewer differing bits."""
    rest = np.sort(values)
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(rest ^ at) <= bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                frontier.extend(found)
                yield from ((int(at), int(x)) for x in found)


def _edges_in_buckets(buckets: DataFrame, bits: int) -> DataFrame:
    """Forest edges from rows with an array of distinct fingerprints."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            found = [e for a, b in zip(offsets, offsets[1:], strict=False) for e in forest(flat[a:b].view(np.uint64), bits)]
            if found:
                yield record_batch(schema, list(np.array(found, dtype=np.uint64).view(np.int64).T.copy()))

    return buckets.select("fps").mapInArrow(compare, "a long, b long")


def _edges_by_neighbours(hot: DataFrame, masks: list[int], bits: int) -> DataFrame:
    """Links in buckets of any size, by values near the members; exact, and linear in the number of members.

    Two values at distance ``bits`` or less meet at a value that is at most floor(bits/2) from one and at most
    ceil(bits/2) from the other. Members within floor(bits/2) of a meeting value link all members that meet there,
    so a star around the least of them says it all; at most some hundred distinct values can meet at one.
    """
    low, high = bits // 2, bits - bits // 2
    flips = []
    for table, mask in enumerate(masks):
        free = [1 << i for i in range(64) if not mask >> i & 1]
        for n in range(high + 1):
            flips.extend((table, n, _signed(sum(c))) for c in combinations(free, n))
    spark = hot.sparkSession
    flip_table = spark.createDataFrame(flips, "ft int, d int, flip long")
    meet = hot.join(F.broadcast(flip_table), F.col("t") == F.col("ft")).select("t", "fp", "d", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    stars = meet.groupBy("t", "at").agg(F.min(F.when(F.col("d") <= low, F.col("fp"))).alias("a"), F.collect_list("fp").alias("fps"))
    return stars.where("a is not null and size(fps) > 1").select("a", F.explode("fps").alias("b")).where("a <> b")


def similar_fingerprints(nodes: DataFrame, blocks: int = BLOCKS, bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose transitive closure is that of all close pairs."""
    masks = block_masks(blocks, bits)
    keyed = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)])).alias("x")).select("fp", "x.t", "x.k")
    shared = cut(keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "blocks")
    rows = keyed.join(shared, ["t", "k"])
    buckets = rows.where(F.col("n") <= bucket_rows).groupBy("t", "k").agg(F.collect_list("fp").alias("fps"))
    edges = _edges_in_buckets(buckets, bits)
    if shared.where(F.col("n") > bucket_rows).limit(1).count():
        edges = edges.unionAll(_edges_by_neighbours(rows.where(F.col("n") > bucket_rows), masks, bits))
    return edges


def group_fingerprints(prints: DataFrame, blocks: int = BLOCKS, bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(fp, component_id) for every distinct fp of (doc_id, fp): the smallest doc_id reachable over linked values.

    Null ids are passed over by the minimum; a component with null ids only has a null component_id.
    """
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_docs")), "fingerprints")
    roots = cut(connected_components(similar_fingerprints(nodes, blocks, bits, bucket_rows)), "roots")
    linked = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return linked.join(least, "root").select("fp", "component_id")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Texts that are null, empty or all white space have fingerprint zero and link like any other; repeated rows
    stay; an empty table gives an empty one; other columns are not read.
    """
    prints = cut(with_fingerprints(docs, key, text, shingle_words), "prints")
    groups = group_fingerprints(prints, bits=bits)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(groups, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def text_sets(docs: DataFrame, key: str, text: str, chosen: DataFrame) -> DataFrame:
    """(id, payload): shingle sets of the texts of ``chosen`` (id: hash of the text, doc_id of a row that has it)."""
    schema = pa.schema([("id", pa.int64()), ("payload", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield record_batch(schema, [batch.column(0), [bands.shingle_set(t).view(np.int64) for t in utf8(batch, "t")]])

    narrow = docs.select(F.xxhash64(F.col(text)).alias("h"), F.col(key).cast("long").alias("d"), F.col(text).alias("t"))
    wanted = chosen.withColumn("row", F.xxhash64("id", "doc_id"))
    same = (F.col("h") == F.col("id")) & F.col("d").eqNullSafe(F.col("doc_id"))
    found = matching(narrow, F.xxhash64("h", "d"), wanted, "row").join(wanted, same, "left_semi").select("h", "t")
    return found.mapInArrow(scan, "id long, payload array<long>").dropDuplicates(["id"])


def unpack_sets(payload: pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in payload]


def keep_one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the least by id (nulls last), then by a hash of the text.

    Fingerprints are of five-word shingles and link as in ``simhash_groups``; texts whose sets of such shingles have a
    similarity of 0.8 or more are linked too, which most often differ in more bits. Columns come back as they were. Of
    rows that are equal in id and text, one stays; texts without words are one group; an empty table gives an empty one.
    Texts are moved only where a row may have to go, by a bitmap of fixed size, whatever the number of rows.
    """
    prints = cut(with_sketches(docs, key, text), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("i"), F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("text_hash").alias("h"))
    # The least row of each fingerprint, then of each component: both minima combine before their shuffle.
    nodes = cut(prints.groupBy("fp").agg(F.min(order).alias("f")), "fingerprints")
    texts = cut(prints.where("size(keys) > 0").groupBy(F.col("text_hash").alias("id")).agg(F.min("doc_id").alias("doc_id"), F.min("fp").alias("node"), F.min("size").alias("weight"), F.min("keys").alias("keys")), "texts")
    chosen = texts.select("id", "doc_id")
    sets_of = lambda wanted: text_sets(docs, key, text, cut(matching(chosen, F.col("id"), wanted, "id").join(wanted, "id", "left_semi"), "chosen"))
    roots = bands.link(texts.drop("doc_id"), sets_of, unpack_sets, similar_fingerprints(nodes))
    linked = nodes.join(roots, nodes["fp"] == roots["node"], "left").withColumn("g", F.coalesce("root", "fp"))
    first = linked.groupBy("g").agg(F.min("f").alias("f")).select(F.when(~F.col("f.i"), F.col("f.d")).alias("kd"), F.col("f.h").alias("kh"))
    rows = cut(prints.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies")), "rows")
    is_first = F.col("doc_id").eqNullSafe(F.col("kd")) & (F.col("text_hash") == F.col("kh"))
    judged = rows.join(first, is_first, "left").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "copies", F.col("kh").isNotNull().alias("__first"))
    # Rows that go; a first row that stands several times goes too, and comes back once.
    marked = cut(judged.where("not __first or copies > 1").withColumn("__mark", F.xxhash64("__hash", "__id")), "marked")
    same = F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    packed = docs.select(F.struct("*").alias("__row"), F.col(key).cast("long").alias("__key"), F.xxhash64(F.col(text)).alias("__text"))
    sieved = sifted(packed, F.xxhash64("__text", "__key"), marked, "__mark")
    kept = sieved.where("not __may").select("__row.*").unionAll(sieved.where("__may").join(marked, same, "left_anti").select("__row.*"))
    again = marked.where("__first")
    if again.limit(1).count():
        once = matching(packed, F.xxhash64("__text", "__key"), again, "__mark").join(again, same, "left_semi").dropDuplicates(["__key", "__text"])
        kept = kept.unionAll(once.select("__row.*"))
    return kept
