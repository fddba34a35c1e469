"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark window is a set of word shingles. Shingles are ordered by rarity in the corpus. A window that
occurs whole in a document has all its shingles there, so its necessary prefix is its one rarest shingle: only
documents with that shingle are candidates, at the positions that the shingle's place in the window gives. Length
and position bounds drop candidates that don't fit the document, and the words of the window decide the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut, record_batch, text_chunks

#: Fixed by the task: words of a window, and of a shingle.
WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: Benchmark text (bytes) that one broadcast index may hold; more makes more blocks, each met by all documents. Measured
#: with items of words of their own, an index takes some 90 times its text while it is built, and 20 times afterwards.
BLOCK_BYTES = 4 << 20
#: Text (bytes) that is searched at once, and windows that are compared at once.
CHUNK_BYTES = 4 << 20
COMPARED = 1 << 18
#: Fixed by the task: A-Z lowered; ASCII digits, letters and all bytes from 0x80 make words; the rest separates.
NORMALISE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TABLE = np.frombuffer(NORMALISE, dtype=np.uint8)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words of the texts, number of words of each); a null text has none."""
    own = pa.concat_arrays([pc.fill_null(texts, "")])
    _, offsets, data = own.buffers()
    # The rule maps bytes to bytes, so a column's bytes are mapped at once.
    mapped = _TABLE[np.frombuffer(data, dtype=np.uint8)] if data else np.empty(0, np.uint8)
    lists = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(own), offsets, pa.py_buffer(mapped), offset=own.offset))
    words, sizes = pc.list_flatten(lists), pc.list_value_length(lists).to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(full)))
    ends = np.cumsum(sizes)
    return words.filter(pa.array(full)), before[ends] - before[ends - sizes]


def mixed_rows(rows: np.ndarray) -> np.ndarray:
    """A 64-bit code for each row of word identifiers. Equal rows have equal codes."""
    code = np.zeros(len(rows), dtype=np.uint64)
    for column in rows.T:
        code = (code ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code


@dataclass
class BenchmarkIndex:
    """Windows of one block of benchmark items, by the identifiers of its words, in arrays.

    A window is a row of ``windows`` (padded with -1) and has ``spans`` words; its shingles' numbers, by place, are a row
    of ``parts`` (padded with the number of shingles). ``codes`` has for each width of shingles their sorted codes, and
    the first one's number. ``owners`` lists the items of window w from ``owner_start[w]`` on.
    """

    words: pa.Array
    items: list[str]
    windows: np.ndarray
    spans: np.ndarray
    parts: np.ndarray
    codes: dict[int, tuple[np.ndarray, int]]
    owner_start: np.ndarray
    owners: np.ndarray

    def shingles(self) -> int:
        return sum(len(code) for code, _ in self.codes.values())


def build_index(items: list[tuple[object, str | None]], window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS) -> BenchmarkIndex:
    """The index of a block of (item_id, text); an item without words has no window, a null item_id is 'null'."""
    every, sizes = words_of(pa.array([t for _, t in items], pa.string()))
    coded = every.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int32)
    ends = np.cumsum(sizes)
    spans = np.minimum(sizes, window)
    counts = np.where(sizes > 0, sizes - spans + 1, 0)
    owner = np.repeat(np.arange(len(items)), counts)
    start = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(ends - sizes, counts)
    span = np.repeat(spans, counts)
    places = np.arange(window)
    rows = np.where(places < span[:, None], np.append(ids, np.full(window, -1, np.int32))[start[:, None] + places], -1).astype(np.int32)
    rows, same = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.empty(0, np.int64))
    span = (rows >= 0).sum(axis=1)
    pairs = np.unique(np.stack((same.ravel(), owner), axis=1), axis=0) if len(owner) else np.empty((0, 2), np.int64)
    # Shingles by width: five words, or all of a shorter window.
    widths = np.minimum(span, shingle)
    most = max(1, window - shingle + 1)
    parts, codes, first = np.full((len(rows), most), -1, dtype=np.int64), {}, 0
    for width in sorted(set(widths.tolist())):
        at = np.flatnonzero(widths == width)
        own = np.stack([mixed_rows(rows[at, i : i + width]) for i in range(most if width == shingle else 1)], axis=1)
        valid = np.arange(own.shape[1]) < (span[at] - width + 1)[:, None]
        code, number = np.unique(own[valid], return_inverse=True)
        filled = np.full(own.shape, -1, dtype=np.int64)
        filled[valid] = number + first
        parts[at, : own.shape[1]] = filled
        codes[width] = (code, first)
        first += len(code)
    parts[parts < 0] = first
    return BenchmarkIndex(coded.dictionary, ["null" if i is None else str(i) for i, _ in items], rows, span.astype(np.int32), parts, codes, np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1)), pairs[:, 1].astype(np.int64))


@dataclass
class Passage:
    """Words of some texts as identifiers (-1: not in the benchmark), with a -1 after each text; starts and sizes."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def read(cls, texts: pa.Array, index: BenchmarkIndex) -> Passage:
        words, sizes = words_of(texts)
        coded = words.dictionary_encode()
        known = pc.index_in(coded.dictionary, value_set=index.words).fill_null(-1).to_numpy().astype(np.int32)
        stops = np.cumsum(sizes + 1) - 1
        ids = np.full(int(sizes.sum()) + len(sizes), -1, dtype=np.int32)
        inner = np.ones(len(ids), dtype=bool)
        inner[stops] = False
        ids[inner] = known[coded.indices.to_numpy()]
        return cls(ids, stops - sizes, sizes)

    def shingles(self, index: BenchmarkIndex) -> tuple[np.ndarray, np.ndarray]:
        """Positions and numbers of the benchmark's shingles."""
        found = []
        unknown = np.concatenate(([0], np.cumsum(self.ids < 0)))
        for width, (code, first) in index.codes.items():
            n = len(self.ids) - width + 1
            if n < 1 or not len(code):
                continue
            at = np.flatnonzero(unknown[width:] == unknown[:-width])
            own = mixed_rows(self.ids[at[:, None] + np.arange(width)])
            slot = np.minimum(np.searchsorted(code, own), len(code) - 1)
            hit = code[slot] == own
            found.append((at[hit], slot[hit] + first))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([n for _, n in found])


@dataclass
class Prefixes:
    """For each shingle that is some window's necessary prefix: its windows and its place in them, from ``start[s]`` on."""

    start: np.ndarray
    windows: np.ndarray
    places: np.ndarray


def rarest(index: BenchmarkIndex, seen: np.ndarray) -> Prefixes:
    """Order of shingles: corpus count, then number. A window with a shingle that the corpus lacks occurs nowhere."""
    n = index.shingles()
    rank = np.empty(n + 1, dtype=np.int64)
    rank[np.lexsort((np.arange(n), seen))] = np.arange(n)
    rank[n] = n  # where a shorter window has no shingle
    place = rank[index.parts].argmin(axis=1)
    shingle = index.parts[np.arange(len(place)), place]
    windows = np.flatnonzero(seen[np.minimum(shingle, n - 1)] > 0) if n else np.empty(0, np.int64)
    windows = windows[np.argsort(shingle[windows], kind="stable")]
    return Prefixes(np.searchsorted(shingle[windows], np.arange(n + 2)), windows, place[windows])


def find_hits(passage: Passage, index: BenchmarkIndex, prefix: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and windows of all occurrences of windows in a passage."""
    at, number = passage.shingles(index)
    counts = prefix.start[number + 1] - prefix.start[number]
    at, number, counts = at[counts > 0], number[counts > 0], counts[counts > 0]
    starts, windows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    ends = np.cumsum(counts)
    a = 0
    while a < len(at):  # candidates, a bounded number at a time, unless one shingle has more windows
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + COMPARED, side="right")))
        n = counts[a:b]
        slot = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(prefix.start[number[a:b]], n)
        window = prefix.windows[slot]
        start = np.repeat(at[a:b], n) - prefix.places[slot]
        span = index.spans[window]
        fits = (start >= 0) & (start + span <= len(passage.ids))  # position and length bounds
        start, window, span = start[fits], window[fits], span[fits]
        same = np.ones(len(start), dtype=bool)
        for i in range(index.windows.shape[1]):  # the window itself; a text's end is no word
            inside = i < span
            same &= ~inside | (passage.ids[np.where(inside, start + i, 0)] == index.windows[window, i])
        starts.append(start[same])
        windows.append(window[same])
        a = b
    return np.concatenate(starts), np.concatenate(windows)


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark, one block of bounded size at a time on the driver."""
    own = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    block, size = [], 0
    for row in own.toLocalIterator(prefetchPartitions=False):
        more = len((row["text"] or "").encode())
        if block and size + more > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item"], row["text"]))
        size += more
    yield block


def _corpus_counts(docs: DataFrame, text: str, shared, n: int) -> np.ndarray:
    """How often each of the index's n shingles stands in the corpus: counted in every task, then added up."""
    schema = pa.schema([("s", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: BenchmarkIndex = shared.value
        total = np.zeros(n, dtype=np.int64)
        for batch in batches:
            for _, texts in text_chunks(batch, "t", CHUNK_BYTES):
                total += np.bincount(Passage.read(texts, index).shingles(index)[1], minlength=n)
        found = np.flatnonzero(total)
        yield record_batch(schema, [pa.array(found), pa.array(total[found])])

    added = docs.select(F.col(text).alias("t")).mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).toArrow()  # bounded by the block's shingles
    seen = np.zeros(n, dtype=np.int64)
    seen[added.column(0).to_numpy()] = added.column(1).to_numpy()
    return seen


def _prepared(docs: DataFrame, block: list[tuple[object, str | None]], text: str):
    """The broadcast (index, prefixes) of one block of the benchmark, ordered by the shingles' counts in ``docs``."""
    context = docs.sparkSession.sparkContext
    index = build_index(block)
    shared = context.broadcast(index)
    prefix = rarest(index, _corpus_counts(docs, text, shared, index.shingles()))
    shared.destroy()
    return context.broadcast((index, prefix))


def _stretches(passage: Passage, index: BenchmarkIndex, starts: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in the passage, of the stretches that the occurrences cover; those that touch are one."""
    change = np.zeros(len(passage.ids) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + index.spans[windows], -1)
    inside = np.concatenate(([False], np.cumsum(change)[:-1] > 0, [False]))
    return np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])


def _spelt(document: np.ndarray, windows: np.ndarray, index: BenchmarkIndex, n: int) -> list[list[str]]:
    """The items of each of n documents, as sorted strings."""
    counts = index.owner_start[windows + 1] - index.owner_start[windows]
    slot = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(index.owner_start[windows], counts)
    pairs = np.unique(np.repeat(document, counts) * len(index.items) + index.owners[slot]) if len(slot) else np.empty(0, np.int64)
    out: list[list[str]] = [[] for _ in range(n)]
    for d, i in zip((pairs // max(1, len(index.items))).tolist(), (pairs % max(1, len(index.items))).tolist(), strict=True):
        out[d].append(index.items[i])
    return [sorted(set(x)) for x in out]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids, hashes and numbers of words."""
    for batch in batches:
        for first, texts in text_chunks(batch, "t", CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(words_of(texts)[1])], ["doc_id", "text_hash", "n_words"])


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, starts and ends of the hit stretches (in words), items (sorted strings).

    Null and empty texts have no words and no hits; repeated rows give repeated results; an empty benchmark hits
    nothing; other columns are not read. A benchmark over ``block_bytes`` is met block by block.
    """
    bounded_batches(docs.sparkSession)
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    block, following = next(blocks), next(blocks, None)
    kind = "doc_id long, text_hash long, n_words long, starts array<long>, ends array<long>, items array<string>"
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("t"))

    def scan(shared, everything: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, prefix = shared.value
            for batch in batches:
                for first, texts in text_chunks(batch, "t", CHUNK_BYTES):
                    n, passage = len(texts), Passage.read(texts, index)
                    starts, windows = find_hits(passage, index, prefix)
                    document = lambda at, own=passage: np.searchsorted(own.starts, at, side="right") - 1
                    a, b = _stretches(passage, index, starts, windows)
                    of = document(a)
                    offsets = pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(x - passage.starts[of])) for x in (a, b)]
                    columns = [batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(passage.sizes), *lists, pa.array(_spelt(document(starts), windows, index, n), pa.list_(pa.string()))]
                    out = record_batch(schema, columns)
                    yield out if everything else out.filter(pc.greater(pc.list_value_length(lists[0]), 0))

        return run

    if following is None:
        return narrow.mapInArrow(scan(_prepared(docs, block, text), True), kind).drop("text_hash")
    # One block after the other is met and written, so that a worker never holds more than one.
    hits = None
    while block is not None:
        shared = _prepared(docs, block, text)
        part = cut(narrow.mapInArrow(scan(shared, False), kind).dropDuplicates(["doc_id", "text_hash"]), "block-hits")
        shared.destroy()
        hits = part if hits is None else hits.unionAll(part)
        block, following = following, next(blocks, None)
    sizes = narrow.mapInArrow(_counted, "doc_id long, text_hash long, n_words long")
    # A document's stretches from all blocks meet in one row; the number of blocks bounds them.
    gathered = cut(hits.groupBy("doc_id", "text_hash").agg(F.sort_array(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("all_items")), "hits")
    merged = F.aggregate(
        "spans", F.array().cast("array<struct<starts:bigint,ends:bigint>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["ends"] >= x["starts"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["starts"].alias("starts"), F.greatest(F.element_at(acc, -1)["ends"], x["ends"]).alias("ends"))))).otherwise(F.concat(acc, F.array(x))),
    )
    united = gathered.select(F.col("doc_id").alias("gd"), F.col("text_hash").alias("gt"), merged.alias("spans"), "all_items")
    same = F.col("doc_id").eqNullSafe(F.col("gd")) & (F.col("text_hash") == F.col("gt"))
    empty = F.array().cast("array<bigint>")
    return sizes.join(united, same, "left").select(
        "doc_id", "n_words",
        F.coalesce(F.col("spans.starts"), empty).alias("starts"), F.coalesce(F.col("spans.ends"), empty).alias("ends"),
        F.coalesce("all_items", F.array().cast("array<string>")).alias("items"),
    )


def contamination_table(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, for every document."""
    found = contamination(docs, benchmark, **options)
    hit = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda n, x: n + x["ends"] - x["starts"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs; columns and other rows as they were.

    Null and empty texts stay, as do all rows if the benchmark is empty; repeated rows fare alike; an empty table gives an
    empty one. Rows pass through in whole batches, so nothing is shuffled; several blocks of the benchmark filter in turn,
    and between them the rows are written, so that a worker never holds more than one block.
    """
    bounded_batches(docs.sparkSession)
    names = docs.columns
    name = names[[n.lower() for n in names].index(text.lower())]
    kind = docs.schema
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    block, following = next(blocks), next(blocks, None)
    while True:
        shared = _prepared(docs, block, text)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, prefix = shared.value
            for batch in batches:
                for first, texts in text_chunks(batch, name, CHUNK_BYTES):
                    passage = Passage.read(texts, index)
                    clean = np.ones(len(texts), dtype=bool)
                    clean[np.searchsorted(passage.starts, find_hits(passage, index, prefix)[0], side="right") - 1] = False
                    yield batch.slice(first, len(texts)).filter(pa.array(clean))

        docs = docs.mapInArrow(keep, kind)
        if following is None:
            return docs
        docs = cut(docs, "clean")
        shared.destroy()
        block, following = following, next(blocks, None)
