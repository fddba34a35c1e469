"""Fuzzy line dedup: MinHash signatures of character shingles, banding, exact Jaccard, distributed union-find.

Lines are compared in a normal form. Equal forms are one line before anything is hashed. Lines that share a band of
their signatures are compared by their shingle sets (``bands``): each with the band's most typical line, then across what
is still apart. One line of each component stays: the first by document and line number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bands, sieve
from .common import bounded_batches, chunks, cut, record_batch, utf8
from .sieve import bitmap, in_bitmap

#: Characters (code points) of a shingle: shorter ones make many more lines share a band by chance. Lines are the same from
#: a similarity of ``bands.JACCARD`` on.
SHINGLE_CHARACTERS = 7
#: Bands and rows of a band: a pair at the threshold shares a band with a chance of 0.985, one at 0.9 of 0.9999.
BANDS = 8
ROWS = 4
#: Lines (bytes) that are hashed at once.
CACHED_BYTES = 100_000

#: Odd multipliers: each puts the shingles' 32-bit hashes in another order. The last makes a shingle one number.
_MULTIPLY = (np.random.default_rng(11).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_CHAIN = np.uint64(0x9FB21C651E98DF25)


def normal_form(line: bytes) -> bytes:
    """A-Z lowered, runs of white space one blank, none at the ends."""
    return b" ".join(line.lower().split())


def _stir(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return code ^ (code >> np.uint64(29))


def shingle_codes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all shingles of the lines, and each line's first; a shorter line is one shingle, padded."""
    texts = [x.decode("utf-8", "surrogateescape") for x in lines]
    texts = [t if len(t) >= SHINGLE_CHARACTERS else t.ljust(SHINGLE_CHARACTERS, "\0") for t in texts]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = max(0, len(points) - SHINGLE_CHARACTERS + 1)
    code = points[:n].copy()
    for i in range(1, SHINGLE_CHARACTERS):
        code *= _CHAIN
        code += points[i : n + i]
    ends = np.cumsum(sizes)
    own = np.ones(n, dtype=bool)
    for back in range(1, SHINGLE_CHARACTERS):  # shingles that would run into the next line
        own[(ends - back)[ends - back < n]] = False
    counts = sizes - SHINGLE_CHARACTERS + 1
    return _stir(code[own]), np.cumsum(counts) - counts


def band_keys(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each line and band, made of the band's minima and the band's number; and the lines' shingles.

    Lines are hashed in blocks that stay in a processor's cache.
    """
    keys, weights = np.empty((len(lines), BANDS), dtype=np.uint64), np.empty(len(lines), dtype=np.int64)
    for a, b in chunks(lines, CACHED_BYTES):
        codes, starts = shingle_codes(lines[a:b])
        low = (codes ^ (codes >> np.uint64(32))).astype(np.uint32)
        for band in range(BANDS):
            key = np.full(b - a, band + 1, dtype=np.uint64)
            for row in range(ROWS):
                least = np.minimum.reduceat(low * _MULTIPLY[band * ROWS + row], starts)
                key = _stir((key << np.uint64(7)) ^ least.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            keys[a:b, band] = key
        weights[a:b] = np.diff(np.append(starts, len(codes)))
    return keys.view(np.int64), weights


def unpack_forms(forms: pa.Array) -> list[np.ndarray]:
    """Each line's sorted distinct shingle codes."""
    lines = forms.to_pylist()
    if not lines:
        return []
    codes, starts = shingle_codes(lines)
    return [np.unique(x) for x in np.split(codes, starts[1:])]


def _lines(docs: DataFrame, key: str, text: str, row: str | None) -> DataFrame:
    """(row, doc_id, line, id, weight, keys) of every line with a word: its number, the hash of its normal form, its
    number of shingles, its bands' keys.

    The keys come with the first line of a form in a batch; equal forms have equal keys. Every document also has a
    row without id, whose weight is the document's number of lines with a word. ``row`` tells documents apart that share
    an id.
    """
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int32()), ("id", pa.int64()), ("weight", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_of, rows_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch, "t")
            for a, b in chunks(texts, 2 << 20):
                rows, forms, counts = [], {}, []
                for doc, row, text in zip(docs_of[a:b], rows_of[a:b], texts[a:b], strict=True):
                    counts.append(-len(rows))
                    for n, line in enumerate((text or b"").split(b"\n")):
                        form = normal_form(line)
                        if form:
                            own = forms.setdefault(form, len(forms))
                            rows.append((row, doc, n, own))
                    counts[-1] += len(rows)
                nothing = [None] * (b - a)
                yield record_batch(schema, [rows_of[a:b], docs_of[a:b], nothing, nothing, counts, [[]] * (b - a)])
                if not rows:
                    continue
                keys, weights = band_keys(list(forms))
                ids = np.array([xxhash.xxh64_intdigest(f) for f in forms], dtype=np.uint64).view(np.int64)
                first = np.full(len(forms), -1)
                place = np.array([r[3] for r in rows])
                first[place[::-1]] = np.arange(len(rows))[::-1]
                has = np.zeros(len(rows), dtype=bool)
                has[first] = True
                ends = np.concatenate(([0], np.cumsum(np.where(has, BANDS, 0)))).astype(np.int32)
                flat = keys[place[has]].ravel()
                yield record_batch(schema, [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], pa.array(ids[place]), pa.array(weights[place]), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))])

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), (F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col(text).alias("t"))
    return narrow.mapInArrow(scan, "row long, doc_id long, line int, id long, weight long, keys array<long>")


def _forms_of(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(id, payload) of the distinct lines in ``wanted`` (column id): their normal forms."""
    schema = pa.schema([("id", pa.int64()), ("payload", pa.binary())])
    shared, bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "id")), sieve.BITS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch, "t")
            for a, b in chunks(texts, 2 << 20):
                forms = list({form for t in texts[a:b] for line in (t or b"").split(b"\n") if (form := normal_form(line))})
                ids = np.array([xxhash.xxh64_intdigest(f) for f in forms], dtype=np.uint64).view(np.int64)
                may = np.flatnonzero(in_bitmap(shared.value, ids, bits))
                yield record_batch(schema, [pa.array(ids[may]), [forms[i] for i in may.tolist()]])

    some = docs.select(F.col(text).alias("t")).mapInArrow(scan, "id long, payload binary")
    return some.join(wanted, "id", "left_semi").dropDuplicates(["id"])


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(row, doc_id, n_lines, n_kept, kept_lines) of every document: numbers of the lines that stay, comma-joined.

    Of each component the first line stays, by document id (nulls last), row and line. ``row`` names a column that numbers
    the rows; without it they are numbered here.
    """
    bounded_batches(docs.sparkSession)
    lines = cut(_lines(docs, key, text, row), "lines")
    # A form has its keys once a batch; bands take such repeats for one text.
    texts = lines.where("size(keys) > 0").select("id", F.col("id").alias("node"), "weight", "keys")
    roots = bands.link(texts, lambda wanted: _forms_of(docs, text, wanted), unpack_forms)
    # The first place of each form, then of each component; most forms are a component of their own.
    place = F.struct(F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("doc"), F.col("row"), F.col("line"))
    forms = lines.where("id is not null").groupBy("id").agg(F.min(place).alias("place"))
    met = cut(forms.join(roots, forms["id"] == roots["node"], "left").select("root", "place"), "places")
    linked = met.where("root is not null").groupBy("root").agg(F.min("place").alias("place"))
    stay = met.where("root is null").select("place").unionAll(linked.select("place"))
    lists = stay.groupBy(F.col("place.row").alias("own")).agg(F.count(F.lit(1)).alias("n_kept"), F.array_join(F.array_sort(F.collect_list("place.line")).cast("array<string>"), ",").alias("kept_lines"))
    every = lines.where("id is null").select("row", "doc_id", F.col("weight").alias("n_lines"))
    return every.join(lists, F.col("row") == F.col("own"), "left").select("row", "doc_id", "n_lines", F.coalesce("n_kept", F.lit(0).cast("long")).alias("n_kept"), F.coalesce("kept_lines", F.lit("")).alias("kept_lines"))


def line_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_kept, kept_lines (numbers of the lines that stay, comma-joined).

    Lines are those with a word, numbered from 0 among all; a null, empty or blank text has none (zeros, empty
    string); repeated rows are documents of their own, and of their lines the first row's stay; other columns are
    not read; an empty table gives an empty one.
    """
    return kept_lines(docs, key, text).drop("row")


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with the lines that stay, in order; lines without words stay, a null text becomes an empty one.

    One row per row of ``docs``: rows are numbered in a table of their own, so repeated ids and rows keep apart; of
    repeated rows the first keeps its lines.
    """
    numbered = cut(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")), "numbered")
    kept = kept_lines(numbered, row="row").select(F.col("row").alias("own"), "kept_lines")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    chosen = F.split("kept_lines", ",")
    stays = lambda line, i: ~line.rlike(r"[^\x20\x09-\x0D]") | F.array_contains(chosen, i.cast("string"))
    joined = numbered.join(kept, F.col("row") == F.col("own"))
    return joined.select("doc_id", F.array_join(F.filter(lines, stays), "\n").alias("text"))
