"""Links of texts whose shingle sets reach a Jaccard similarity: MinHash bands name candidates, sets decide.

Every text of a band is compared with the band's most typical text, which links a group of copies by as many comparisons
as it has texts. Only where a band still holds several components are the others compared, across components. All
comparisons are exact, on sets of 64-bit shingle hashes. Nothing that grows with the data is broadcast, and a task
compares blocks that are bounded by texts and by shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, record_batch, words_of
from .graph import connected_components
from .sieve import matching

#: Fixed by the task: words in a shingle, and the similarity from which texts are near copies.
SHINGLE_WORDS = 5
JACCARD = 0.8
#: Bands and rows of a band: a pair at the threshold shares a band with a chance of 0.996, one at 0.9 of 0.999999.
BANDS = 14
ROWS = 5
#: Texts, and shingles, that one task compares with each other; more are dealt to several tasks.
BLOCK = 256
BLOCK_SHINGLES = 1 << 20

#: Odd multipliers: each puts the shingles' 32-bit hashes in another order.
_MULTIPLY = (np.random.default_rng(7).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)

#: From a column of payloads to each text's sorted distinct shingle hashes.
Unpack = Callable[[pa.Array], list[np.ndarray]]


def shingle_set(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct 64-bit hashes, sorted, of the text's shingles; fewer words are one shingle, none make an empty set."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    width = min(shingle_words, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1]
    joined, digest = b" ".join(words), xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(starts.tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)], dtype=np.uint64))


def band_keys(codes: np.ndarray) -> list[int]:
    """A signed 64-bit key for each band of a shingle set; an empty set has none."""
    if not len(codes):
        return []
    low = (codes ^ (codes >> np.uint64(32))).astype(np.uint32)
    least = np.array([(low * m).min() for m in _MULTIPLY], dtype="<u4").reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least)], dtype=np.uint64).view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach the threshold."""
    if min(len(a), len(b)) < JACCARD * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= JACCARD * (len(a) + len(b) - both)


def links_across(roots: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Edges between roots of a spanning forest of the texts, linked by similarity or by an equal root."""
    sizes = np.array([len(s) for s in sets])
    root = np.array(roots, dtype=np.int64)
    words, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mark = np.zeros(len(words), dtype=np.int32)
    rest = np.arange(len(sets))
    while len(rest):
        same = root[rest] == root[rest[0]]
        frontier, rest = rest[same].tolist(), rest[~same]
        while frontier and len(rest):
            at = frontier.pop()
            own = codes[starts[at] : ends[at]]
            near = rest[np.minimum(sizes[rest], sizes[at]) >= JACCARD * np.maximum(sizes[rest], sizes[at])]
            if not len(near):
                continue
            mark[own] = 1
            both = np.array([mark[codes[starts[o] : ends[o]]].sum() for o in near])
            mark[own] = 0
            hit = np.unique(root[near[both >= JACCARD * (sizes[near] + sizes[at] - both)]])
            if len(hit):
                yield from ((int(root[at]), int(h)) for h in hit)
                found = np.isin(root[rest], hit)
                frontier.extend(rest[found].tolist())
                rest = rest[~found]


def candidates(texts: DataFrame) -> DataFrame:
    """(k, id, node, weight, n) for each text (id, node, weight, keys) in a band key that several texts share.

    A text may stand in several rows; ``n`` counts a key's rows. Least and greatest text of a key combine before the
    shuffle, so that keys of one text, however often it stands, fall out.
    """
    keyed = texts.select("id", "node", "weight", F.explode("keys").alias("k"))
    shared = cut(keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("k", "n"), "bands")
    return cut(matching(keyed, F.col("k"), shared, "k").join(shared, "k").select("k", "id", "node", "weight", "n").distinct(), "members")


def typical_pairs(members: DataFrame) -> DataFrame:
    """(rep, rnode, salt, salts, id, node): each text of a key with the key's most typical text.

    That is the text whose keys are shared most: of a group of copies, the one that the others are made from. Its
    pairs are dealt to ``salts`` parts of about BLOCK.
    """
    share = members.groupBy("id").agg(F.sum("n").alias("w"))
    best = members.join(share, "id").groupBy("k").agg(F.max(F.struct("w", "id", "node", "n")).alias("r")).select("k", "r.*")
    most = best.groupBy("id").agg(F.max("n").alias("most"))
    reps = cut(best.join(most, "id").select("k", F.col("id").alias("rep"), F.col("node").alias("rnode"), F.ceil(F.col("most") / BLOCK).alias("salts")), "typical")
    pairs = members.join(reps, "k").where(F.col("node") != F.col("rnode"))
    return pairs.select("rep", "rnode", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), "salts", "id", "node").distinct()


def verified(pairs: DataFrame, sets: DataFrame, unpack: Unpack) -> DataFrame:
    """(a, b): nodes of the pairs whose sets reach the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    parts = pairs.select(F.col("rep").alias("rid"), "salts").distinct().select("rid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("part"))
    typical = parts.join(sets, parts["rid"] == sets["id"]).select("rid", "part", F.col("payload").alias("rpayload"))
    joined = pairs.join(sets, "id").join(typical, (F.col("rep") == F.col("rid")) & (F.col("salt") == F.col("part")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([similar(a, b) for a, b in zip(unpack(batch.column(2)), unpack(batch.column(3)), strict=True)], pa.bool_())
            yield record_batch(schema, [batch.column(0).filter(keep), batch.column(1).filter(keep)])

    return joined.select("rnode", "node", "payload", "rpayload").mapInArrow(compare, "a long, b long")


def mixed_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, ids): lists of the texts to compare in keys of over two texts that hold several components (node, root).

    A key of more than BLOCK texts or BLOCK_SHINGLES shingles is dealt to pairs of blocks; texts of its largest component,
    linked already, only meet the other components' texts.
    """
    placed = cut(members.where("n > 2").join(roots, "node", "left").select("k", "id", "weight", F.coalesce("root", "node").alias("root")), "placed")
    counts = placed.groupBy("k", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("weight").alias("s"))
    mixed = cut(counts.groupBy("k").agg(F.max(F.struct("c", "root", "s")).alias("m"), F.sum("c").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("k", F.col("m.root").alias("major"), F.col("m.c").alias("n_major"), (F.col("n") - F.col("m.c")).alias("n_minor"), F.col("m.s").alias("s_major"), (F.col("s") - F.col("m.s")).alias("s_minor")), "mixed")
    rows = matching(placed, F.col("k"), mixed, "k").join(mixed, "k").withColumn("is_major", F.col("root") == F.col("major"))
    whole = (F.col("n_major") + F.col("n_minor") <= BLOCK) & (F.col("s_major") + F.col("s_minor") <= BLOCK_SHINGLES)
    blocks = lambda side: F.greatest(F.ceil(F.col(f"n_{side}") / BLOCK), F.ceil(F.col(f"s_{side}") / BLOCK_SHINGLES))
    majors, minors = (F.when(whole, F.lit(1)).otherwise(blocks(side)).cast("int") for side in ("major", "minor"))
    rows = rows.withColumn("majors", majors).withColumn("minors", minors).withColumn("block", F.when(whole, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("minors")))).cast("int"))
    part = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.cast("int").alias("x"), y.cast("int").alias("y"))
    over = lambda n, make: F.transform(F.sequence(F.lit(0), n - 1), make)
    block = F.col("block")
    with_minors = over(F.col("minors"), lambda j: part("major", block, j))
    among = over(F.col("minors"), lambda j: part("minor", F.least(block, j), F.greatest(block, j)))
    with_majors = over(F.col("majors"), lambda i: part("major", i, block))
    dealt = F.when(whole, F.array(part("whole", F.lit(0), F.lit(0)))).when(F.col("is_major"), with_minors).otherwise(F.concat(with_majors, among))
    listed = rows.select("k", "id", "root", F.explode(dealt).alias("p")).groupBy("k", "p").agg(F.sort_array(F.collect_list(F.struct("id", "root"))).alias("ids"))
    return cut(listed.where("size(ids) > 1").select("ids").distinct().withColumn("bucket", F.monotonically_increasing_id()), "mixed-lists")


def links_in(buckets: DataFrame, sets: DataFrame, unpack: Unpack) -> DataFrame:
    """(a, b): links between the roots of the buckets' texts."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    rows = buckets.select("bucket", F.explode("ids").alias("i")).select("bucket", "i.id", "i.root").join(sets, "id")
    listed = rows.groupBy("bucket").agg(F.collect_list("root").alias("roots"), F.collect_list("payload").alias("sets"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for roots, sets in zip(batch.column(0), batch.column(1), strict=True):
                found = list(links_across(roots.as_py(), unpack(sets.values)))
                if found:
                    yield record_batch(schema, [[e[0] for e in found], [e[1] for e in found]])

    return listed.select("roots", "sets").mapInArrow(compare, "a long, b long")


def link(texts: DataFrame, sets_of: Callable[[DataFrame], DataFrame], unpack: Unpack, close: DataFrame | None = None) -> DataFrame:
    """(node, root) over the nodes that have a link: by ``close`` (a, b), or by texts whose sets reach the threshold.

    ``texts`` has rows (id, node, weight, keys) of distinct texts, which may repeat: the node (texts of one node are linked
    anyhow), the number of shingles and the band keys; a text without keys has no links. ``sets_of`` gives (id, payload)
    of the texts whose id it is handed, and ``unpack`` reads payloads. An empty table gives an empty one.
    """
    members = candidates(texts)
    pairs = cut(typical_pairs(members), "pairs")
    sets = cut(sets_of(cut(members.select("id").distinct(), "wanted")), "sets")
    edges = verified(pairs, sets, unpack)
    roots = cut(connected_components(edges if close is None else close.unionAll(edges)), "roots")
    buckets = mixed_buckets(members, roots.select("node", "root"))
    if not buckets.limit(1).count():
        return roots
    return cut(connected_components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(links_in(buckets, sets, unpack))), "roots")
