"""Scoring with a log-bilinear language model trained by noise-contrastive estimation.

The model (Mnih and Hinton, 2007; Mnih and Teh, 2012) predicts in two steps. First a symbol from the two before it: the
predicted vector is the sum of the context's vectors, each scaled by weights of its place, and a symbol's score is its
dot product with the symbol's vector plus a bias. The 99 most frequent words are symbols of their own; other words share
28 symbols by their last letter; the end of a text is a symbol. Then, for the most frequent VOCABULARY_WORDS words, the
word in its class: these words have vectors of their own, as contexts and as targets (``lmwords``). Other words have their
smoothed share of their class. Both steps are normalised by batched matrix products, and all words, unseen ones included,
sum to one.

What is learned from the corpus: counts of all words, and counts of all triples of symbols, of all training documents,
both added up in a distributed way. The symbol model is trained on those counts and the words' vectors on all training
texts, task by task, so every training token has its say. Frequent words' counts are broadcast; the others' are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc_text, cut, record_batch, text_chunks
from .lmwords import LEAST_TOKENS, MOST_PASSES, Trainer, Words

#: Fixed by the task: smoothing of the unigram base, and the share of documents held out.
SMOOTH = 0.1
HOLD_OUT = 10
#: Symbols: so many words of their own, 28 classes of others, and the end of a text, which also stands before a text.
HEAD_WORDS = 99
CLASSES = 28
END = HEAD_WORDS + CLASSES
SYMBOLS = END + 1
#: Words with vectors of their own: the most frequent of at least LEAST_COUNT training tokens. The rest of a class shares
#: its symbol, so no word is without a probability.
VOCABULARY_WORDS = 16_384
LEAST_COUNT = 50
#: At most so many words' counts are broadcast to the workers, of at most so many bytes each; the others' are joined.
DICTIONARY_WORDS = 300_000
WORD_BYTES = 64
#: Distinct words that a worker gathers before it passes their counts on.
COUNTER_WORDS = 1_000_000
#: Text (bytes) that is worked on at once, and in a step of training.
CHUNK_BYTES = 4 << 20
STEP_BYTES = 1 << 20
#: ASCII marks that are taken off a word's end before its class is found.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Training:
    """Size of the vectors, noise samples for each observation, steps and step size of the optimiser."""

    width: int = 24
    noise: int = 10
    steps: int = 120
    rate: float = 0.05
    seed: int = 7


def suffix_classes(words: pa.Array) -> np.ndarray:
    """Of each word 0 to 25 by the last letter under trailing marks, 26 for letters outside ASCII, 27 for anything else."""
    bare = pc.ascii_rtrim(words, characters=MARKS)
    if not len(bare):
        return np.empty(0, dtype=np.int32)
    _, offsets, data = bare.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[bare.offset : bare.offset + len(bare) + 1]
    last = np.zeros(len(bare), dtype=np.int32)
    full = ends[1:] > ends[:-1]
    if full.any():
        last[full] = np.frombuffer(data, dtype=np.uint8)[ends[1:][full] - 1]
    return np.where((last >= 97) & (last <= 122), last - 97, np.where(last >= 128, 26, 27)).astype(np.int32)


@dataclass
class Tokens:
    """The words of some texts: number of words of each text, the distinct words, and each word's place among them."""

    sizes: np.ndarray
    distinct: pa.Array
    place: np.ndarray


def tokens_of(texts: pa.Array) -> Tokens:
    """Words of texts with A-Z lowered; a null text has none. Arrow's ASCII functions know the rule's white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = pc.list_flatten(lists), pc.list_value_length(lists).to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # white space at a text's ends leaves empty strings
        before = np.concatenate(([0], np.cumsum(full)))
        ends = np.cumsum(sizes)
        sizes = before[ends] - before[ends - sizes]
        words = words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return Tokens(sizes, coded.dictionary, coded.indices.to_numpy().astype(np.int64))


def held_out(key: Column) -> Column:
    """Whether a document is held out; a null id counts as the empty text, and so is held out."""
    return F.pmod(crc_text(key), F.lit(HOLD_OUT)) == 0


def count_words(texts: DataFrame) -> DataFrame:
    """(word, class, n) over all texts; a task adds up what it has gathered before it passes a bounded table on."""
    schema = pa.schema([("word", pa.string()), ("class", pa.int32()), ("n", pa.int64())])

    def emit(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        if parts:
            added = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).combine_chunks()
            for batch in added.to_batches(max_chunksize=50_000):
                words = batch.column(batch.schema.get_field_index("word"))
                yield record_batch(schema, [words, pa.array(suffix_classes(words)), batch.column(batch.schema.get_field_index("n_sum"))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, gathered = [], 0
        for batch in batches:
            for _, part in text_chunks(batch, "t", CHUNK_BYTES):
                own = tokens_of(part)
                n = np.bincount(own.place, minlength=len(own.distinct)).astype(np.int64)
                parts.append(pa.table({"word": own.distinct, "n": n}))
                gathered += len(n)
                if gathered > COUNTER_WORDS:
                    yield from emit(parts)
                    parts, gathered = [], 0
        yield from emit(parts)

    return texts.select("t").mapInArrow(scan, "word string, class int, n long").groupBy("word", "class").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = DICTIONARY_WORDS) -> tuple[pa.Array, np.ndarray]:
    """(words, counts) of at most about ``most`` words above a count, by falling count and then by word; longer words
    than WORD_BYTES are left to the join."""
    short = counts.where(F.octet_length("word") <= WORD_BYTES)
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    levels = sorted(short.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True)  # some hundred rows
    total, lowest = 0, None
    for row in levels:
        if total + row["k"] > most:
            break
        total, lowest = total + row["k"], row["l"]
    top = short.orderBy(F.desc("n"), "word").limit(HEAD_WORDS) if lowest is None or total < HEAD_WORDS else short.where(level >= lowest)
    table = top.select("word", "n").toArrow().combine_chunks()
    order = pc.sort_indices(table, sort_keys=[("n", "descending"), ("word", "ascending")])
    table = table.take(order).combine_chunks()
    words = table.column(0).combine_chunks() if len(table) else pa.array([], pa.string())
    return words, table.column(1).to_numpy().astype(np.int64)


@dataclass
class Flow:
    """Tokens of some texts, the ends included: of each its place among the chunk's distinct words (the end's is one
    more), its symbol, and the symbols of the two tokens before it; starts and sizes of the texts."""

    starts: np.ndarray
    sizes: np.ndarray
    place: np.ndarray
    symbol: np.ndarray
    before: np.ndarray
    last: np.ndarray


def flow_of(own: Tokens, symbols: np.ndarray) -> Flow:
    """``symbols``: of the distinct words, and at the end of the end."""
    sizes = own.sizes + 1
    ends = np.cumsum(sizes) - 1
    place = np.full(int(sizes.sum()), len(own.distinct), dtype=np.int64)
    inner = np.ones(len(place), dtype=bool)
    inner[ends] = False
    place[inner] = own.place
    symbol = symbols[place]
    starts = ends - sizes + 1
    # Before a text stands the end, as it does at the end of the text before; only the second symbol back is mended.
    last = np.concatenate(([END], symbol[:-1])).astype(np.int32)
    before = np.concatenate(([END], last[:-1])).astype(np.int32)
    before[starts] = END
    return Flow(starts, sizes, place, symbol, before, last)


def symbols_in(words: pa.Array, head: pa.Array) -> np.ndarray:
    """Symbols of distinct words, and at the end that of the end."""
    place = pc.index_in(words, value_set=head).fill_null(-1).to_numpy()
    return np.append(np.where(place >= 0, place, HEAD_WORDS + suffix_classes(words)), END).astype(np.int32)


def count_triples(texts: DataFrame, head: pa.Array) -> np.ndarray:
    """How often symbol s follows symbols a, b, over all texts: an array of SYMBOLS**3 counts, summed over all tasks."""
    schema = pa.schema([("code", pa.int32()), ("n", pa.int64())])
    spoken = head.to_pylist()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = pa.array(spoken, pa.string()), np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for _, part in text_chunks(batch, "t", CHUNK_BYTES):
                words = tokens_of(part)
                flow = flow_of(words, symbols_in(words.distinct, own))
                total += np.bincount((flow.before * SYMBOLS + flow.last) * SYMBOLS + flow.symbol, minlength=len(total))
        found = np.flatnonzero(total)
        yield record_batch(schema, [pa.array(found.astype(np.int32)), pa.array(total[found])])

    added = texts.select("t").mapInArrow(scan, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**3, dtype=np.int64)
    out[added.column(0).to_numpy()] = added.column(1).to_numpy()
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def train(triples: np.ndarray, how: Training | None = None) -> dict[str, np.ndarray]:
    """Fit the model to counts of (before last, last, next) by noise-contrastive estimation.

    Observed successors are told from ``noise`` times as many draws of the unigram distribution; as contexts and
    symbols are few, the expected gradient over all draws is taken in whole matrices instead of by sampling.
    """
    how = how or Training()
    n = triples.shape[0]
    draw = np.random.default_rng(how.seed)
    counts = triples.reshape(n * n, n).astype(np.float32)
    seen = np.flatnonzero(counts.sum(axis=1))
    counts = counts[seen]
    first, second = np.divmod(seen, n)
    total = max(float(counts.sum()), 1.0)
    unigram = (counts.sum(axis=0) + SMOOTH) / (total + SMOOTH * n)
    model = {
        "context": draw.normal(0, 0.1, (n, how.width)).astype(np.float32),
        "target": draw.normal(0, 0.1, (n, how.width)).astype(np.float32),
        "place": np.ones((2, how.width), dtype=np.float32),
        "bias": np.log(unigram).astype(np.float32),
    }
    if not len(seen):
        return model
    observed = counts / total
    noise = how.noise * observed.sum(axis=1, keepdims=True) * unigram[None, :]
    offset = np.log(how.noise * unigram).astype(np.float32)
    one, two = np.eye(n, dtype=np.float32)[first], np.eye(n, dtype=np.float32)[second]
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.items()}
    for step in range(1, how.steps + 1):
        a, b = model["context"][first], model["context"][second]
        predicted = a * model["place"][0] + b * model["place"][1]
        score = predicted @ model["target"].T + model["bias"]
        real = 1 / (1 + np.exp(-(score - offset)))
        slope = observed * (1 - real) - noise * real
        back = slope @ model["target"]
        gradient = {
            "target": slope.T @ predicted,
            "bias": slope.sum(axis=0),
            "context": one.T @ (back * model["place"][0]) + two.T @ (back * model["place"][1]),
            "place": np.stack([(back * a).sum(axis=0), (back * b).sum(axis=0)]),
        }
        rate = how.rate * min(1.0, 2.0 * (1 - step / (how.steps + 1)))
        for k, g in gradient.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            model[k] += (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-8)).astype(np.float32)
    return model


def log_table(model: dict[str, np.ndarray]) -> np.ndarray:
    """log10 P(symbol | before last, last) for all contexts, normalised: a matrix product for each block of contexts."""
    n = len(model["bias"])
    out = np.empty((n, n, n), dtype=np.float32)
    last = model["context"] * model["place"][1]
    for a in range(n):
        score = (model["context"][a] * model["place"][0] + last) @ model["target"].T + model["bias"]
        top = score.max(axis=1, keepdims=True)
        out[a] = (score - top - np.log(np.exp(score - top).sum(axis=1, keepdims=True))) / np.log(10)
    return out


@dataclass
class Scorer:
    """All that a worker needs: the dictionary, its counts, the sizes of the classes and the model."""

    words: pa.Array
    counts: np.ndarray
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_words: np.ndarray
    ends: int
    model: dict[str, np.ndarray]
    tree: Words | None = None

    def __getstate__(self) -> dict:
        """Tables for lookups are built in each worker and don't travel."""
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "near", "far", "symbol", "leaf", "base", "inside")}

    def ready(self) -> Scorer:
        """Tables for lookups, built once in each worker: by place in the dictionary, then unknown words by class, then
        the end of a text."""
        if not hasattr(self, "table"):
            n = len(self.words)
            classes = suffix_classes(self.words)
            symbol = np.where(np.arange(n) < HEAD_WORDS, np.arange(n), HEAD_WORDS + classes)
            self.symbol = np.concatenate((symbol, HEAD_WORDS + np.arange(CLASSES), [END])).astype(np.int32)
            self.base = np.zeros(n + CLASSES + 1)
            self.base[:n] = np.log10((self.counts + SMOOTH) / self.all_mass())
            self.base[-1] = np.log10((self.ends + SMOOTH) / self.all_mass())
            self.inside = np.zeros(n + CLASSES + 1)
            self.inside[HEAD_WORDS:n] = np.log10((self.counts[HEAD_WORDS:] + SMOOTH) / self.class_mass()[classes[HEAD_WORDS:]])
            # The leaf of each place, -1 for words without vectors of their own.
            own = len(self.tree.leaf)
            self.leaf = np.full(n + CLASSES + 1, -1, dtype=np.int64)
            self.leaf[HEAD_WORDS : HEAD_WORDS + own] = self.tree.leaf
            self.inside[HEAD_WORDS : HEAD_WORDS + own] = self.tree.class_share[classes[HEAD_WORDS : HEAD_WORDS + own]]
            self.table = log_table(self.model)
            self.far = self.model["context"] * self.model["place"][0]
            spoken = np.concatenate((np.empty(own, dtype=np.int64), np.arange(SYMBOLS)))
            spoken[self.tree.leaf] = HEAD_WORDS + classes[HEAD_WORDS : HEAD_WORDS + own]
            self.near = (self.model["context"][spoken] + self.tree.fixed()) * self.model["place"][1]
        return self

    def plant(self, words: int, least: int) -> Scorer:
        """Give the most frequent words of at least ``least`` tokens their leaves."""
        n = min(words, int((self.counts[HEAD_WORDS:] >= least).sum()))
        kinds = suffix_classes(self.words.slice(HEAD_WORDS, n)).astype(np.int64)
        self.tree = Words.build(kinds, self.counts[HEAD_WORDS : HEAD_WORDS + n].astype(np.float64), self.class_mass(), SMOOTH, self.model["target"].shape[1], SYMBOLS)
        return self

    def places(self, words: pa.Array, most: int | None = None) -> np.ndarray:
        """Rows of the lookup tables for distinct words, and at the end for the end of a text. Words beyond the ``most``
        most frequent count as unknown ones of their class."""
        n = len(self.words)
        found = pc.index_in(words, value_set=self.words.slice(0, most)).fill_null(-1).to_numpy()
        return np.append(np.where(found >= 0, found, n + suffix_classes(words)), n + CLASSES).astype(np.int64)

    def targets(self, flow: Flow, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tokens with a leaf, their leaves, their last context words) of a flow; ``rows`` of its distinct words."""
        leaves = self.leaf[rows]
        at = np.flatnonzero(leaves[flow.place] >= 0)
        n = len(self.tree.leaf)
        context = np.where(leaves >= 0, leaves, n + self.symbol[rows])[flow.place]
        first = flow.last[at] == END
        last = np.where(first, n + END, context[at - 1])
        return at, leaves[flow.place[at]], last

    def predicted(self, flow: Flow, at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Predicted vectors of the tokens ``at``."""
        return self.far[flow.before[at]] + self.near[last] + self.tree.last[last]

    def log_scores(self, flow: Flow, rows: np.ndarray) -> np.ndarray:
        """log10 P of each token; a word outside the dictionary as all other words of its class together."""
        score = self.table[flow.before, flow.last, flow.symbol] + self.inside[rows][flow.place]
        if len(self.tree.leaf):
            at, leaves, last = self.targets(flow, rows)
            score[at] += self.tree.log_inside(leaves, self.predicted(flow, at, last)) / np.log(10)
        return score

    def all_mass(self) -> float:
        return self.tokens + SMOOTH * (self.distinct + 1)

    def class_mass(self) -> np.ndarray:
        return self.class_tokens + SMOOTH * (self.class_words + 1)


KINDS = ("last", "groups", "words")


def train_words(texts: DataFrame, scorer: Scorer, seed: int) -> None:
    """Train the words' vectors over all texts: each task on its own, rows averaged by the tokens behind them."""
    width = scorer.model["target"].shape[1]
    schema = pa.schema([("kind", pa.int32()), ("row", pa.int32()), ("n", pa.float64()), *((f"v{i}", pa.float32()) for i in range(width + 1))])
    passes = max(1, min(MOST_PASSES, LEAST_TOKENS // max(scorer.tokens, 1)))
    shared = texts.sparkSession.sparkContext.broadcast(scorer)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = replace(shared.value)
        own.tree = replace(own.tree, **{k: np.zeros_like(getattr(own.tree, k)) for k in KINDS})
        own.ready()
        trainer = Trainer(own.tree, seed + TaskContext.get().partitionId())
        if passes > 1:  # a small corpus, held in memory
            batches = list(batches) * passes
        for batch in batches:
            for _, part in text_chunks(batch, "t", STEP_BYTES // (8 if passes > 1 else 1)):
                words = tokens_of(part)
                rows = own.places(words.distinct, HEAD_WORDS + len(own.tree.leaf))
                flow = flow_of(words, own.symbol[rows])
                at, leaves, last = own.targets(flow, rows)
                trainer.batch(leaves, last, own.predicted(flow, at, last))
        for k, kind in enumerate(KINDS):
            rows, value = np.flatnonzero(trainer.seen[kind]), getattr(own.tree, kind)
            for i in range(0, len(rows), 50_000):
                part = rows[i : i + 50_000]
                found = np.zeros((len(part), width + 1), dtype=np.float32)
                found[:, : value.shape[1]] = value[part]
                yield record_batch(schema, [pa.array(np.full(len(part), k, dtype=np.int32)), pa.array(part.astype(np.int32)), pa.array(trainer.seen[kind][part]), *(pa.array(x) for x in found.T.copy())])

    ddl = "kind int, row int, n double, " + ", ".join(f"v{i} float" for i in range(width + 1))
    means = [(F.sum(F.col(f"v{i}") * F.col("n")) / F.sum("n")).cast("float").alias(f"v{i}") for i in range(width + 1)]
    got = texts.select("t").mapInArrow(scan, ddl).groupBy("kind", "row").agg(*means).toArrow()
    which, rows = got.column(0).to_numpy(), got.column(1).to_numpy()
    for k, kind in enumerate(KINDS):
        at, value = np.flatnonzero(which == k), getattr(scorer.tree, kind)
        for i in range(value.shape[1]):
            value[rows[at], i] = got.column(3 - 1 + i).to_numpy()[at]


def learn(texts: DataFrame, how: Training | None = None, dictionary_words: int = DICTIONARY_WORDS, vocabulary_words: int = VOCABULARY_WORDS, least_count: int = LEAST_COUNT) -> tuple[Scorer, DataFrame]:
    """The scorer and the table of all words' counts, from training texts (column t)."""
    counts = cut(count_words(texts), "words")
    words, numbers = frequent_words(counts, dictionary_words)
    ends = texts.count()
    class_tokens, class_words, tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES), ends, int(ends > 0)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():  # 28 rows
        class_tokens[row["class"]], class_words[row["class"]] = row["n"], row["k"]
        tokens, distinct = tokens + row["n"], distinct + row["k"]
    heads = suffix_classes(words.slice(0, HEAD_WORDS))
    np.subtract.at(class_tokens, heads, numbers[:HEAD_WORDS])
    np.subtract.at(class_words, heads, 1)
    model = train(count_triples(texts, words.slice(0, HEAD_WORDS)), how)
    scorer = Scorer(words, numbers, tokens, distinct, class_tokens, class_words, ends, model).plant(vocabulary_words, least_count)
    if len(scorer.tree.leaf):
        train_words(texts, scorer, (how or Training()).seed)
    return scorer, counts


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Training | None = None, dictionary_words: int = DICTIONARY_WORDS, vocabulary_words: int = VOCABULARY_WORDS, least_count: int = LEAST_COUNT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty: its one token is the end. Held-out documents are scored, not learned from; a corpus of
    held-out documents only gives the scores of an untrained model; repeated rows count and stay; an empty table gives
    an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("t"))
    scorer, counts = learn(narrow.where("not held_out"), how, dictionary_words, vocabulary_words, least_count)
    shared = spark.sparkContext.broadcast(scorer)
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("word", pa.string()), ("times", pa.int64()), ("mass", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.ready()
        masses, n_dictionary, ends = own.class_mass(), len(own.words), own.ends
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, part in text_chunks(batch, "t", CHUNK_BYTES):
                words, k = tokens_of(part), len(part)
                rows = own.places(words.distinct)
                flow = flow_of(words, own.symbol[rows])
                unknown = (rows >= n_dictionary) & (rows < n_dictionary + CLASSES)
                has = np.where(rows < n_dictionary, 1, np.where(unknown, 0, int(ends > 0)))
                known, base, score = (np.add.reduceat(x, flow.starts) for x in (has[flow.place], own.base[rows][flow.place], own.log_scores(flow, rows)))
                # Words outside the dictionary, once a document, with how often they stand there.
                at = np.flatnonzero(unknown[flow.place])
                document = np.searchsorted(flow.starts, at, side="right") - 1
                pair, times = np.unique(document * len(rows) + flow.place[at], return_counts=True)
                document, place = pair // len(rows), pair % len(rows)
                m = len(pair)
                nothing = lambda kind, n=m: pa.nulls(n, kind)
                zeros, empty = np.zeros(m), pa.nulls(k, pa.string())
                yield record_batch(schema, [
                    pa.array(rid + np.concatenate((np.arange(k), document))), pa.concat_arrays([batch.column(0).slice(first, k), nothing(pa.int64())]), pa.concat_arrays([batch.column(1).slice(first, k), nothing(pa.bool_())]),
                    pa.concat_arrays([pa.array(flow.sizes), nothing(pa.int64())]), pa.array(np.concatenate((known, zeros)).astype(np.int64)), pa.array(np.concatenate((base, zeros))), pa.array(np.concatenate((score, zeros))),
                    pa.concat_arrays([empty, words.distinct.take(pa.array(place)).cast(pa.string())]), pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(times.astype(np.int64))]), pa.concat_arrays([pa.nulls(k, pa.float64()), pa.array(masses[rows[place] - n_dictionary])]),
                ])
                rid += k

    kind = "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, word string, times long, mass double"
    rows = narrow.mapInArrow(scan, kind)
    # Words outside the dictionary meet their counts; rows without a word get a key of their own, so none is hot.
    keyed = rows.withColumn("join_word", F.coalesce("word", F.concat(F.lit(" "), F.col("rid").cast("string"))))
    met = keyed.join(counts.select(F.col("word").alias("counted"), "n"), F.col("join_word") == F.col("counted"), "left")
    c = F.coalesce("n", F.lit(0)).cast("double") + SMOOTH
    is_tail = F.col("word").isNotNull()
    partial = met.select(
        "rid", "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.when(is_tail & F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
        (F.col("base") + F.when(is_tail, F.col("times") * F.log10(c / F.lit(scorer.all_mass()))).otherwise(0.0)).alias("base"),
        (F.col("score") + F.when(is_tail, F.col("times") * F.log10(c / F.col("mass"))).otherwise(0.0)).alias("score"),
    )
    whole = partial.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(scorer.tokens).cast("long").alias("train_tokens"), "base_score", "score")
