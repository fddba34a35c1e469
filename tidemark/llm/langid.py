"""Language identification by interpolated Kneser-Ney character models.

One model per language, of character n-grams up to four, kept in sorted arrays of 64-bit n-gram codes that lookups
search by bisection. A text gets the language whose model gives it the lowest cross-entropy per character. Texts
that no model finds likely enough are rejected, at a level calibrated on labelled texts the models have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, crc_text, record_batch

UNKNOWN = "und"
#: Fixed by the task: one in three documents is held out.
HOLD_OUT = 3
ORDER = 4
#: Four symbols fill a 64-bit code, so there are more of them than letters in all scripts of Unicode's basic plane. Every
#: letter of the labelled sample has its own; 0 stands for all that is no letter, one more for letters never labelled.
BITS = 16
SYMBOLS = 1 << BITS
#: Labelled documents of a language that may be sampled to fit its model, and to calibrate rejection.
FIT_DOCUMENTS = 400
CALIBRATE_DOCUMENTS = 100
#: Sampled documents have at most so many bytes: longer ones would fill the driver and teach no more.
SAMPLE_BYTES = 64 << 10
#: Rejection: a text may lie above its language's mean by so many times what the calibration's texts and their excerpts
#: lie above it, in standard deviations, and by LEAST_DEVIATIONS at least.
MARGIN = 1.5
LEAST_DEVIATIONS = 10.0
#: Lengths (symbols) of the excerpts that calibration takes from the starts of texts.
EXCERPTS = (10, 20, 40, 80, 160)
CHUNK_BYTES = 2 << 20


def held_out(key: Column) -> Column:
    """Whether a document is held out; a null id counts as the empty text."""
    return F.pmod(crc_text(key), F.lit(HOLD_OUT)) == 1


def letter_table(alphabet: list[str]) -> np.ndarray:
    """Code point -> symbol; letters outside the alphabet share the symbol after its last."""
    points = np.arange(0x110000, dtype=np.uint32).view("<U1")
    table = np.where(np.char.isalpha(points), len(alphabet) + 1, 0).astype(np.uint16)
    for i, letter in enumerate(alphabet, start=1):
        table[ord(letter)] = i
    return table


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a lower-cased text: runs of other characters count as one 0, also before and after the text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    framed = np.concatenate(([0], table[codes], [0])).astype(np.uint16)
    keep = np.ones(len(framed), dtype=bool)
    keep[1:] = (framed[1:] != 0) | (framed[:-1] != 0)
    return framed[keep]


def _last(code: np.ndarray, k: int) -> np.ndarray:
    """Codes of the last k symbols."""
    return code & np.uint64((1 << BITS * k) - 1)


def grams(symbols: np.ndarray, order: int) -> np.ndarray:
    """Codes of the n-grams that end at each symbol but the first; before the text stand zeros."""
    padded = np.concatenate((np.zeros(order - 2, dtype=np.uint64), symbols.astype(np.uint64))) if order > 1 else symbols.astype(np.uint64)
    n = len(symbols) - 1
    code = np.zeros(n, dtype=np.uint64)
    for i in range(order):
        start = len(padded) - n - (order - 1) + i
        code = (code << np.uint64(BITS)) | padded[start : start + n]
    return code


@dataclass
class KneserNey:
    """One language's model: for each order, sorted n-gram codes with their discounted share, and of their contexts
    the weight that goes to the next lower order. Below the first order all of ``size`` symbols are equally likely."""

    codes: list[np.ndarray] = field(default_factory=list)
    shares: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    size: int = SYMBOLS

    @classmethod
    def fit(cls, texts: list[np.ndarray], order: int = ORDER, size: int = SYMBOLS) -> KneserNey:
        """Counts of the highest order are occurrences; those of a lower one are distinct left neighbours."""
        model = cls(size=size)
        own = np.concatenate([grams(t, order) for t in texts]) if texts else np.empty(0, np.uint64)
        code, n = np.unique(own, return_counts=True)
        levels = [(code, n)]
        for k in range(order - 1, 0, -1):
            code, n = np.unique(_last(levels[0][0], k), return_counts=True)
            levels.insert(0, (code, n))
        for code, n in levels:
            once, twice = int((n == 1).sum()), int((n == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context, place = np.unique(code >> np.uint64(BITS), return_inverse=True)
            total = np.bincount(place, weights=n).astype(np.float64) if len(code) else np.empty(0)
            kinds = np.bincount(place) if len(code) else np.empty(0)
            model.codes.append(code)
            model.shares.append((n - discount) / total[place] if len(code) else np.empty(0))
            model.contexts.append(context)
            model.weights.append(discount * kinds / total if len(code) else np.empty(0))
        return model

    def log2(self, code: np.ndarray) -> np.ndarray:
        """log2 of the probability of the last symbol of each n-gram code, given the symbols before it."""
        code, chance = code.astype(np.uint64), np.full(len(code), 1.0 / self.size)
        for k, (codes, shares, contexts, weights) in enumerate(zip(self.codes, self.shares, self.contexts, self.weights, strict=True), start=1):
            own = _last(code, k)
            chance = _found(codes, shares, own, 0.0) + _found(contexts, weights, own >> np.uint64(BITS), 1.0) * chance
        return np.log2(chance)


def _found(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, default: float) -> np.ndarray:
    """Bisection in a sorted array."""
    if not len(keys):
        return np.full(len(asked), default)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], default)


@dataclass
class Identifier:
    """The models, and for each language the calibrated cross-entropy: its mean, the deviation of documents and that of
    single characters, and how many of them a text may lie above the mean."""

    languages: list[str]
    alphabet: list[str]
    models: list[KneserNey]
    mean: np.ndarray
    spread: np.ndarray
    grain: np.ndarray
    most: np.ndarray

    def __getstate__(self) -> dict:
        """The lookup table is built in each worker and doesn't travel."""
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    def ready(self) -> Identifier:
        if not hasattr(self, "table"):
            self.table = letter_table(self.alphabet)
        return self

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(characters, bits per character in each language) of each text; 0 characters: no letter."""
        own = self.ready()
        symbols = [symbols_of(t, own.table) for t in texts]
        codes = [grams(s, ORDER) if len(s) > 1 else np.empty(0, np.uint64) for s in symbols]
        sizes = np.array([len(c) for c in codes])
        bits = np.zeros((len(texts), len(own.languages)))
        if not sizes.sum():
            return sizes, bits
        # Each distinct n-gram of the batch is looked up once.
        coded = pa.array(np.concatenate(codes)).dictionary_encode()
        distinct, place = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        full = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[full]
        for j, model in enumerate(own.models):
            bits[full, j] = np.add.reduceat(model.log2(distinct)[place], starts) / -sizes[full]
        return sizes, bits

    def above(self, language: np.ndarray | int, bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many standard deviations a text of that size is above the mean of its language."""
        return (bits - self.mean[language]) / np.sqrt(self.spread[language] ** 2 + self.grain[language] ** 2 / np.maximum(sizes, 1))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score from 0 to 1, rejected) of each text: its share of the languages' likelihoods per character,
        sharpened by the text's length. Null texts and texts without letters are unknown and rejected, score 0."""
        sizes, bits = self.entropies([t or "" for t in texts])
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        best = bits.argmin(axis=1)
        rows = np.arange(len(texts))
        gap = (bits - bits[rows, best][:, None]) * np.minimum(sizes, 200)[:, None]
        score = 1.0 / np.exp2(-gap).sum(axis=1)
        unknown = sizes == 0
        rejected = unknown | (self.above(best, bits[rows, best], sizes) > self.most[best])
        names = [UNKNOWN if u else self.languages[b] for u, b in zip(unknown.tolist(), best.tolist(), strict=True)]
        return names, np.where(unknown, 0.0, np.clip(score, 0.0, 1.0)), rejected


def training_sample(docs: DataFrame, key: str, text: str, lang: str) -> list[tuple[str, str]]:
    """(lang, text) of at most FIT_DOCUMENTS + CALIBRATE_DOCUMENTS labelled documents a language, the first in a
    shuffle by a hash of id and text, without the documents held out. Whole texts of at most SAMPLE_BYTES; the bounds are
    the sample's only."""
    most = FIT_DOCUMENTS + CALIBRATE_DOCUMENTS
    labelled = docs.where(~held_out(F.col(key)) & F.col(lang).isNotNull() & (F.octet_length(F.col(text)) <= SAMPLE_BYTES) & F.col(text).rlike(r"\p{L}"))
    picked = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(1 << 40)).alias("h"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return []
    # A share of each language's hashes with about twice the documents wanted, then the first of them by hash.
    near = F.lit(False)
    for name, n in sizes.items():
        near = near | ((F.col("lang") == name) & (F.col("h") < min(1 << 40, int((1 << 40) * (1.3 * most + 40) / n))))
    rows = sorted(((r["lang"], r["h"], r["text"]) for r in picked.where(near).collect()), key=lambda r: (r[0], r[1], r[2]))
    taken: dict[str, int] = {}
    out = []
    for name, _, body in rows:
        taken[name] = taken.get(name, 0) + 1
        if taken[name] <= most:
            out.append((name, body))
    return out


def fit(sample: list[tuple[str, str]]) -> Identifier:
    """Models from the sample's first documents of each language, levels of rejection from the rest."""
    counts: dict[str, int] = {}
    by_lang: dict[str, list[str]] = {}
    for name, text in sample:
        by_lang.setdefault(name, []).append(text)
        for letter in text.lower():
            counts[letter] = counts.get(letter, 0) + 1
    letters = sorted((x for x in counts if x.isalpha()), key=lambda x: (-counts[x], x))[: SYMBOLS - 2]
    table, size = letter_table(letters), len(letters) + 2
    languages = sorted(by_lang)
    models, kept = [], []
    for name in languages:
        texts = by_lang[name]
        # Every fifth document calibrates; a language of few documents calibrates on those it was fitted to.
        rest = texts[::5] if len(texts) >= 10 else texts
        fitted = [t for i, t in enumerate(texts) if i % 5] if len(texts) >= 10 else texts
        models.append(KneserNey.fit([symbols_of(t, table) for t in fitted], size=size))
        kept.append(rest)
    own = Identifier(languages, letters, models, *(np.zeros(len(languages)) for _ in range(4)))
    for j, rest in enumerate(kept):
        flows = [x for x in (symbols_of(t, table) for t in rest) if len(x) > 1]
        single = [-models[j].log2(grams(x, ORDER)) for x in flows]
        sizes, bits = np.array([len(x) for x in single]), np.array([x.mean() for x in single])
        if not len(sizes):
            own.mean[j], own.spread[j], own.grain[j], own.most[j] = 6.0, 0.5, 2.5, LEAST_DEVIATIONS
            continue
        weight = np.minimum(sizes, 1000)
        own.mean[j] = np.average(bits, weights=weight)
        long = sizes >= 200
        own.spread[j] = max(0.05, float(bits[long].std()) if long.any() else 0.5)
        own.grain[j] = max(0.5, float(np.concatenate(single).std()))
        # The level is set on whole texts and on their excerpts, so that short texts fare no worse than long ones.
        parts = [(len(x[:n]), x[:n].mean()) for x in single for n in (len(x), *EXCERPTS) if n <= len(x)]
        worst = own.above(j, np.array([m for _, m in parts]), np.array([n for n, _ in parts])).max()
        own.most[j] = max(LEAST_DEVIATIONS, MARGIN * float(worst))
    return own


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Identifier:
    return fit(training_sample(docs, key, text, lang))


def language_table(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", model: Identifier | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    Null texts and texts without a letter are 'und' with score 0; with nothing labelled to learn from, all are.
    Predictions read the text only; repeated rows get equal rows; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model or train(docs, key, text, lang))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            names, scores, rejected = _by_chunks(own, batch.column(2).to_pylist())
            yield record_batch(schema, [batch.column(0), batch.column(1), names, scores, rejected])

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("t"))
    return narrow.mapInArrow(scan, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def _by_chunks(own: Identifier, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    names, scores, rejected = [], [], []
    for a, b in chunks(texts, CHUNK_BYTES // 2):
        n, s, r = own.predict(texts[a:b])
        names += n
        scores.append(s)
        rejected.append(r)
    return names, np.concatenate(scores or [np.empty(0)]), np.concatenate(rejected or [np.empty(0, bool)])


def drop_rejected(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", model: Identifier | None = None) -> DataFrame:
    """``docs`` without the documents whose language is rejected; whole batches pass, nothing is shuffled.

    Null texts and texts without a letter go; with nothing labelled to learn from, all do; repeated rows fare alike; an
    empty table gives an empty one; other columns come back as they were.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, key, text, lang))
    place = [n.lower() for n in docs.columns].index(text.lower())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, rejected = _by_chunks(shared.value, batch.column(place).to_pylist())
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)
