"""Texts and lines of a megabyte through every operator."""

import random

import pytest

from tests.llm.helpers import DDL
from tidemark.llm import decontam, langid, licenses, linededup, lm, mixing, quality, sharding, simhash, tokens

RNG = random.Random(2)
WORDS = [f"word{i}" for i in range(5000)]
TEXTS = {
    1: " ".join(RNG.choice(WORDS) for _ in range(150_000)),
    2: "go " * 350_000,
    3: "x" * 1_000_000,
    4: "\n" * 1_000_000,
    5: "\n".join(f"short line {i}." for i in range(15_000)),
} | {i: " ".join(RNG.choice(WORDS) for _ in range(30)) + "." for i in range(6, 12)}
N_WORDS = {i: len(t.split()) for i, t in TEXTS.items()}
N_LINES = {i: sum(bool(x.strip()) for x in t.split("\n")) for i, t in TEXTS.items()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in TEXTS.items()], DDL)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_counts_of_large_texts(spark, docs):
    found = by_id(quality.quality_table(docs))
    assert {i: r.n_words for i, r in found.items()} == N_WORDS
    assert found[2].base_failed and found[2].n_clean_words == 0 and found[5].n_clean_words == N_WORDS[5]
    assert {i: r.size for i, r in by_id(mixing.mix_table(docs)).items()} == N_WORDS
    assert {i: r.size for i, r in by_id(sharding.shard_table(docs)).items()} == {i: len(t) + 1 for i, t in TEXTS.items()}
    assert by_id(licenses.license_table(docs))[5].n_sentences == 15_000


def test_models_of_large_texts(spark, docs):
    scored = by_id(lm.score_documents(docs, how=lm.Training(steps=5)))
    assert {i: r.n_tokens for i, r in scored.items()} == {i: n + 1 for i, n in N_WORDS.items()}
    assert all(r.score < 0 for r in scored.values())
    named = by_id(langid.language_table(docs))
    assert named[4].lang_pred == "und" and named[1].lang_pred == "en"
    sizes = by_id(tokens.token_table(docs))
    assert sizes[2].n_tokens == len(tokens.encoder(tokens.VOCABULARY).tokenizer.encode(TEXTS[2], add_special_tokens=False).ids) + 1


def test_copies_of_large_texts(spark, docs):
    prints = by_id(simhash.simhash_groups(docs))
    assert prints[4].fingerprint == "0" * 16 and len({r.component_id for r in prints.values()}) == len(TEXTS)
    twice = docs.unionAll(docs.selectExpr("doc_id + 100", "concat(text, ' end')", "lang", "source", "n_chars"))
    kept = {r.doc_id for r in simhash.keep_one_per_group(twice).collect()}
    assert {1, 5} <= kept and not {101, 105} & kept
    lines = by_id(linededup.line_table(docs))
    assert {i: r.n_lines for i, r in lines.items()} == N_LINES
    # A changed digit is too much for a line of 18 characters.
    assert lines[1].n_kept == lines[2].n_kept == lines[3].n_kept == 1 and lines[5].n_kept == 15_000


def test_windows_in_large_texts(spark, docs):
    bench = spark.createDataFrame([(1, " ".join(TEXTS[1].split()[70_000:70_020])), (2, "go " * 12), (3, "x" * 1_000_000)], "item_id long, text string")
    found = by_id(decontam.contamination_table(docs, bench))
    assert {i: r.n_words for i, r in found.items()} == N_WORDS
    assert found[1].n_hit >= 20 and found[2].n_hit == N_WORDS[2] and found[3].n_hit == 1 and not found[5].contaminated
