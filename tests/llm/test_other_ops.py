"""Language-model scores, licence scans, line dedup and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import DDL, corpus, frame
from tidemark.llm import bands, graph, licenses, linededup, lm, sieve

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def out(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 10 == 0


# --- 3: language model


@pytest.mark.parametrize("dictionary_words", [300_000, 12])
def test_scores_of_the_base(spark, dictionary_words):
    """A dictionary of a few words sends the others through the join; the sums must not care."""
    rows = corpus(n=150)
    got = lm.score_documents(frame(spark, rows), how=lm.Training(steps=20), dictionary_words=dictionary_words).collect()
    counts = Counter()
    for i, text, *_ in rows:
        if not out(i):
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, text, *_ in rows:
        own = [*words(text), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        want.setdefault(i, []).append((out(i), len(own), sum(counts[w] > 0 for w in own), n, pytest.approx(base)))
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == want[r.doc_id][0]
        assert r.score < 0


def test_model_scores_better_than_the_base_on_held_out_text(spark):
    rows = [r for r in corpus(seed=8, n=400) if r[0] is not None and 0 <= r[0] < 400]
    got = [r for r in lm.score_documents(frame(spark, rows)).collect() if r.held_out]
    assert len(got) > 20
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_empty_corpus(spark):
    assert lm.score_documents(spark.createDataFrame([], DDL)).collect() == []


MARKS = set(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def letter_class(word):
    own = list(word)
    while own and own[-1] in MARKS:
        own.pop()
    last = own[-1] if own else 0
    return last - 97 if 97 <= last <= 122 else 26 if last >= 128 else 27


def log_softmax(scores):
    top = max(scores)
    total = math.log(sum(math.exp(x - top) for x in scores))
    return [x - top - total for x in scores]


def slow_score(scorer, counts, text):
    """log10 probability of a text, word by word and row by row, from the model's parameters."""
    head = [w.encode() for w in scorer.words.to_pylist()[: lm.HEAD_WORDS]]
    vocabulary = [w.encode() for w in scorer.words.to_pylist()[lm.HEAD_WORDS : lm.HEAD_WORDS + len(scorer.tree.leaf)]]
    model, tree, fixed = scorer.model, scorer.tree, scorer.tree.fixed()
    symbol = lambda w: lm.END if w is None else head.index(w) if w in head else lm.HEAD_WORDS + letter_class(w)
    total, flow = 0.0, [None, None, *words(text), None]
    for before, last, word in zip(flow, flow[1:], flow[2:], strict=False):
        b, l, s = symbol(before), symbol(last), symbol(word)
        q = model["context"][b] * model["place"][0] + model["context"][l] * model["place"][1]
        total += log_softmax([float(q @ model["target"][i] + model["bias"][i]) for i in range(lm.SYMBOLS)])[s] / math.log(10)
        if lm.HEAD_WORDS <= s < lm.END:
            c = s - lm.HEAD_WORDS
            mass = scorer.class_tokens[c] + 0.1 * (scorer.class_words[c] + 1)
            if word not in vocabulary:
                total += math.log10((counts[word] + 0.1) / mass)
                continue
            leaf = int(tree.leaf[vocabulary.index(word)])
            unit = int(tree.leaf[vocabulary.index(last)]) if last in vocabulary else len(vocabulary) + l
            q = model["context"][b] * model["place"][0] + (model["context"][l] + fixed[unit]) * model["place"][1] + tree.last[unit]
            mates = {w: int(tree.leaf[i]) for i, w in enumerate(vocabulary) if letter_class(w) == c}
            total += math.log10(sum(counts[w] + 0.1 for w in mates) / mass)
            groups = sorted({int(tree.group[x]) for x in mates.values()})
            inside = {g: [x for x in sorted(mates.values()) if tree.group[x] == g] for g in groups}
            named = {x: w for w, x in mates.items()}
            weight = {g: sum(counts[named[x]] + 0.1 for x in inside[g]) for g in groups}
            own = int(tree.group[leaf])
            total += log_softmax([float(q @ tree.groups[g, :-1] + tree.groups[g, -1]) + math.log(weight[g]) for g in groups])[groups.index(own)] / math.log(10)
            total += log_softmax([float(q @ tree.words[x, :-1] + tree.words[x, -1]) + math.log(counts[named[x]] + 0.1) for x in inside[own]])[inside[own].index(leaf)] / math.log(10)
    return total


def training(docs):
    from pyspark.sql import functions as F

    return docs.where(~lm.held_out(F.col("doc_id"))).select(F.col("text").alias("t"))


def rich_rows(n=120):
    """Texts of 400 words in several classes, and the odd cases."""
    rng = np.random.default_rng(5)
    names = [f"{'abcdeé!'[i % 7]}{i}{'aes!é'[i % 5]}" for i in range(400)]
    pick = lambda: int(min(399, rng.zipf(1.3)))
    return [(i, " ".join(names[pick()] for _ in range(60)), "en", "s", 1) for i in range(n)] + [r for r in corpus(n=12) if r[0] != 1008]


@pytest.mark.parametrize(("dictionary", "vocabulary"), [(300_000, 16_384), (150, 40), (120, 0)])
def test_scores_against_a_slow_model(spark, dictionary, vocabulary):
    """The model is learned twice from the same data; its scores equal those of single words looked up one by one."""
    rows = rich_rows()
    docs = frame(spark, rows)
    how = lm.Training(steps=15)
    scorer, table = lm.learn(training(docs), how, dictionary, vocabulary, 3)
    assert len(scorer.tree.leaf) > 40 or vocabulary < 50
    counts = Counter({r.word.encode(): r.n for r in table.collect()})
    got = {}
    for r in lm.score_documents(docs, how=how, dictionary_words=dictionary, vocabulary_words=vocabulary, least_count=3).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    chosen = rows[:6] + rows[-12:]
    for i, text, *_ in chosen:
        assert got[i][0] == pytest.approx(slow_score(scorer, counts, text), rel=2e-3, abs=1e-3)


def test_all_words_sum_to_one_after_any_context(spark):
    docs = frame(spark, rich_rows())
    scorer, table = lm.learn(training(docs), lm.Training(steps=10), 150, 60, 3)
    counts = Counter({r.word.encode(): r.n for r in table.collect()})
    spoken = [w.decode() for w in counts]
    unseen = ["?" + c for c in "abcdefghijklmnopqrstuvwxyzé!"]
    for context in (f"{spoken[3]} {scorer.words[110].as_py()}", "unseen words?"):
        start = slow_score(scorer, counts, context)
        # The score of a text less its end, then each next word: P(w | context) x P(end | ...) / P(end | context).
        from pyarrow import array, string

        texts = [f"{context} {w}" for w in [*spoken, *unseen]]
        own = scorer.ready()
        part = lm.tokens_of(array(texts, string()))
        rows = own.places(part.distinct)
        flow = lm.flow_of(part, own.symbol[rows])
        logs = own.log_scores(flow, rows)
        at = flow.starts + 2
        in_table = rows[flow.place[at]] < len(own.words)
        outside = [0.0 if known else math.log10((counts[w.encode()] + 0.1) / own.class_mass()[letter_class(w.encode())]) for w, known in zip([*spoken, *unseen], in_table, strict=True)]
        end = float(own.table[flow.before[2], flow.last[2], lm.END])
        missing = sum(10 ** float(own.table[flow.before[2], flow.last[2], i]) for i in range(len(scorer.words), lm.HEAD_WORDS))
        assert (10 ** (logs[at] + outside)).sum() + 10**end + missing == pytest.approx(1.0, abs=1e-4)
        assert start < 0


def test_frequent_words_are_contexts_and_targets_of_their_own(spark):
    """All words beyond the head end in "a": only vectors of their own tell which word follows which."""
    rng = np.random.default_rng(4)
    names = [f"w{i:03d}a" for i in range(400)]
    rows = []
    for i in range(1500):
        own = [x for k in rng.integers(0, 200, 40) for x in (names[k], names[k + 200])]
        rows.append((i, " ".join(own), "en", "s", 1))
    docs = frame(spark, rows)
    assert len(lm.learn(training(docs), least_count=10**6)[0].tree.leaf) == 0
    scorer, _ = lm.learn(training(docs))
    assert len(scorer.tree.leaf) == 400 - lm.HEAD_WORDS
    scores = {c: np.mean([r.score / r.n_tokens for r in lm.score_documents(docs, least_count=c).collect() if r.held_out]) for c in (50, 10**6)}
    assert scores[50] > scores[10**6] + 0.03


def test_tokens_follow_the_rule():
    import pyarrow as pa

    texts = ["A b\tC\x0bd\x0ce\rf\ng", None, "", " \n ", "  x  Y ", "\x1c\x85\u00a0É a", "same same"]
    own = lm.tokens_of(pa.array(texts, pa.string()))
    spoken = [w.encode() for w in own.distinct.to_pylist()]
    ends = np.cumsum(own.sizes)
    for text, a, b in zip(texts, ends - own.sizes, ends, strict=True):
        assert [spoken[i] for i in own.place[a:b]] == words(text)
    some = [w for t in texts for w in words(t)] + [b"...", b"x!", "é".encode(), b"9", b"Z"]
    assert lm.suffix_classes(pa.array([w.decode() for w in some])).tolist() == [letter_class(w) for w in some]


def test_triples_are_counted_within_texts(spark):
    import pyarrow as pa

    table = spark.createDataFrame([("a b a",), (None,), ("a b",)], "t string")
    got = lm.count_triples(table, pa.array(["a", "b"]))
    e = lm.END
    want = {(e, e, 0): 2, (e, 0, 1): 2, (0, 1, 0): 1, (1, 0, e): 1, (e, e, e): 1, (0, 1, e): 1}
    assert {tuple(map(int, k)): int(got[tuple(k)]) for k in np.argwhere(got)} == want


# --- 6: licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


BSD = """Copyright (c) 2001, somebody. All rights of the kind are theirs.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of {who} nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""


@pytest.mark.parametrize(
    ("text", "want", "rest"),
    [
        (MIT, ["MIT"], []),
        ("Some words.\nReleased under the MIT License.\nMore words.", ["MIT"], []),
        ("words without a stop\nLicensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"], []),
        ("Licensed under the Apache License, Version 2.0. All rights reserved.", ["Apache-2.0", "all-rights-reserved"], []),
        ("THIS WORK IS LICENCED UNDER THE GNU GENERAL PUBLIC LICENCE, VERSION 3!", ["GPL-3.0-only"], []),
        (MIT.split("\n\n")[1], [], ["mit-notice"]),
        ("We talked about the MIT License yesterday.", [], []),
        ("The tool is a small one, released by its authors under the terms of the MIT License since 2019.", ["MIT"], []),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;", ["MIT", "Apache-2.0"], []),
        ("# spdx-license-identifier: GPL-3.0-or-later", ["GPL-3.0-or-later"], []),
        (BSD.format(who="the ACME Corporation"), ["BSD-3-Clause"], []),
        (BSD.format(who="the copyright holder"), ["BSD-3-Clause"], []),
        (BSD.replace("Neither", "A clause of which nobody knows permits no redistribution here.\nNeither").format(who="X"), [], ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"]),
        ("Frob is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nFrob is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", ["GPL-3.0-or-later"], []),
        ("Available under LGPL v2.1 and distributed under the GNU General Public License version 2.", ["LGPL-2.1-only", "GPL-2.0-only"], []),
        ("Licensed under the mitten license.", [], []),
        ("", [], []),
        (None, [], []),
    ],
)
def test_licences_of_a_text(text, want, rest):
    _, found = licenses.sentence_ids(text)
    assert licenses.match_rules([x for x, _ in found]) == (want, rest)


def test_every_known_sentence_is_found():
    table, _, _, _, spelt = licenses._known()
    assert all(licenses._HINT.search(x) for x in table) and all(n == licenses.normalise(n) for n in spelt if "licence" not in n)
    assert all(licenses._HINT.search(n) for n in spelt)
    for name, sentences in licenses.SENTENCES.items():
        for sentence in sentences:
            filled = sentence.replace(licenses.SLOT, "Some Name and Company")
            assert {x for x, _ in licenses.sentence_ids(f"Before it.\n{filled}\nAfter it.")[1]} == {name}, sentence


def slow_normal(text):
    out = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789." else " " for c in text.lower().replace("licence", "license"))
    return " ".join(out.split()).strip(" .")


def slow_sentences(text):
    """Cut after . ; : ! ? before white space, and at blank lines; character by character."""
    out, own, i = [], "", 0
    while i < len(text):
        if text[i].isspace():
            j = i
            while j < len(text) and text[j].isspace():
                j += 1
            if (own and own[-1] in ".;:!?") or text[i:j].count("\n") > 1:
                out.append(own)
                own, i = "", j
                continue
        own += text[i]
        i += 1
    return [*out, own]


def slow_matches(rule, words):
    """Whether the words are a sentence of the catalogue, whose slots take one to twelve words."""
    if not rule:
        return not words
    if rule[0] == "*":
        return any(slow_matches(rule[1:], words[n:]) for n in range(1, min(12, len(words)) + 1))
    return bool(words) and words[0] == rule[0] and slow_matches(rule[1:], words[1:])


def slow_ids(text):
    """Identifiers of sentences and statements, in order, by going through the whole catalogue for each sentence."""
    rules = {}
    for name, sentences in licenses.SENTENCES.items():
        for sentence in sentences:
            for part in slow_sentences(sentence):
                rule = tuple(w for i, x in enumerate(part.split("[*]")) for w in ([] if not i else ["*"]) + slow_normal(x).split())
                if len([w for w in rule if w != "*"]) > 2:
                    rules.setdefault(rule, set()).add(name)
    names = {n: spdx for spdx, own in licenses.NAMES.items() for n in own}

    def whole(words):
        return next((next(iter(own)) for rule, own in rules.items() if len(own) == 1 and slow_matches(rule, words)), None)

    out = []
    for part in slow_sentences(text or ""):
        words = slow_normal(part).split()
        own = whole(words)
        lines = [whole(slow_normal(line).split()) for line in part.split("\n")] if "\n" in part else []
        found = [own] if own else [n for n in lines if n]
        if not own:
            if found:
                words = slow_normal("\n".join(line for line, n in zip(part.split("\n"), lines, strict=True) if not n)).split()
            at = 0
            while at < len(words):
                step = 1
                if words[at] in licenses.STATED:
                    for under in range(at + 1, min(at + 8, len(words))):
                        rest = words[under + 1 :]
                        hits = [(len(n), len(a.split()) + len(n.split()), names[n]) for a in licenses.ARTICLES for n in names if words[under] == "under" and rest[: len(a.split()) + len(n.split())] == a.split() + n.split()]
                        if hits:
                            found.append("name:" + max(hits)[2])
                            step = under + 1 + max(hits)[1] - at
                            break
                at += step
        for name in found:
            if not (out and out[-1] == name):
                out.append(name)
    return out


def test_sentences_against_a_slow_matcher():
    """Texts of catalogue sentences with filled slots, statements and other words, wrapped and spelt in several ways."""
    import random

    rng = random.Random(3)
    every = [s for own in licenses.SENTENCES.values() for s in own]
    said = [f"{v} under {a}{n}" for v in licenses.STATED for a in licenses.ARTICLES[:6] for own in licenses.NAMES.values() for n in own]
    other = ["The river runs under the stone house.", "Words without an end", "It is licensed to nobody.", "See the license file for more of this here.", "Copyright (c) 2020 Somebody.", "Released under pressure.", "1.", "http://example.org/licenses/x"]
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(1, 6)):
            part = rng.choice([rng.choice(every), rng.choice(said), f"This tool is {rng.choice(said)} since 2019.", rng.choice(other)])
            part = part.replace("[*]", " ".join(["Acme"] * rng.choice([1, 2, 12])))
            part = rng.choice([part, part.upper(), part.replace("license", "licence"), part.replace(" of ", "\nof ")])
            parts.append(part + rng.choice([".", "", "!"]))
        text = "".join(p + rng.choice(["\n", "\n\n", " "]) for p in parts)
        fast = [x for x, _ in licenses.sentence_ids(text)[1] if x != licenses.UNKNOWN]
        assert [x for i, x in enumerate(fast) if not i or fast[i - 1] != x] == slow_ids(text), text


def test_license_table(spark):
    rows = [*corpus(), (7000, MIT, "en", "s0", 1), (7001, corpus()[4][1] + "\nAll rights reserved.", "en", "s0", 1)]
    got = {r.doc_id: r for r in licenses.license_table(frame(spark, rows)).collect()}
    assert got[7000].licenses == "MIT" and got[7001].licenses == "all-rights-reserved"
    assert all(r.licenses == "" and r.n_license_sentences == 0 for i, r in got.items() if i not in (7000, 7001))
    assert got[1000].n_sentences == got[1001].n_sentences == 0
    assert licenses.license_table(spark.createDataFrame([], DDL)).collect() == []


# --- 10: lines


def slow_shingles(line):
    return {line[i : i + 7] for i in range(max(1, len(line) - 6))}


def slow_lines(rows):
    """The lines that stay, of rows (id, text), with all pairs compared."""
    own = [(i is None, i or 0, k, n, linededup.normal_form(line)) for k, (i, t) in enumerate(rows) for n, line in enumerate((t or "").encode().split(b"\n"))]
    own = [x for x in own if x[4]]
    sets = [slow_shingles(x[4].decode()) for x in own]
    root = list(range(len(own)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(own)):
        for j in range(i):
            if own[i][4] == own[j][4] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    first = {}
    for i, x in enumerate(own):
        first[find(i)] = min(first.get(find(i), x), x)
    kept = Counter()
    for k, (i, t) in enumerate(rows):
        lines = [x for x in own if x[2] == k]
        kept[i, len(lines), ",".join(str(x[3]) for x in lines if x in first.values())] += 1
    return kept


@pytest.mark.parametrize(("block", "shingles", "bits"), [(256, 1 << 20, 1 << 27), (2, 40, 1 << 15)])
def test_line_table(spark, monkeypatch, block, shingles, bits):
    """Small blocks deal keys to pairs of blocks; a bitmap of few bits lets other rows pass, which the joins sort out."""
    monkeypatch.setattr(bands, "BLOCK", block)
    monkeypatch.setattr(bands, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(sieve, "BITS", bits)
    long = "a line of many words that tells a long story about rivers, stones and light in the house of the under walks"
    rows = [(i, t) for i, t, *_ in corpus()]
    rows += [(8000 + k, f"{long} {'x' * k}\nown line number {k} of this document here") for k in range(12)]
    odd = "Ünïcödé lïnés äré möré thän bÿtés, änd thréé ör föür bÿtés 中文 \U0001f600 täké önly öné plâcé"
    rows += [(8050, odd + "\n" + odd.replace("täké", "tâké")), (8051, odd.lower())]
    rows += [(8100, long.upper() + "\n\n" + long + "  "), (8101, "x\ny\nx")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DDL).coalesce(1)
    got = Counter((r.doc_id, r.n_lines, r.kept_lines) for r in linededup.line_table(docs).collect())
    assert got == slow_lines(rows)
    assert linededup.line_table(spark.createDataFrame([], DDL)).collect() == []


def test_texts_without_repeated_lines(spark):
    docs = spark.createDataFrame([(1, "one line here\n\ntwo", None, None, None), (2, "ONE line  here\nthree", None, None, None), (3, None, None, None, None)], DDL)
    assert {r.doc_id: r.text for r in linededup.drop_repeated_lines(docs).collect()} == {1: "one line here\n\ntwo", 2: "three", 3: ""}
    rows = [(5, "same line here\nand one more line", None, None, None)] * 3 + [(None, "same line here\nlast line of all", None, None, None)] * 2
    got = Counter((r.doc_id, r.text) for r in linededup.drop_repeated_lines(spark.createDataFrame(rows, DDL)).collect())
    assert got == {(5, rows[0][1]): 1, (5, ""): 2, (None, "last line of all"): 1, (None, ""): 1}


def test_bands_catch_pairs_at_the_threshold():
    """Recall of the bands at a similarity of 0.8 to 0.9, measured against brute force."""
    draw = np.random.default_rng(4)
    lines, pairs = [], []
    for _ in range(400):
        own = bytes(draw.integers(97, 123, 200, dtype=np.uint8))
        cut = int(draw.integers(12, 23))
        other = own[:-cut] + bytes(draw.integers(97, 123, cut, dtype=np.uint8))
        a, b = slow_shingles(own.decode()), slow_shingles(other.decode())
        if len(a & b) >= 0.8 * len(a | b):
            pairs.append((len(lines), len(lines) + 1))
        lines += [own, other]
    keys, _ = linededup.band_keys(lines)
    assert len(pairs) > 100
    assert np.mean([(keys[a] == keys[b]).any() for a, b in pairs]) >= 0.95


# --- components, pipeline


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 560)] + [(900, 900), (7, 3), (3, 7)]
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 500 for i in range(500, 560)}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    from tests.llm.test_contract_ops import near_copies, slow_hits, slow_near_groups
    from tidemark.llm import langid, mixing, sharding

    every = near_copies() + [(9000 + r[0], *r[1:]) for r in corpus(seed=6, n=200) if r[0] is not None and 0 <= r[0] < 200]
    docs = frame(spark, every, extra=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench = [(1, every[3][1]), (2, every[-70][1])]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = pipeline.run(spark, str(tmp_path)).collect()
    # Language ID has tests of its own; all that has letters and is not rejected goes on, near copies included.
    model = langid.train(docs)
    rejected = model.predict([r[1] for r in every])[2]
    rows = [r for r, no in zip(every, rejected, strict=True) if not no]
    assert {r[0] for r in every} - {r[0] for r in rows} <= {1000, 1001, 1002, 1004, 1007}  # 1007: single letters
    assert len({*slow_near_groups(rows)}) < len(rows) - 40
    keepers = {}
    for row, g in zip(rows, slow_near_groups(rows), strict=True):
        if row[0] is not None and (g not in keepers or row[0] < keepers[g][0]):
            keepers[g] = row
    keepers = {r[0]: r for r in keepers.values()}
    left = [r for r in keepers.values() if not slow_hits(r[1], bench)[4]]
    assert 100 < len(left) < len(keepers)
    times = {r.doc_id: r.taken // r.size for r in mixing.mix_table(spark.createDataFrame(left, DDL)).collect()}
    assert Counter(r.doc_id for r in got) == Counter({k: v for k, v in times.items() if v})
    shards = {r.doc_id: r.shard for r in sharding.shard_table(spark.createDataFrame(left, DDL)).collect()}
    assert all(r.shard == shards[r.doc_id] for r in got)
    assert [name for name, _ in pipeline.STAGES] and pipeline.ORACLE_SQL is None
