"""The operators against brute force, on a small table of odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.helpers import DDL, collected, corpus, frame
from tidemark.llm import bands, decontam, langid, mixing, quality, sharding, sieve, simhash, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- 1: sharding


def slow_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop():
    keys = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2)
    for n in (1, 2, 8, 9, 100):
        assert sharding.jump(keys, n).tolist() == [slow_jump(int(k), n) for k in keys]
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def test_shard_table(spark):
    rows = sharding.shard_table(frame(spark)).collect()
    source = corpus()
    assert len(rows) == len(source)
    key = lambda i: xxhash.xxh64_intdigest(str(i).encode(), 42) if i is not None else 42
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", slow_jump(key(i), 8), slow_jump(key(i), 9)) for i, t, *_ in source)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in rows) == want
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_table(spark.createDataFrame([], DDL)).collect() == []


def test_assign_shards_keeps_columns(spark):
    docs = frame(spark, extra=False)
    out = sharding.assign_shards(docs)
    assert out.columns == [*docs.columns, "shard"]
    assert collected(out.drop("shard")) == collected(docs)


# --- 2: quality


def slow_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def slow_line_fails(line, rules):
    words = WORD.findall(line)
    if not words:
        return False
    runs = any(len(set(words[i : i + rules.repeat_words])) == 1 and i + rules.repeat_words <= len(words) for i in range(len(words)))
    low = " " + line.lower() + " "
    said = [(m.start(), p) for own in quality.BOILERPLATE.values() for p in own for m in re.finditer("(?=" + re.escape(p) + ")", low)]
    phrase = len(words) <= rules.phrase_words and any(not low[i - 1].isalpha() and not low[i + len(p)].isalpha() for i, p in said)
    closed = re.search(r"""[.!?:;…。！？]["'”’»›)\]]*[ \t-\r]*\Z""", line) is not None
    is_open = len(words) <= rules.open_words and not closed and re.search("[A-Za-zÀ-ɏͰ-ϿЀ-ӿ]", line) is not None
    return len(re.findall(r"[#*$%&|<>]", line)) > rules.symbol_share * len(words) or len(re.findall("[|»›•·→]", line)) > rules.separators or line.count("!!") > rules.shouts or is_open or phrase or runs


def test_quality_table(spark):
    rules = quality.LineRules()
    rows = [*corpus(), (2000, "\n".join(["the stone house walks under light"] * 12), "en", "s0", 1), (2001, ("word&&& other%%% thing*** " * 30), "en", "s0", 1), (2002, "Click here\n" + " ".join(f"w{i}" for i in range(60)), "en", "s0", 1), (2003, " ".join(f"W{i}!!" for i in range(60)), "en", "s0", 1)]
    body = " ".join(f"w{i}" for i in range(60)) + "."
    odd = ["Menu", "One sentence.", 'He said "so."  ', "Mehr erfahren!", "Umweiterlesens.", "Weiterlesen …", "ไทยไม่มีจุด", "Où est-il ?", "Tous droits réservés.", "12 34 56", "Ήρθε.", "Привет мир", "«Leer más.»", "bread more.", "end.\x85", "a: b;"]
    rows += [(2100 + i, f"{body}\n{x}", "en", "s0", 1) for i, x in enumerate(odd)]
    got = {}
    for r in quality.quality_table(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text, *_ in rows:
        r = got[i][0]
        n, chars, symbols, dup, repeat, failed = slow_quality(text)
        left = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if not slow_line_fails(x, rules))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, chars, symbols, dup, repeat, failed), i
        assert r.n_clean_words == left
        assert r.kept == (not failed and n - left <= rules.lost_share * n)
    assert len(got[1005]) == 2 and not got[2001][0].kept and got[2002][0].kept and not got[2003][0].kept
    assert quality.quality_table(spark.createDataFrame([], DDL)).collect() == []


def test_clean_text_drops_lines(spark):
    table = spark.createDataFrame([("Click here\nThe river runs.\n\nx | y | z | a | b",), (None,)], "text string")
    out = [r[0] for r in table.select(quality.clean_text(table.text)).collect()]
    assert out == ["The river runs.\n", None]


# --- 4: token files


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [*corpus(), (3000, "end <|endoftext|> inside", "en", "s0", 1), (3001, "it's  two   blanks\n \nand\tTabs  ", "en", "s0", 1), (3002, "日本語 テキスト 한국어", "xx", "s0", 1), (3003, " lead  nbsp    x", "en", "s", 1)]
    got = tokens.token_table(frame(spark, rows)).orderBy("start").collect()
    assert len(got) == len(rows)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    want = Counter()
    for i, text, *_ in rows:
        own = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want[i, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert tokens.token_table(spark.createDataFrame([], DDL)).collect() == []


def test_encoder_equals_the_library_on_odd_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own, rng = Tokenizer.from_file(path), tokens.PieceEncoder(path), random.Random(11)
    letters = ["a", "b", "Zé", "ß", "don't", "'s", "1", "23", "!", "?!", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\u00a0", "\u2003", "\u2028", "\u3000", "中文", "\U0001f600", "\u0301", "ɐ", "Ж", "\x00", *own.special]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [None, "", " ", "a " * 30_000, "x" * 100_000, None]
    ids, sizes = own.encode(pa.array(texts, pa.string()), 2)
    ends = np.cumsum(sizes)
    for text, a, b in zip(texts, ends - sizes, ends, strict=True):
        assert ids[a:b].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2]
    assert [len(x) for x in own.encode(pa.array([], pa.string()), 2)] == [0, 0]


def test_token_search_by_id(spark, tmp_path):
    path = str(tmp_path / "tokens")
    tokens.write_tokens(frame(spark), path)
    found = tokens.read_tokens(spark, path).where("doc_id = 1003")
    assert [len(r.ids) for r in found.collect()] == [2]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1003)]" in found._jdf.queryExecution().toString()


def test_token_files_have_indexes_bloom_filters_and_run_lengths(spark, tmp_path):
    import pyarrow.orc as orc

    path = str(tmp_path / "tokens")
    rows = [(i, "the same few words here and there " * 3, "en", "s", 1) for i in range(3500)]
    tokens.write_tokens(spark.createDataFrame(rows, DDL), path)
    files = sorted(str(p) for p in (tmp_path / "tokens").glob("part-*.orc"))
    readers = [orc.ORCFile(f) for f in files]
    assert sum(r.nrows for r in readers) == 3500 and {r.row_index_stride for r in readers} == {tokens.GROUP_ROWS}
    hadoop, orc_file = spark._jvm.org.apache.hadoop, spark._jvm.org.apache.orc.OrcFile
    reader = orc_file.createReader(hadoop.fs.Path(files[0]), orc_file.readerOptions(hadoop.conf.Configuration()))
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    streams = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= streams
    # The struct itself and the two whole-number columns, the list and its elements: all in run lengths of version two.
    kinds = [footer.getColumns(i).getKind().toString() for i in range(footer.getColumnsCount())]
    assert kinds[1:] == ["DIRECT_V2"] * 4
    assert sum(r.nrows for r in readers) * 20 > sum(p.stat().st_size for p in (tmp_path / "tokens").glob("part-*.orc"))


# --- 5: language


def test_language_table(spark):
    rows = corpus(n=300)
    got = langid.language_table(frame(spark, rows)).collect()
    truth = {r[0]: r for r in rows}
    assert len(got) == len(rows)
    right = total = 0
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 3 == 1)
        assert 0 <= r.score <= 1
        text = truth[r.doc_id][1]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.held_out and r.doc_id < 300:
            total += 1
            right += r.lang_pred == truth[r.doc_id][2]
            assert not r.rejected
    assert right >= 0.95 * total > 0
    assert langid.language_table(spark.createDataFrame([], DDL)).collect() == []
    nothing = spark.createDataFrame([(1, "abc", None, None, 3)], DDL)
    assert [(r.lang_pred, r.rejected) for r in langid.language_table(nothing).collect()] == [("und", True)]


def test_kneser_ney_is_a_distribution():
    text = langid.symbols_of("abracadabra alakazam", langid.letter_table(list("abrcdlkzm")))
    model = langid.KneserNey.fit([text])
    for context in ([0, 0, 0], [1, 2, 3], text[1:4].tolist()):
        code = sum(s * langid.SYMBOLS ** (3 - i) for i, s in enumerate(context))
        total = np.exp2(model.log2(np.arange(langid.SYMBOLS) + code)).sum()
        assert total == pytest.approx(1.0)


def test_languages_of_many_scripts_keep_their_letters():
    """Latin, Cyrillic and Greek have more than 62 letters; two scripts beside them are told apart, a third is rejected."""
    rng = random.Random(5)
    latin, cyrillic, greek, hebrew = "abcdefghijklmnopqrstuvwxyz", *("".join(map(chr, range(a, a + n))) for a, n in ((0x430, 32), (0x3B1, 25), (0x5D0, 27)))
    scripts = {"en": latin, "ru": cyrillic, "el": greek, "ko": "".join(map(chr, range(0xAC00, 0xAC00 + 300))), "zh": "".join(map(chr, range(0x4E00, 0x4E00 + 300))), "old": "".join(map(chr, range(0x20000, 0x20000 + 300)))}
    lexicon = {k: ["".join(rng.choice(v) for _ in range(rng.randint(2, 4))) for _ in range(120)] for k, v in scripts.items()}
    # The first three are the more frequent, so that their letters would fill a small alphabet.
    sample = [(k, " ".join(rng.choice(own) for _ in range(80 if len(scripts[k]) < 40 else 40))) for k, own in lexicon.items() for _ in range(40)]
    model = langid.fit(sample)
    texts = [(k, " ".join(rng.choice(own) for _ in range(40))) for k, own in lexicon.items() for _ in range(10)]
    names, _, rejected = model.predict([t for _, t in texts])
    assert names == [k for k, _ in texts] and not rejected.any()
    _, _, rejected = model.predict([" ".join("".join(rng.choice(hebrew) for _ in range(rng.randint(2, 4))) for _ in range(40)) for _ in range(10)])
    assert rejected.all()


def test_rejection_passes_columns_through(spark):
    docs = frame(spark, corpus(n=200))
    kept = langid.drop_rejected(docs)
    assert kept.dtypes == docs.dtypes
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert {1000, 1001, 1002, 1004} <= gone and not any(i is not None and 0 <= i < 200 for i in gone)


class SlowKneserNey:
    """Interpolated Kneser-Ney over characters, with dictionaries and one probability at a time."""

    def __init__(self, texts, alphabet, order=4):
        self.order, self.size = order, len(alphabet) + 2
        self.names = {c: i for i, c in enumerate(alphabet, start=1)}
        self.counts = [Counter() for _ in range(order)]
        for text in texts:
            flow = self.flow(text)
            self.counts[-1].update(tuple(flow[i - order + 1 : i + 1]) for i in range(order - 1, len(flow)))
        for k in range(order - 1, 0, -1):
            self.counts[k - 1].update(g[1:] for g in set(self.counts[k]))
        self.discount = []
        for own in self.counts:
            once, twice = (sum(n == x for n in own.values()) for x in (1, 2))
            self.discount.append(once / (once + 2 * twice) if once and twice else 0.5)

    def flow(self, text):
        """Two zeros, and the text's symbols between zeros, runs of which are one."""
        out = [0]
        for c in text.lower():
            symbol = self.names.get(c, self.size - 1) if c.isalpha() else 0
            if symbol or out[-1]:
                out.append(symbol)
        return [0] * (self.order - 2) + (out if out[-1] == 0 else [*out, 0])

    def chance(self, gram):
        p = 1 / self.size
        for k in range(1, self.order + 1):
            own, context = gram[-k:], gram[-k:][:-1]
            after = [(g, n) for g, n in self.counts[k - 1].items() if g[:-1] == context]
            if after:
                total = sum(n for _, n in after)
                p = max(0.0, self.counts[k - 1].get(own, 0) - self.discount[k - 1]) / total + self.discount[k - 1] * len(after) / total * p
        return p

    def entropy(self, text):
        flow = self.flow(text)
        bits = [-math.log2(self.chance(tuple(flow[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(flow))]
        return len(bits), sum(bits) / len(bits) if bits else 0.0


def test_predictions_against_a_slow_model(spark):
    rows = [r for r in corpus(n=36) if r[0] != 1008]
    docs = frame(spark, rows)
    sample = langid.training_sample(docs, "doc_id", "text", "lang")
    model = langid.fit(sample)
    by_lang = defaultdict(list)
    for name, text in sample:
        by_lang[name].append(text)
    slow = {name: SlowKneserNey([t for i, t in enumerate(texts) if len(texts) < 10 or i % 5], model.alphabet) for name, texts in by_lang.items()}
    got = {}
    for r in langid.language_table(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    texts = [r[1] or "" for r in rows]
    sizes, bits = model.entropies(texts)
    for (i, text, *_), size, own in zip(rows, sizes, bits, strict=True):
        want = {name: slow[name].entropy(text or "") for name in model.languages}
        if not any(c.isalpha() for c in text or ""):
            assert size == 0 and got[i][0].lang_pred == "und" and got[i][0].rejected
            continue
        assert {n for n, _ in want.values()} == {size}
        assert own == pytest.approx([want[name][1] for name in model.languages], rel=1e-5, abs=1e-6)
        assert got[i][0].lang_pred == min(want, key=lambda n: want[n][1])


# --- 7: SimHash


def slow_fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """prints: (doc_id, fp) -> component of each fp."""
    values = sorted({f for _, f in prints})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return {v: least.get(find(v)) for v in values}


def test_simhash_groups(spark):
    rows = corpus()
    long = rows[-3][1].split(" ")
    for k in range(12):
        changed = list(long)
        changed[7 * k] = f"new{k}"
        rows.append((4000 + k, " ".join(changed), "en", "s0", 1))
    got = simhash.simhash_groups(frame(spark, rows)).collect()
    prints = [(r[0], slow_fingerprint(r[1])) for r in rows]
    component = slow_components(prints)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter((d, f"{f:016x}", component[f]) for d, f in prints)
    assert len({component[f] for d, f in prints if d is not None and (d >= 4000 or d == 1008)}) == 1
    assert simhash.simhash_groups(spark.createDataFrame([], DDL)).collect() == []


@pytest.mark.parametrize("bucket_rows", [8192, 3])
def test_links_equal_all_pairs(spark, bucket_rows):
    """Clusters of values around a few centres; small buckets force the path by neighbouring values."""
    draw = np.random.default_rng(5)
    values = set()
    for centre in draw.integers(0, 2**63, 6).tolist():
        for _ in range(12):
            values.add(centre ^ sum(1 << int(b) for b in draw.choice(64, int(draw.integers(0, 6)), replace=False)))
    values |= {int(v) for v in draw.integers(0, 2**63, 40)}
    prints = [(i, v) for i, v in enumerate(sorted(values))]
    signed = [(i, v - 2**64 if v >> 63 else v) for i, v in prints]
    got = simhash.group_fingerprints(spark.createDataFrame(signed, "doc_id long, fp long"), bucket_rows=bucket_rows).collect()
    assert {r.fp % 2**64: r.component_id for r in got} == slow_components(prints)


def slow_set(text):
    words = lower(text).encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_near_groups(rows):
    """{row number: group} by fingerprints of five words at 3 bits, and by similarity of 0.8 or more."""
    prints, sets = [simhash.fingerprint((r[1] or "").encode(), 5) for r in rows], [slow_set(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (prints[i] ^ prints[j]).bit_count() <= 3 or (both and both >= 0.8 * len(sets[i] | sets[j])):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def near_copies():
    """Groups of texts a few words apart, chains whose ends are far apart, and texts just below the threshold."""
    draw = np.random.default_rng(9)
    rows = corpus()
    for g in range(5):
        base = [f"w{x}" for x in draw.integers(0, 5000, 200)]
        chain = list(base)
        for k in range(8):
            rows.append((5000 + 100 * g + k, " ".join("new" + str(draw.integers(1e6)) if i in draw.choice(200, 1 + k) else w for i, w in enumerate(base)), "en", "s0", 1))
            chain = [*chain[3:], *(f"v{x}" for x in draw.integers(0, 5000, 3))]
            rows.append((5050 + 100 * g + k, " ".join(chain), "en", "s0", 1))
    return rows


@pytest.mark.parametrize(("block", "shingles", "bits"), [(256, 1 << 20, 1 << 27), (2, 400, 1 << 15)])
def test_one_of_each_group_stays(spark, monkeypatch, block, shingles, bits):
    """Small blocks deal the bands to pairs of blocks; a bitmap of few bits lets other rows pass, which the joins sort out."""
    monkeypatch.setattr(bands, "BLOCK", block)
    monkeypatch.setattr(bands, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(sieve, "BITS", bits)
    rows = near_copies()
    docs = frame(spark, rows)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    least = {}
    for row, g in zip(rows, slow_near_groups(rows), strict=True):
        if row[0] is not None:
            least[g] = min(row[0], least.get(g, row[0]))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())
    assert simhash.keep_one_per_group(spark.createDataFrame([], DDL)).collect() == []


def test_links_across_equal_all_pairs():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 40, (4, 60))
    sets = [np.unique(np.where(draw.random(60) < 0.1 * draw.random(), draw.integers(0, 1 << 40, 60), base[i % 4])) for i in range(40)]
    roots = [i // 2 * 2 for i in range(40)]
    group = list(roots)
    for i in range(40):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                group = [group[j] if g == group[i] else g for g in group]
    found = list(roots)
    edges = list(bands.links_across(roots, sets))
    for a, b in edges:
        x, y = found[roots.index(a)], found[roots.index(b)]
        found = [y if g == x else g for g in found]
    assert len({*zip(group, found, strict=True)}) == len(set(group)) == len(set(found))
    assert len(edges) == len(set(roots)) - len(set(group))


@pytest.mark.parametrize("bits", [1 << 27, 1 << 15, 8])
def test_the_sieve_loses_no_match(spark, monkeypatch, bits):
    monkeypatch.setattr(sieve, "BITS", bits)
    from pyspark.sql import functions as F

    rows = spark.range(3000).select(F.xxhash64("id").alias("h"), "id").unionAll(spark.createDataFrame([(None, -1), (-(2**63), -2), (2**63 - 1, -3), (0, -4)], "h long, id long"))
    wanted = rows.where("id % 7 = 0 or id < 0").select(F.col("h").alias("w"))
    got = {r.id: r["__may"] for r in sieve.sifted(rows, F.col("h"), wanted, "w").collect()}
    assert len(got) == 3004 and all(got[i] for i in got if i % 7 == 0 and i >= 0) and got[-2] and got[-3] and got[-4] and not got[-1]
    assert bits < 1 << 27 or sum(got.values()) < 440
    own = rows.where("h is not null").collect()
    in_python = sieve.in_bitmap(sieve.bitmap(wanted, "w"), np.array([r.h for r in own], dtype=np.int64), bits)
    assert {r.id: bool(x) for r, x in zip(own, in_python, strict=True)} == {i: may for i, may in got.items() if i != -1}
    assert sieve.matching(rows, F.col("h"), wanted.limit(0), "w").count() == 0


# --- 8: decontamination

BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_hits(text, items):
    words = BENCH_WORD.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        own = BENCH_WORD.findall(lower(body))
        span = min(10, len(own))
        if not span:
            continue
        windows = {tuple(own[i : i + span]) for i in range(len(own) - span + 1)}
        for i in range(len(words) - span + 1):
            if tuple(words[i : i + span]) in windows:
                hit |= set(range(i, i + span))
                found.add(str(item))
    ids = sorted(found)
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def bench_rows():
    base = corpus()
    return [(1, base[3][1]), (2, "river stone"), (3, None), (4, ""), (10, base[7][1]), (11, base[7][1][:80]), (12, "unseen words only here now and then or never again"), (13, "The RIVER, stone!")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination(spark, block_bytes):
    rows = [*corpus(), (5000, "x " + corpus()[3][1].upper() + " y", "en", "s", 1), (5001, corpus()[7][1].replace(" ", "-- "), "en", "s", 1)]
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    got = decontam.contamination_table(frame(spark, rows), bench, block_bytes=block_bytes).collect()
    want = Counter((r[0], *slow_hits(r[1], bench_rows())) for r in rows)
    assert Counter(tuple(r) for r in got) == want
    kept = decontam.drop_contaminated(frame(spark, rows), bench, block_bytes=block_bytes)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows if not slow_hits(r[1], bench_rows())[4])


def test_contamination_of_empty_tables(spark):
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination_table(spark.createDataFrame([], DDL), bench).collect() == []
    assert all(not r.contaminated for r in decontam.contamination_table(frame(spark), none).collect())


# --- 9: mixing


def slow_targets(sizes, weights=(5, 2, 1), budget=Fraction(3, 2), epochs=2):
    """sizes: source -> words. Share, stop at the top, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = budget * sum(sizes.values()) - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > epochs * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: Fraction(epochs * sizes[s]) for s in above}


def test_mix_table(spark):
    rows = corpus()
    got = mixing.mix_table(frame(spark)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    targets = slow_targets(sizes)
    source = {(r[0], len(WORD.findall(r[1] or ""))): r[3] for r in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(targets[s]))
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert len(got) == len(rows)
    assert all(abs(taken[s] - targets[s]) <= 2 * max(largest.values()) for s in targets)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert collected(mixing.mix_table(frame(spark).repartition(7))) == sorted((tuple(r) for r in got), key=repr)
    assert mixing.mix_table(spark.createDataFrame([], DDL)).collect() == []


def test_mix_repeats_rows_as_often_as_the_table_says(spark):
    docs = frame(spark)
    times = {}
    for r in mixing.mix_table(docs).collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + (r.taken // r.size if r.size else 1)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in times.items() if v})


def test_mix_takes_some_of_many_equal_rows(spark):
    """The mix ends among rows that are equal in id and text: as many go in as the table says, whatever their columns."""
    rows = [(None, "one text of five words", "en", "a", i) for i in range(300)] + [(i, f"w{i} x y", "en", "b", 1) for i in range(40)] + [(7, None, None, "a", 0)] * 3
    docs = frame(spark, rows).repartition(5)
    taken = sum(r.taken for r in mixing.mix_table(docs).collect())
    out = mixing.mix(docs).collect()
    assert sum(len((r.text or "").split()) for r in out) == taken > 0
    equal = Counter(r.n_chars for r in out if r.doc_id is None)
    assert 0 < len(equal) and max(equal.values()) - min([*equal.values(), 2]) <= 1
    assert sum(r.text is None for r in out) == 3
    assert mixing.mix(spark.createDataFrame([], DDL)).collect() == []


def test_weights_stop_at_twice_the_source(spark):
    rows = [(i, "w " * n, "en", s, 1) for i, (n, s) in enumerate([(10, "a")] * 2 + [(10, "b")] * 60 + [(10, "c")] * 40)]
    got = mixing.mix_table(spark.createDataFrame(rows, DDL))
    want = slow_targets({"a": 20, "b": 600, "c": 400})
    assert {r.source_size: r.target for r in got.collect()} == {20: 40.0, 600: pytest.approx(float(want["b"])), 400: pytest.approx(float(want["c"]))}
