"""DuckDB SQL for the operators whose whole result SQL can say: shards, line quality, SimHash groups, decontamination and
the mix.

Written from the contracts and the documented rules, not from the plans: windows are compared as text, queues are
summed whole, and the budget's end is found by one ordered sum.
"""

from __future__ import annotations

from .decontam import WINDOW_WORDS
from .hash_sql import crc32, xxh64, xxh64_of_longs
from .mixing import MixPlan
from .quality import CLOSED, LETTERS, PHRASES, SYMBOLS, LineRules
from .sharding import JUMP_MULTIPLIER, JUMP_SCALE, SLOT_BUCKETS
from .simhash import MAX_BITS, SEED

WORDS = r"[^\x20\x09-\x0D]+"
BENCHMARK_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def line_quality(rules: LineRules | None = None) -> str:
    r = rules or LineRules()
    symbols = f"[{SYMBOLS}]"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM (SELECT r, regexp_extract_all(t, '{WORDS}') AS ws FROM d)),
words AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
windows AS (SELECT r, i, word || ' ' || lead(word) OVER p || ' ' || lead(word, 2) OVER p AS g FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM windows WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
lines AS (SELECT r, line, regexp_extract_all(line, '{WORDS}') AS lw FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORDS}')),
judged AS (
    SELECT r, line, len(lw) AS n,
        length(line) - length(regexp_replace(line, '{symbols}', '', 'g')) > {r.symbol_share} * len(lw)
        OR length(line) - length(regexp_replace(line, '[|»›•·→]', '', 'g')) > {r.separators}
        OR length(line) - length(replace(line, '!!', '!')) > {r.shouts}
        OR (len(lw) <= {r.open_words} AND NOT regexp_matches(line, '{quoted(CLOSED)}') AND regexp_matches(line, '{LETTERS}'))
        OR (len(lw) <= {r.phrase_words} AND regexp_matches(lower(line), '{quoted(PHRASES)}'))
        OR len(list_filter(range(1, len(lw) - {r.repeat_words - 2}), lambda k: len(list_distinct(lw[k : k + {r.repeat_words - 1}])) = 1)) > 0 AS fails
    FROM lines),
by_line AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (NOT fails), 0) AS n_clean FROM judged GROUP BY r),
base AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
        length(t) - length(regexp_replace(t, '{symbols}', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(repeats.n, 0) AS n_repeat_words, CAST(coalesce(n_clean, 0) AS BIGINT) AS n_clean_words
    FROM d LEFT JOIN words USING (r) LEFT JOIN repeats USING (r) LEFT JOIN by_line USING (r)),
failed AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.repeat_share} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words - n_clean_words <= {r.lost_share} * n_words AS kept, n_clean_words
FROM failed"""


def decontamination(window: int = WINDOW_WORDS) -> str:
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '{BENCHMARK_WORDS}') AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all({LOWERED}, '{BENCHMARK_WORDS}') AS w FROM benchmark),
wide AS (SELECT item, w, least({window}, len(w)) AS k FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[s : s + k - 1], ' ') AS g FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM wide)),
widths AS (SELECT DISTINCT k FROM win),
seen AS (SELECT r, s, k, array_to_string(w[s : s + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, widths WHERE len(w) >= k)),
hits AS MATERIALIZED (SELECT DISTINCT seen.r, seen.s, seen.k, win.item FROM seen JOIN win ON seen.k = win.k AND seen.g = win.g),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""


def fair_mix(plan: MixPlan | None = None) -> str:
    p = plan or MixPlan()
    turns = ", ".join(f"CAST(cum + {e} * source_size AS DOUBLE) / target" for e in range(p.epochs))
    return f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS size,
        md5(md5('{p.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) || md5(coalesce(text, ''))) AS h
    FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM d GROUP BY source),
weighed AS (SELECT *, {list(p.weights)}[rank % {len(p.weights)} + 1] AS weight, {p.epochs} * source_size AS top, CAST({p.budget} * sum(source_size) OVER () AS DOUBLE) AS budget FROM s),
levels AS (
    SELECT *, (budget - CAST(coalesce(sum(top) OVER (ORDER BY top / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
        / CAST(sum(weight) OVER (ORDER BY top / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM weighed),
common AS (SELECT level AS common FROM levels WHERE level * weight <= top ORDER BY top / weight, rank LIMIT 1),
targets AS (SELECT source, rank, source_size, budget, coalesce(least(CAST(top AS DOUBLE), (SELECT common FROM common) * weight), CAST(top AS DOUBLE)) AS target FROM levels),
queue AS MATERIALIZED (
    SELECT d.r, d.doc_id, d.size, t.rank, t.source_size, t.budget, t.target, CAST(sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.h, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
    FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
turns AS (SELECT r, size, rank, budget, unnest([{turns}]) AS v FROM queue WHERE size > 0),
taken AS (SELECT r, sum(size) AS taken FROM (SELECT r, size FROM turns QUALIFY sum(size) OVER (ORDER BY v, rank ROWS UNBOUNDED PRECEDING) <= budget) GROUP BY r)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM queue LEFT JOIN taken USING (r)"""


def shards(n: int = 8) -> str:
    """Jump hashing by a recursive query: a key walks on until it has passed the last shard."""
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
{xxh64("(SELECT doc_id::VARCHAR AS s FROM documents WHERE doc_id IS NOT NULL)", "s", 42)},
keys AS (SELECT text AS s, h FROM xxh_done UNION ALL SELECT NULL, 42::UBIGINT),
walk AS (
    SELECT s, n, h AS state, -1::BIGINT AS b, 0::BIGINT AS j FROM keys, (VALUES ({n}), ({n + 1})) t(n)
    UNION ALL
    SELECT s, n, state, j, floor((j + 1)::DOUBLE * ({JUMP_SCALE}::DOUBLE / (state // {1 << 33}::UBIGINT + 1)::DOUBLE))::BIGINT
    FROM (SELECT s, n, j, ((state::UHUGEINT * {JUMP_MULTIPLIER}::UHUGEINT + 1) % {1 << 64}::UHUGEINT)::UBIGINT AS state FROM walk WHERE j < n)),
found AS (SELECT s, max(b) FILTER (n = {n}) AS shard, max(b) FILTER (n = {n + 1}) AS grown FROM walk WHERE j >= n GROUP BY s),
placed AS (SELECT d.*, shard, grown, {xxh64_of_longs(["doc_id", "size", "text_crc32"])} % {SLOT_BUCKETS}::UBIGINT AS bucket FROM d JOIN found ON d.doc_id::VARCHAR IS NOT DISTINCT FROM found.s)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown::INTEGER AS grown_shard
FROM placed"""


def simhash_groups() -> str:
    """Fingerprints by counting each bit, links by comparing all pairs, components by a recursive query."""
    sums = ", ".join(f"sum((h // {1 << b}::UBIGINT) % 2) AS b{b}" for b in range(64))
    value = " + ".join(f"CASE WHEN 2 * b{b} > n THEN {1 << b}::UHUGEINT ELSE 0::UHUGEINT END" for b in range(64))
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
g AS MATERIALIZED (SELECT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS text FROM d),
{xxh64("g", "text", SEED)},
counted AS (SELECT r, count(*) AS n, {sums} FROM g JOIN xxh_done USING (text) GROUP BY r),
prints AS MATERIALIZED (SELECT d.doc_id, coalesce(({value})::UBIGINT, 0::UBIGINT) AS fp FROM d LEFT JOIN counted USING (r)),
nodes AS MATERIALIZED (SELECT fp, min(doc_id) AS first_id FROM prints GROUP BY fp),
links AS MATERIALIZED (SELECT a.fp AS a, b.fp AS b FROM nodes a JOIN nodes b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {MAX_BITS}),
reach AS (SELECT fp, fp AS other FROM nodes UNION SELECT reach.fp, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT reach.fp, min(first_id) AS component_id FROM reach JOIN nodes ON reach.other = nodes.fp GROUP BY reach.fp)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, component_id FROM prints JOIN least USING (fp)"""


def oracles() -> dict[str, str]:
    return {"op1_jump_shards": shards(), "op2_line_quality": line_quality(), "op7_simhash_groups": simhash_groups(), "op8_decontaminate": decontamination(), "op9_fair_mix": fair_mix()}
