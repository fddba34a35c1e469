"""CRC-32 and XXH64 in DuckDB SQL, for the SQL of operators whose results have them.

Written from the published algorithms, with whole numbers of 128 bits for products of 64-bit ones. Each function gives
the text of an expression or of common table expressions.
"""

from __future__ import annotations

#: Fixed values of XXH64, and the reflected polynomial of CRC-32.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
CRC_POLYNOMIAL = 0xEDB88320
_M = f"{1 << 64}::UHUGEINT"


def _mul(a: str, b: str | int) -> str:
    return f"((({a})::UHUGEINT * ({b})::UHUGEINT) % {_M})::UBIGINT"


def _add(a: str, *more: str | int) -> str:
    return f"((({a})::UHUGEINT" + "".join(f" + ({b})::UHUGEINT" for b in more) + f") % {_M})::UBIGINT"


def _let(value: str, name: str, body: str) -> str:
    """``body``, in which ``name`` stands for a value that is written, and computed, once."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _rotl(a: str, bits: int) -> str:
    return _let(a, "z", f"(((z::UHUGEINT * {1 << bits}::UHUGEINT) % {_M}) + z // {1 << (64 - bits)}::UHUGEINT)::UBIGINT")


def _lane(acc: str, lane: str) -> str:
    """XXH64's round."""
    return _mul(_rotl(_add(acc, _mul(lane, P2)), 31), P1)


def _eight(h: str, lane: str) -> str:
    return _add(_mul(_rotl(f"xor({h}, {_lane('0::UBIGINT', lane)})", 27), P1), P4)


def _avalanche(h: str) -> str:
    one = _mul(_let(h, "x", f"xor(x, x // {1 << 33}::UBIGINT)"), P2)
    two = _mul(_let(one, "x", f"xor(x, x // {1 << 29}::UBIGINT)"), P3)
    return _let(two, "x", f"xor(x, x // {1 << 32}::UBIGINT)")


def bytes_of(text: str) -> str:
    """The UTF-8 bytes of a text as a list of two hexadecimal digits each."""
    return f"regexp_extract_all(hex(encode({text})), '..')"


def _number(digits: str) -> str:
    """Little-endian bytes, two digits each, as a number."""
    return f"('0x' || array_to_string(list_reverse({digits}), ''))::UBIGINT"


def xxh64(source: str, text: str, seed: int = 42) -> str:
    """Common table expressions that end in xxh_done(text, h), of the distinct values of ``text`` in table ``source``."""
    fold = lambda first, items, step: f"list_reduce(list_prepend({first}, {items}), lambda a, b: {step})"
    starts = [(seed + P1 + P2) % (1 << 64), (seed + P2) % (1 << 64), seed, (seed - P1) % (1 << 64)]
    accumulators = ", ".join(f"{fold(f'{s}::UBIGINT', f'[lanes[4 * i + {k + 1}] FOR i IN range(stripes)]', _lane('a', 'b'))} AS v{k}" for k, s in enumerate(starts))
    merged = _add(_rotl("v0", 1), _rotl("v1", 7), _rotl("v2", 12), _rotl("v3", 18))
    mixed = fold(merged, "[v0, v1, v2, v3]", _add(_mul(f"xor(a, {_lane('0::UBIGINT', 'b')})", P1), P4))
    four = _let("fours[1]", "w", _add(_mul(_rotl(f"xor(h, {_mul('w', P1)})", 23), P2), P3))
    one = _mul(_rotl(f"xor(a, {_mul('b', P5)})", 11), P1)
    return f"""xxh_bytes AS (SELECT text, {bytes_of('text')} AS o FROM (SELECT DISTINCT {text} AS text FROM {source})),
xxh_lanes AS (SELECT text, len(o) AS n, len(o) // 32 AS stripes, [{_number('o[8 * i + 1 : 8 * i + 8]')} FOR i IN range(len(o) // 8)] AS lanes,
    CASE WHEN len(o) % 8 >= 4 THEN [{_number('o[len(o) // 8 * 8 + 1 : len(o) // 8 * 8 + 4]')}] ELSE [] END AS fours, [('0x' || x)::UBIGINT FOR x IN o[len(o) // 4 * 4 + 1 :]] AS ones FROM xxh_bytes),
xxh_wide AS (SELECT *, {accumulators} FROM xxh_lanes),
xxh_sum AS (SELECT text, lanes, stripes, fours, ones, {_add(f"CASE WHEN stripes > 0 THEN {mixed} ELSE {(seed + P5) % (1 << 64)}::UBIGINT END", 'n')} AS h FROM xxh_wide),
xxh_eights AS (SELECT text, fours, ones, {fold('h', 'lanes[4 * stripes + 1 :]', _eight('a', 'b'))} AS h FROM xxh_sum),
xxh_fours AS (SELECT text, ones, CASE WHEN len(fours) > 0 THEN {four} ELSE h END AS h FROM xxh_eights),
xxh_ones AS (SELECT text, {fold('h', 'ones', one)} AS h FROM xxh_fours),
xxh_done AS (SELECT text, {_avalanche('h')} AS h FROM xxh_ones)"""


def xxh64_of_longs(values: list[str], seed: int = 42) -> str:
    """Spark's hash of several longs, each with the hash of those before it as seed; a null leaves the hash as it is."""
    h = f"{seed}::UBIGINT"
    for value in values:
        unsigned = f"(CASE WHEN {value} < 0 THEN {value}::HUGEINT + {1 << 64}::HUGEINT ELSE {value}::HUGEINT END)::UBIGINT"
        mixed = _add(_mul(_rotl(f"xor({_add('s', P5, 8)}, {_lane('0::UBIGINT', unsigned)})", 27), P1), P4)
        h = _let(h, "s", f"CASE WHEN {value} IS NULL THEN s ELSE {_avalanche(mixed)} END")
    return h


def _crc_entry(n: int) -> int:
    for _ in range(8):
        n = n >> 1 ^ (CRC_POLYNOMIAL if n & 1 else 0)
    return n


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes as a number. The table is made from the polynomial."""
    table = "([" + ", ".join(str(_crc_entry(n)) for n in range(256)) + "]::UBIGINT[])"
    step = f"xor(a // 256::UBIGINT, {table}[(xor(a, b) & 255::UBIGINT)::INTEGER + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, [('0x' || x)::UBIGINT FOR x IN {bytes_of(text)}]), lambda a, b: {step}), 4294967295::UBIGINT)::BIGINT"
