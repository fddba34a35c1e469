"""A bounded bitmap of hashed keys: rows that surely lack a partner pass without a shuffle.

The bitmap has a fixed number of bits, so what is broadcast does not grow with the data. A row whose bit is not set has
no partner; the others are joined, which decides exactly. With more keys more rows are joined, in the end all of them:
one plan for all sizes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap: 16 MB, in pieces of 4 KB.
BITS = 1 << 27
PIECE = 1 << 15


def _bit(key: Column) -> Column:
    return F.pmod(key, F.lit(BITS).cast("long"))


def _pieces(wanted: DataFrame, column: str) -> DataFrame:
    """(__piece, __bytes): the bitmap of a column of hashes, in pieces of 4 KB."""
    piece = F.bitmap_bucket_number(_bit(F.col(column)))
    # Keys are dealt by piece first: a task that has some keys of every piece would else write a whole bitmap.
    dealt = wanted.where(F.col(column).isNotNull()).select(piece.alias("__piece"), F.bitmap_bit_position(_bit(F.col(column))).alias("__at")).repartition("__piece")
    return dealt.groupBy("__piece").agg(F.bitmap_construct_agg("__at").alias("__bytes"))


def bitmap(wanted: DataFrame, column: str) -> np.ndarray:
    """The bitmap as bytes on the driver, for ``in_bitmap`` in workers; its size is fixed."""
    found = np.zeros((BITS // PIECE + 2, PIECE // 8), dtype=np.uint8)
    for row in _pieces(wanted, column).toLocalIterator():
        found[row["__piece"]] = np.frombuffer(row["__bytes"], dtype=np.uint8)
    return found.ravel()


def in_bitmap(found: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which of the signed 64-bit hashes have their bit set, of ``bits``."""
    bit = hashes.astype(np.int64) % bits
    # Spark's pieces: zero stands alone, then each has PIECE bits.
    at = np.where(bit > 0, bit + PIECE - 1, 0)
    return (found[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def sifted(rows: DataFrame, key: Column, wanted: DataFrame, column: str) -> DataFrame:
    """``rows`` with a column __may, false only where no value of ``wanted``'s column equals ``key``; both are hashes.

    A null key may not match; an empty ``wanted`` matches nothing.
    """
    built = _pieces(wanted, column)
    # As whole numbers, a bit of which is read at once; the first byte is the highest.
    number = lambda i: F.conv(F.hex(F.substring("__bytes", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    pieces = built.select("__piece", F.transform(F.sequence(F.lit(0), F.lit(511)), number).alias("__map"))
    place = F.bitmap_bit_position("__bit").cast("int")
    at = F.lit(56) - F.shiftright(place % 64, 3) * 8 + place % 8
    met = rows.withColumn("__bit", _bit(key)).join(F.broadcast(pieces), F.bitmap_bucket_number("__bit") == F.col("__piece"), "left")
    return met.withColumn("__may", F.coalesce(F.getbit(F.get("__map", F.shiftright(place, 6)), at) == 1, F.lit(False))).drop("__bit", "__piece", "__map")


def matching(rows: DataFrame, key: Column, wanted: DataFrame, column: str) -> DataFrame:
    """The rows that may match."""
    return sifted(rows, key, wanted, column).where("__may").drop("__may")
