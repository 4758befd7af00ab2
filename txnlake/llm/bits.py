"""Bit tables of bounded size that stand for a set of hashes (one-sided tests).

A table has at most ``MOST`` bits, whatever the set: beyond that it lets more
values through, and whoever uses it compares exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, MOST = 16, 27  # log2 of the bits: 8 KB to 16 MB
_BUCKET = 1 << 15  # bits in one of Spark's bitmaps


def passes(table: tuple[int, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set: false only for values that are not."""
    shift, bits = table
    at = hashes >> np.uint64(shift)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def bit_table(df: DataFrame, hashed: str, width: int, n: int) -> tuple[int, np.ndarray]:
    """The table (shift, bytes) of column ``hashed`` (``width`` bits in a long)
    of ``df``, which has ``n`` rows: plain data, ready to be broadcast."""
    log_bits = max(LEAST, min(MOST, (64 * max(n, 1)).bit_length()))
    place: Column = F.shiftrightunsigned(F.col(hashed), width - log_bits) + 1
    table = np.zeros((1 << log_bits) // 8, np.uint8)
    for r in df.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")).collect():
        at = (r.bucket - 1) * _BUCKET // 8
        table[at:at + _BUCKET // 8] = np.frombuffer(bytes(r.bitmap), np.uint8)
    return width - log_bits, table
