"""A map of bits of fixed size that says which values of a large set may be there; for filters before a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def position(value: Column) -> Column:
    """The bit of a value."""
    return F.pmod(F.xxhash64(value), F.lit(BITS))


def low_bits(hashed: Column) -> Column:
    """The bit of a value that is a good hash itself."""
    return hashed.bitwiseAND(F.lit(BITS - 1).cast("long"))


def bit_map(frame: DataFrame, at: Column) -> np.ndarray:
    """The bits at the places `at` of all rows, as BITS / 8 bytes, however many rows there are."""
    at = at + 1
    bits = frame.select(F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit"))
    flags = np.zeros(BITS // 8, np.uint8)
    # Parts are numbered from 1 and have 4,096 bytes each: at most BITS bits in all.
    for row in bits.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        flags[(row.part - 1) * 4096 : row.part * 4096] = np.frombuffer(row.bits, np.uint8)
    return flags


def is_set(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
