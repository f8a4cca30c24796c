"""A Bloom filter of 64-bit keys with a fixed number of bits: small enough for any task, whatever it is built from.

It never misses a key that it was built from, and what it lets through wrongly must fall to an exact step behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25  # 4 MB
HASHES = 3


def place(keys: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th place of keys in the filter: their low bits moved on by steps of their high ones."""
    step = (keys >> np.uint64(40)) | np.uint64(1)
    return ((keys + np.uint64(k) * step) & np.uint64(BITS - 1)).astype(np.int32)


def places(keys: np.ndarray) -> Iterator[np.ndarray]:
    return (place(keys, k) for k in range(HASHES))


def passing(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where the keys are that may be among those that ``bits`` was built from: most others go at the first place."""
    left = np.arange(len(keys))
    for k in range(HASHES):
        bit = place(keys[left], k)
        left = left[(bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
    return left


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be among those that ``bits`` was built from."""
    found = np.zeros(len(keys), dtype=bool)
    found[passing(bits, keys)] = True
    return found


def build(keys: DataFrame) -> np.ndarray:
    """The filter of the column ``key``: ``places`` in SQL, gathered in blocks of bits, whose number is fixed."""
    mask = BITS - 1
    place = f"((key & {mask}) + k * ((shiftrightunsigned(key, 40) | 1) & {mask})) & {mask}"
    bits = keys.selectExpr("key", f"explode(sequence(0, {HASHES - 1})) AS k").selectExpr(f"({place}) + 1 AS bit")
    blocks = bits.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    made = np.zeros(BITS // 8, dtype=np.uint8)
    for block, part in blocks.collect():  # at most BITS in all
        made[(block - 1) * len(part) :][: len(part)] = np.frombuffer(part, dtype=np.uint8)
    return made
