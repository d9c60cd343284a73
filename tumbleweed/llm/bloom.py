"""A blocked Bloom filter over 64-bit keys, built by Spark and probed in numpy.

One 64-byte block per key, one bit in each of its eight words.  It takes
``bits_per_key`` bits a key up to ``max_bytes``; past that more keys pass that
were never put in, and no key that was is ever refused.  ``max_bytes`` bounds what
the driver receives and what is broadcast, whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS_PER_KEY = 16
MAX_BYTES = 16 << 20


def bits_of(key: Column) -> Column:
    """A second hash: it says which bit of each word a key sets."""
    return F.xxhash64(key, F.lit("bits"))


def build(keys: DataFrame, key: str = "k", bits_per_key: int = BITS_PER_KEY, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """The filter of a column of 64-bit hashes: an array of blocks of eight words.

    Bits are set by a distributed ``bit_or`` per block.
    """
    n = keys.count()
    blocks = int(min(max(1, -(-n * bits_per_key // (64 * WORDS))), max_bytes // (8 * WORDS)))
    bit = lambda i: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(b, {6 * i}) & 63 as int))")
    parts = (keys.select(F.col(key).alias("k")).withColumn("b", bits_of(F.col("k")))
             .groupBy(F.expr(f"pmod(k, {blocks}L)").alias("block"))
             .agg(*[F.bit_or(bit(i)).alias(f"w{i}") for i in range(WORDS)]))
    out = np.zeros((blocks, WORDS), dtype=np.uint64)
    for r in parts.toLocalIterator():
        out[r["block"]] = np.array([r[f"w{i}"] for i in range(WORDS)], dtype=np.int64).view(np.uint64)
    return out


def may_hold(blocks: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each key may have been put in; ``bits`` are the keys' second hashes."""
    block = blocks[np.mod(keys.astype(np.int64), len(blocks))]
    shift = (bits.astype(np.int64).view(np.uint64)[:, None] >> (np.uint64(6) * np.arange(WORDS, dtype=np.uint64))) & np.uint64(63)
    return (((block >> shift) & np.uint64(1)) == 1).all(axis=1)
