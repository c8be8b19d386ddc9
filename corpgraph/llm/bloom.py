"""Blocked Bloom filters as DataFrames: one row of four 64-bit words for each block, built and probed by column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, BLOCK_BITS = 16, 256
WORDS = ("w0", "w1", "w2", "w3")


def block_count(keys: int) -> int:
    """A power of two: a key's block in a smaller filter is its block in a larger one, modulo the smaller's size."""
    return 1 << max(0, -(-keys * BITS_PER_KEY // BLOCK_BITS) - 1).bit_length()


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(11)), F.lit(blocks))


def masks(key: Column) -> list[Column]:
    """Two bits in each of the block's four words, chosen by 48 bits of a second hash."""
    h = F.xxhash64(key, F.lit(29))
    part = lambda shift: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int")
    bit = lambda shift: F.call_function("shiftleft", F.lit(1).cast("long"), part(shift))
    return [bit(6 * j).bitwiseOR(bit(6 * j + 24)) for j in range(4)]


def build(keys: DataFrame, key: str, blocks: int, *by: str) -> DataFrame:
    """``by``, block, w0..w3. Words are OR-ed on the map side, so at most ``blocks`` rows a task are shuffled."""
    bits = keys.select(*by, block_of(F.col(key), blocks).alias("block"), *[m.alias(w) for m, w in zip(masks(F.col(key)), WORDS, strict=True)])
    return bits.groupBy(*by, "block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def passes(key: Column) -> Column:
    """Whether all bits of ``key`` are set in the words of the row (of the joined block)."""
    out = F.lit(True)
    for m, w in zip(masks(key), WORDS, strict=True):
        out = out & (F.col(w).bitwiseAND(m) == m)
    return out
