"""A blocked Bloom filter as a DataFrame: one row per 512-bit block, eight 64-bit words with one bit each per key.

Built with ``bit_or`` and probed by a broadcast join on the block number. The number of blocks has a fixed upper bound,
so the broadcast has one too; beyond it only the share of false hits grows, and callers follow with an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
#: Keys that a block is meant for: 16 bits each.
KEYS_PER_BLOCK = 32
#: At most 262,144 blocks of 72 bytes: a broadcast of 19 MB.
MAX_BLOCKS = 1 << 18

_NAMES = [f"_bloom_{j}" for j in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    second = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
            F.shiftrightunsigned(second, 6 * j).bitwiseAND(F.lit(63)).cast("int")) for j in range(WORDS)]


def build(keys: DataFrame, key: str, count: int) -> tuple[DataFrame, int]:
    """The blocks over a column's values and their number; ``count`` is how many keys there are."""
    blocks = max(1, min(MAX_BLOCKS, -(-count // KEYS_PER_BLOCK)))
    held = keys.filter(F.col(key).isNotNull()).select(
        _block(F.col(key), blocks).alias("_block"), *[m.alias(n) for m, n in zip(_masks(F.col(key)), _NAMES, strict=True)])
    return held.groupBy("_block").agg(*[F.bit_or(n).alias(n) for n in _NAMES]), blocks


def probe(rows: DataFrame, key: Column, filter_: tuple[DataFrame, int], out: str) -> DataFrame:
    """The rows with a flag that is false only where the key is in no block; a null key is never held."""
    held, blocks = filter_
    columns = rows.columns
    joined = rows.withColumn("_block", _block(key, blocks)).join(F.broadcast(held), "_block", "left")
    hit = F.lit(True)
    for mask, name in zip(_masks(key), _NAMES, strict=True):
        hit = hit & (F.col(name).bitwiseAND(mask) != 0)
    return joined.select(*columns, F.coalesce(hit & key.isNotNull(), F.lit(False)).alias(out))
