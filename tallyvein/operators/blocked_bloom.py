"""Bloom filters in blocks of 256 bits: all bits of a value lie in one block, so a probe is one lookup.

A block has eight lanes of 32 bits, and a value sets one bit in each. One word of the value's key names the
block, another one of 40 bits gives five bits for every lane.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvein.functions.hashing import string_key
from tallyvein.operators.membership import BROADCAST_BYTES
from tallyvein.session import Scratch

LANES, LANE_BITS = 8, 5
BLOCK_BITS = LANES << LANE_BITS
ROW_BYTES = 8 * (LANES + 3)  # a block's number and lanes, with the overhead of a row
LANE_NAMES = tuple(f"lane{i}" for i in range(LANES))


@dataclass(frozen=True)
class BlockedFilter:
    """Blocks with a bit set, as rows (block, lane0, .., lane7)."""

    blocks: DataFrame
    n_blocks: int

    @property
    def broadcastable(self) -> bool:
        """The number of blocks is fixed when the filter is sized, whatever goes in."""
        return self.n_blocks * ROW_BYTES <= BROADCAST_BYTES


def blocks_for(n_expected: int, bits_per_value: int = 10) -> int:
    return max(1, math.ceil(n_expected * bits_per_value / BLOCK_BITS))


def expected_rate(n_values: int, n_blocks: int) -> float:
    """False positives to expect: the values of a block are Poisson, its lanes fill independently."""
    mean = n_values / n_blocks
    chance, rate = math.exp(-mean), 0.0
    for j in range(int(mean + 12 * math.sqrt(mean) + 30)):
        rate += chance * (1 - (1 - 1 / (1 << LANE_BITS)) ** j) ** LANES
        chance *= mean / (j + 1)
    return rate


def _block(col: Column, n_blocks: int) -> Column:
    return string_key(col, 0) % n_blocks


def _bits(col: Column) -> list[Column]:
    word = string_key(col, 1)
    spots = [F.shiftright(word, LANE_BITS * i).bitwiseAND(F.lit((1 << LANE_BITS) - 1)) for i in range(LANES)]
    return [F.pow(F.lit(2.0), spot).cast("bigint") for spot in spots]


def blocked_build(df: DataFrame, col: str, n_blocks: int) -> BlockedFilter:
    """The filter of all values of ``col``; nulls are left out, repeats change nothing, no rows give no blocks.

    Tasks fold their rows into blocks before the shuffle, so a hot value is one row per task there.
    """
    value = F.col(col)
    rows = df.where(value.isNotNull()).select(_block(value, n_blocks).alias("block"), *[b.alias(n) for b, n in zip(_bits(value), LANE_NAMES)])
    blocks = rows.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in LANE_NAMES])
    return BlockedFilter(Scratch(df.sparkSession, "blocked").write(blocks, "blocks"), n_blocks)


def blocked_merge(filters: list[BlockedFilter]) -> BlockedFilter:
    """The filter of the values of all: blocks of one number are joined by OR. All must be of one size."""
    sizes = {f.n_blocks for f in filters}
    if len(sizes) != 1:
        raise ValueError(f"filters of different sizes: {sorted(sizes)}")
    rows = filters[0].blocks
    for other in filters[1:]:
        rows = rows.unionByName(other.blocks)
    blocks = rows.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in LANE_NAMES])
    return BlockedFilter(Scratch(rows.sparkSession, "blocked").write(blocks, "merged"), sizes.pop())


def blocked_probe(df: DataFrame, col: str, bloom: BlockedFilter, name: str = "maybe_present") -> DataFrame:
    """All columns and whether the value may be in the filter: one join on the block; null is not in it.

    A filter of proven size is broadcast. A larger one is joined by the planner: it is a written table of
    unique blocks, so a hot value's rows may be split over tasks.
    """
    side = bloom.blocks.select(F.col("block").alias("_bb_block"), *[F.col(n).alias(f"_bb_{n}") for n in LANE_NAMES])
    if bloom.broadcastable:
        side = F.broadcast(side)
    value = F.col(col)
    found = F.lit(True)
    for bit, lane in zip(_bits(value), LANE_NAMES):
        found = found & (F.col(f"_bb_{lane}").bitwiseAND(bit) != 0)
    joined = df.join(side, _block(value, bloom.n_blocks) == F.col("_bb_block"), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(found, F.lit(False)).alias(name))
