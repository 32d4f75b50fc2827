"""Approximate and exact set membership."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvein.functions.hashing import PRIME, hash_parameters, linear_hash, power_of_two, string_key
from tallyvein.session import Scratch

WORD_BITS = 63  # bits kept in one BIGINT, sign bit left alone
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 24  # one (word, bits) row as a generous estimate


@dataclass(frozen=True)
class BloomFilter:
    """The set bits as (word, bits) rows, with the numbers a probe needs."""

    words: DataFrame
    size: int
    parameters: tuple[tuple[int, int], ...]

    @property
    def broadcastable(self) -> bool:
        """The number of words is fixed by the size, so the bound holds for any input."""
        return (self.size // WORD_BITS + 1) * ROW_BYTES <= BROADCAST_BYTES


def filter_size(n_expected: int, k: int) -> int:
    """Bits for n values and k hashes at the best fill: n * k / ln 2."""
    return max(WORD_BITS, math.ceil(n_expected * k / math.log(2)))


def hash_positions(col: Column, size: int, parameters) -> list[Column]:
    return [linear_hash(string_key(col, i), a, b, size, PRIME) for i, (a, b) in enumerate(parameters)]


def hash_rows(df: DataFrame, col: str, size: int, parameters) -> DataFrame:
    """Every row k times, once per hash: (value, hash_no, position)."""
    spots = F.array(*hash_positions(F.col(col), size, parameters))
    return df.select(F.col(col), F.posexplode(spots).alias("hash_no", "position"))


def bloom_build(df: DataFrame, col: str, n_expected: int | None = None, k: int = 5, seed: int = 28) -> BloomFilter:
    """Build a filter of the values of ``col``.

    Setting a bit twice is harmless, so repeats need no distinct: each task folds its rows into words
    before the shuffle, which then carries at most one row per word and task. ``n_expected`` defaults
    to an approximate distinct count.
    """
    if n_expected is None:
        n_expected = df.agg(F.approx_count_distinct(col)).first()[0]
    size = filter_size(max(1, n_expected), k)
    parameters = tuple(hash_parameters(k, seed))
    spot = F.col("position")
    words = (
        hash_rows(df.where(F.col(col).isNotNull()), col, size, parameters)
        .select(
            F.floor(spot / WORD_BITS).alias("word"),
            power_of_two(spot % WORD_BITS).alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    # A filter is built once and probed many times, so it is written like a model.
    return BloomFilter(Scratch(df.sparkSession, "bloom").write(words, "words"), size, parameters)


def bloom_probe(df: DataFrame, col: str, bloom: BloomFilter, name: str = "maybe_present") -> DataFrame:
    """Add whether the value may be in the filter: all k bits set.

    A filter of proven small size is broadcast and looked up k times in one map-only stage. A large
    one is joined on its words, once per distinct value, and the verdicts are joined back.
    """
    spots = hash_positions(F.col(col), bloom.size, bloom.parameters)
    if bloom.broadcastable:
        out, hits = df, []
        for i, spot in enumerate(spots):
            side = F.broadcast(bloom.words.select(F.col("word").alias(f"_w{i}"), F.col("bits").alias(f"_b{i}")))
            out = out.join(side, F.floor(spot / WORD_BITS) == F.col(f"_w{i}"), "left")
            hits.append(F.coalesce(F.col(f"_b{i}").bitwiseAND(power_of_two(spot % WORD_BITS)) != 0, F.lit(False)))
        verdict = hits[0]
        for hit in hits[1:]:
            verdict = verdict & hit
        return out.select(*df.columns, verdict.alias(name))
    return probe_by_word(df, col, bloom, name)


def probe_by_word(df: DataFrame, col: str, bloom: BloomFilter, name: str = "maybe_present") -> DataFrame:
    """The probe for filters of any size."""
    spread = hash_rows(df.select(col).where(F.col(col).isNotNull()).distinct(), col, bloom.size, bloom.parameters)
    spot = F.col("position")
    hits = (
        spread.select(col, F.floor(spot / WORD_BITS).alias("word"), power_of_two(spot % WORD_BITS).alias("bit"))
        .join(bloom.words, "word", "left")
        .groupBy(col)
        .agg(F.bool_and(F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False))).alias(name))
    )
    # Written, so that the join sees real sizes and splits a hot value.
    hits = Scratch(df.sparkSession, "probed").write(hits, "hits")
    return df.join(hits, col, "left").select(*df.columns, F.coalesce(name, F.lit(False)).alias(name))


def is_member(df: DataFrame, members: DataFrame, col: str, name: str = "present") -> DataFrame:
    """Add the exact answer to the same question."""
    known = members.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_known", F.lit(True))
    known = Scratch(df.sparkSession, "members").write(known, "known")
    return df.join(known, col, "left").select(*df.columns, F.coalesce("_known", F.lit(False)).alias(name))


def bloom_report(probed: DataFrame, members: DataFrame, col: str, name: str = "maybe_present") -> DataFrame:
    """One row of quality: probes, true members, passes, false positives and their rate."""
    checked = is_member(probed, members, col)
    false_positive = F.col(name) & ~F.col("present")
    return checked.agg(
        F.count("*").alias("probes"),
        F.count_if("present").alias("members"),
        F.count_if(name).alias("passed"),
        F.count_if(false_positive).alias("false_positives"),
        F.count_if(F.col("present") & ~F.col(name)).alias("false_negatives"),
        F.try_divide(F.count_if(false_positive), F.count_if(~F.col("present"))).alias("false_positive_rate"),
    )
