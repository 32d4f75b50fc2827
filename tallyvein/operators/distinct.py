"""Distinct counts from trailing zeros, exact counts, and windows over panes.

A sketch is k small rows per group: for each hash the largest 2**r seen, where r is the number of
trailing zeros of a value's hash. Sketches of any parts of the data merge by max, and repeats change
nothing. The largest r of n values is log2(n) + 0.3327 on average, whatever the hash, so the answer is 2
to the median of group means of r, less that bias. Means of 2**r, the older form, have a heavy tail and
come out several times too high; they remain as ``mean_of="powers"``.

The k hashes of a batch of rows are k vector operations on Arrow data, folded inside the task: only
sketch rows are shuffled. One row per value and hash, or k wide aggregates, measured slower.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyvein.functions.hashing import (
    WORDS_PER_KEY,
    hash_parameters,
    linear_hash,
    string_key,
    trailing_zeros,
)
from tallyvein.functions.text import epoch_seconds

#: Mean of the longest run of trailing zeros over n random values, less log2(n).
RUN_BIAS = 0.3327
#: Bits of a hash: no estimate exceeds 2**(bits - 1) or so.
HASH_BITS = 31


def with_keys(df: DataFrame, col: str) -> DataFrame:
    """Add the integers of a value as _key0, _key1, _key2; missing values leave."""
    keys = {f"_key{i}": string_key(F.col(col), i) for i in range(WORDS_PER_KEY)}
    return df.where(F.col(col).isNotNull()).withColumns(keys)


def _fold_batches(by: list[str], k: int, bits: int, seed: int):
    """A task's part of a sketch: each Arrow batch of keys becomes k rows per group it holds."""
    parameters = hash_parameters(k, seed)
    mask = 2**bits - 1

    def fold(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            if by:
                groups = batch.select(by).to_pandas().groupby(by, sort=False, dropna=False).ngroup().to_numpy()
            else:
                groups = np.zeros(batch.num_rows, dtype=np.int64)
            order = np.argsort(groups, kind="stable")
            starts = np.flatnonzero(np.diff(groups[order], prepend=-1))
            words = [batch.column(f"_key{i}").to_numpy()[order] for i in range(WORDS_PER_KEY)]
            tops = np.empty((len(starts), k), dtype=np.int64)
            for i, (a, b) in enumerate(parameters):
                value = (words[i % WORDS_PER_KEY] * a + b) & mask
                tops[:, i] = np.maximum.reduceat(value & -value, starts)
            rows = np.diff(starts, append=batch.num_rows)
            keys = [batch.column(c).take(pa.array(np.repeat(order[starts], k))) for c in by]
            yield pa.RecordBatch.from_arrays(
                [
                    *keys,
                    pa.array(np.tile(np.arange(k, dtype=np.int32), len(starts))),
                    pa.array(np.repeat(rows, k)),
                    pa.array(tops.reshape(-1)),
                ],
                names=[*by, "hash_no", "n_rows", "top"],
            )

    return fold


def fm_sketch(
    df: DataFrame, col: str, by: list[str] | None = None, k: int = 100, bits: int = HASH_BITS, seed: int = 28
) -> DataFrame:
    """One mergeable sketch per group: (by..., hash_no, n_rows, top), top being the largest 2**r or 0."""
    return sketch_keyed(with_keys(df, col), by, k, bits, seed)


def sketch_keyed(keyed: DataFrame, by: list[str] | None, k: int, bits: int, seed: int) -> DataFrame:
    """The same from rows that carry the keys of ``with_keys``."""
    by = by or []
    rows = keyed.select(*by, *[f"_key{i}" for i in range(WORDS_PER_KEY)])
    kinds = T.StructType([rows.schema[c] for c in by])
    kinds = kinds.add("hash_no", T.IntegerType()).add("n_rows", T.LongType()).add("top", T.LongType())
    return fm_merge(rows.mapInArrow(_fold_batches(by, k, bits, seed), kinds), by)


def hash_rows(keyed: DataFrame, by: list[str], k: int, bits: int, seed: int) -> DataFrame:
    """k rows per row with keys, (by..., hash_no, hash), in built-in expressions only.

    For streams, where a column must keep its watermark up to the aggregate.
    """
    family = F.array(
        *[
            F.struct(
                F.lit(i).alias("no"),
                F.lit(1 + i % WORDS_PER_KEY).alias("word"),
                F.lit(a).cast("bigint").alias("a"),
                F.lit(b).cast("bigint").alias("b"),
            )
            for i, (a, b) in enumerate(hash_parameters(k, seed))
        ]
    )
    words = F.array(*[F.col(f"_key{i}") for i in range(WORDS_PER_KEY)])
    spread = keyed.select(*by, words.alias("_words"), F.explode(family).alias("_h"))
    value = F.element_at("_words", F.col("_h.word")) * F.col("_h.a") + F.col("_h.b")
    hashed = value.bitwiseAND(F.lit(2**bits - 1).cast("bigint"))
    return spread.select(*by, F.col("_h.no").alias("hash_no"), hashed.alias("hash"))


def fm_merge(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    totals = [F.sum("n_rows").alias("n_rows"), F.max("top").alias("top")]
    return sketches.groupBy(*(by or []), "hash_no").agg(*totals)


def median_of_means(value: Column, number: Column, k: int, groups: int = 3) -> Column:
    """An aggregate: means of consecutive groups of k numbered values, then the median of the means.

    Every group but the last has k // groups values; the last takes the rest.
    """
    width = max(1, k // groups)
    group = F.least(F.floor(number / width), F.lit(groups - 1))
    means = F.array_sort(F.array(*[F.avg(F.when(group == g, value)) for g in range(groups)]))
    if groups % 2:
        return F.element_at(means, groups // 2 + 1)
    return (F.element_at(means, groups // 2) + F.element_at(means, groups // 2 + 1)) / 2


def fm_estimate(
    sketches: DataFrame, by: list[str] | None = None, k: int = 100, groups: int = 3, mean_of: str = "zeros"
) -> DataFrame:
    """(by..., n_rows, estimate) from sketch rows; the estimate is a whole number.

    ``mean_of`` is what the groups average: "zeros", the runs of trailing zeros, or "powers", two to
    their power, whose median is the estimate itself, truncated.
    """
    if mean_of not in ("zeros", "powers"):
        raise ValueError("mean_of is zeros or powers")
    power = F.greatest("top", F.lit(1).cast("bigint"))
    if mean_of == "zeros":
        median = median_of_means(F.log2(power), F.col("hash_no"), k, groups)
        estimate = F.round(F.pow(F.lit(2.0), median - F.lit(RUN_BIAS))).cast("bigint")
    else:
        estimate = median_of_means(power, F.col("hash_no"), k, groups).cast("bigint")
    return sketches.groupBy(*(by or [])).agg(F.max("n_rows").alias("n_rows"), estimate.alias("estimate"))


def fm_distinct(
    df: DataFrame, col: str, by: list[str] | None = None, k: int = 100, groups: int = 3, bits: int = HASH_BITS, seed: int = 28,
    mean_of: str = "zeros",
) -> DataFrame:
    """Estimated distinct values per group."""
    return fm_estimate(fm_sketch(df, col, by, k, bits, seed), by, k, groups, mean_of).select(*(by or []), "estimate")


def fm_distinct_checked(
    df: DataFrame, col: str, by: str, k: int = 100, groups: int = 3, bits: int = HASH_BITS, seed: int = 28, limit: float = 0.25
) -> DataFrame:
    """(by, truth, estimate, relative_error, within_limit): the estimate beside the exact count of each group."""
    estimates = fm_distinct(df, col, [by], k, groups, bits, seed)
    truth = df.where(F.col(col).isNotNull()).select(by, col).distinct().groupBy(by).agg(F.count("*").alias("truth"))
    return with_error_gate(truth.join(estimates, by).select(by, "truth", "estimate"), limit)


def max_trailing_zeros(df: DataFrame, col: str, k: int = 100, bits: int = HASH_BITS, seed: int = 28) -> DataFrame:
    """(hash_no, zeros): the longest run of trailing zeros over all values, per hash."""
    return fm_sketch(df, col, None, k, bits, seed).select("hash_no", trailing_zeros(F.col("top")).alias("zeros"))


def approx_distinct(df: DataFrame, col: str, by: list[str] | None = None, deviation: float = 0.02) -> DataFrame:
    """The same question answered by Spark's own sketch."""
    return df.groupBy(*(by or [])).agg(F.approx_count_distinct(col, deviation).alias("estimate"))


def pane_start(ts: Column, slide_seconds: int) -> Column:
    """Epoch second at which the pane of a stamp starts. Stamps are read as UTC clock times."""
    seconds = epoch_seconds(ts)
    return seconds - F.pmod(seconds, F.lit(slide_seconds).cast("bigint"))


def window_starts(pane: Column, window_seconds: int, slide_seconds: int) -> Column:
    """Starts of all windows that cover a pane."""
    return F.sequence(pane - F.lit(window_seconds - slide_seconds), pane, F.lit(slide_seconds).cast("bigint"))


def pane_values(events: DataFrame, ts: str, col: str, slide_seconds: int) -> DataFrame:
    """Distinct (pane, value) pairs with the keys of the values: all that later steps need of the events.

    Keys are made before the shuffle that removes repeats.
    """
    pane = pane_start(F.col(ts), slide_seconds).alias("pane")
    return with_keys(events.select(pane, F.col(col)), col).distinct()


def spread_panes(df: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """Each pane row once per window that covers the pane."""
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a whole number of slides")
    kept = [c for c in df.columns if c != "pane"]
    starts = window_starts(F.col("pane"), window_seconds, slide_seconds)
    return df.select(F.explode(starts).alias("window_start"), *kept)


def window_distinct(events: DataFrame, ts: str, col: str, window_seconds: int, slide_seconds: int) -> DataFrame:
    """Exact distinct values per sliding window."""
    panes = pane_values(events, ts, col, slide_seconds)
    pairs = spread_panes(panes.select("pane", col), window_seconds, slide_seconds).distinct()
    return pairs.groupBy("window_start").agg(F.count("*").alias("truth"))


def with_error_gate(estimates: DataFrame, limit: float = 0.25) -> DataFrame:
    """Add the error relative to the estimate and whether it is within the limit."""
    error = F.abs(F.col("truth") - F.col("estimate")) / F.col("estimate")
    return estimates.withColumn("relative_error", error).withColumn("within_limit", error <= limit)


def fm_distinct_by_window(
    events: DataFrame,
    ts: str,
    col: str,
    window_seconds: int = 30,
    slide_seconds: int = 10,
    k: int = 100,
    groups: int = 3,
    bits: int = HASH_BITS,
    seed: int = 28,
    limit: float = 0.25,
    mean_of: str = "zeros",
    keep_all: bool = True,
) -> DataFrame:
    """Per window: exact count, estimate, relative error and the error gate.

    Values are hashed once per pane; the small pane sketches are merged into the windows. Windows
    outside the error limit are left out unless ``keep_all``.
    """
    panes = sketch_keyed(pane_values(events, ts, col, slide_seconds), ["pane"], k, bits, seed)
    windows = fm_merge(spread_panes(panes, window_seconds, slide_seconds), ["window_start"])
    estimates = fm_estimate(windows, ["window_start"], k, groups, mean_of).drop("n_rows")
    truth = window_distinct(events, ts, col, window_seconds, slide_seconds)
    out = truth.join(estimates, "window_start").select(
        "window_start", (F.col("window_start") + window_seconds).alias("window_end"), "truth", "estimate"
    )
    checked = with_error_gate(out, limit)
    return checked if keep_all else checked.where("within_limit")


def value_zero_runs(df: DataFrame, col: str, bits: int = HASH_BITS, seed: int = 28) -> DataFrame:
    """Trailing zeros of one hash of every distinct value."""
    (a, b), = hash_parameters(1, seed)
    hashed = df.select(col).distinct().withColumn("hash", linear_hash(string_key(F.col(col)), a, b, 2**bits))
    return hashed.withColumn("zeros", trailing_zeros(F.col("hash")))
