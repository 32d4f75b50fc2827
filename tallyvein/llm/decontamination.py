"""Benchmark decontamination by spaced seeds.

A document leaks a benchmark item when ``WINDOW`` consecutive words of the item stand in it with at most
``SUBSTITUTED`` of them replaced; an item of fewer words must stand in it whole. Three fixed masks look
at 7 of 10 or fewer word positions. Their family is lossless: whatever words of a window are replaced,
one mask falls on unchanged words only (a test tries all cases). Masked hashes of documents meet those
of the items, and every hit is verified word by word along its diagonal.

The documents are never shuffled. The items are the smaller side: they go to the tasks in blocks of at
most ``BLOCK_WORDS`` words, one pass over the documents for each block, however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyvein.llm.words import _LOWER, mix, text_slices, window_hashes, word_names, word_spans

WINDOW = 13
SUBSTITUTED = 2
#: Word positions that a mask looks at.
MASKS = ((0, 1, 2, 4, 5, 6, 8), (0, 1, 2, 4, 7, 8, 9), (0, 3, 4, 5, 7, 8, 9))
BLOCK_WORDS = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words are runs of letters and digits: ASCII ones and every character beyond ASCII.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_spans(data, offsets, BETWEEN)
    return word_names(_LOWER[data], starts, ends), np.searchsorted(starts, offsets)


def masked_hashes(words: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    n = max(len(words) - mask[-1], 0)
    out = np.zeros(n, np.uint64)
    for j in mask:
        out *= _STEP
        out += words[j : j + n]
    return mix(out + np.uint64((number + 1) * 0xD6E8FEB86659FD93 % 2**64))


class Index:
    """Seeds of a block of items: sorted hashes with their item and word position."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids = [i for i, _ in items]
        self.words = []
        for _, data, offsets in text_slices(pa.array([t for _, t in items], pa.large_string())):
            words, bounds = _words(data, offsets)
            self.words += [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        self.short = sorted({len(w) for w in self.words if 0 < len(w) < WINDOW})
        hashes, item, at = [], [], []
        for number, words in enumerate(self.words):
            full = len(words) >= WINDOW
            for seeds in self._seeds(words) if full else [window_hashes(words, len(words))] if len(words) else []:
                hashes.append(seeds)
                item.append(np.full(len(seeds), number))
                at.append(np.arange(len(seeds)))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.item, self.at = ((np.concatenate(x) if x else np.zeros(0, int))[order] for x in (item, at))
        self.bits = max(16, math.ceil(math.log2(8 * len(self.hashes) + 1)))
        self.some = np.zeros(1 << self.bits, bool)
        self.some[self.hashes >> np.uint64(64 - self.bits)] = True

    @staticmethod
    def _seeds(words: np.ndarray) -> list[np.ndarray]:
        return [masked_hashes(words, mask, i) for i, mask in enumerate(MASKS)]

    def candidates(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, shift): item word p against word p + shift, wherever a seed is shared."""
        found = set()
        for seeds in [*self._seeds(words), *(window_hashes(words, n) for n in self.short)]:
            hit = np.flatnonzero(self.some[seeds >> np.uint64(64 - self.bits)])
            low = np.searchsorted(self.hashes, seeds[hit], "left")
            high = np.searchsorted(self.hashes, seeds[hit], "right")
            for i, a, b in zip(hit[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                found.update((int(self.item[k]), i - int(self.at[k])) for k in range(a, b))
        return found

    def verify(self, text: np.ndarray, item: int, shift: int) -> list[tuple[int, int, int]]:
        """(first word, words, equal words) of each stretch of ``text`` that windows along the diagonal cover."""
        own = self.words[item]
        width = min(WINDOW, len(own))
        allowed = SUBSTITUTED if len(own) >= WINDOW else 0
        first, last = max(0, -shift), min(len(own), len(text) - shift)
        if last - first < width:
            return []
        same = own[first:last] == text[first + shift : last + shift]
        total = np.concatenate(([0], np.cumsum(same)))
        good = np.flatnonzero(total[width:] - total[:-width] >= width - allowed)
        if not len(good):
            return []
        cut = np.flatnonzero(np.diff(good) > width)
        out = []
        for a, b in zip(good[np.concatenate(([0], cut + 1))].tolist(), good[np.concatenate((cut, [len(good) - 1]))].tolist()):
            inside = np.flatnonzero(same[a : b + width])
            out.append((first + shift + a + int(inside[0]), int(inside[-1] - inside[0]) + 1, len(inside)))
        return out


def _stretches(index: Index, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """(row, item, first word, words, equal words) of a column of texts."""
    rows = set()
    for first, data, offsets in text_slices(column):
        words, bounds = _words(data, offsets)
        # Candidates of a slice at once; they are verified within each text they touch.
        for item, shift in index.candidates(words):
            low, high = np.searchsorted(bounds, [max(shift, 0), shift + len(index.words[item]) - 1], "right") - 1
            for t in range(low, min(high, len(bounds) - 2) + 1):
                text = words[bounds[t] : bounds[t + 1]]
                rows.update((first + t, item, *found) for found in index.verify(text, item, shift - int(bounds[t])))
    return sorted(rows)


def _find(shared: Broadcast, item_kind: pa.DataType):
    def run(batches):
        index = shared.value
        for batch in batches:
            columns = list(zip(*_stretches(index, batch.column(1)))) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(columns[0], pa.int64())),
                    pa.array([index.ids[i] for i in columns[1]], item_kind),
                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                ],
                ["id", "item", "first_word", "n_words", "n_equal"],
            )

    return run


def _clean(shared: Broadcast, at: int):
    def run(batches):
        for batch in batches:
            keep = np.ones(len(batch), bool)
            keep[[row for row, *_ in _stretches(shared.value, batch.column(at))]] = False
            yield batch.filter(pa.array(keep))

    return run


def _indexes(items: DataFrame, item_col: str, item_text_col: str, block_words: int) -> Iterator[Broadcast]:
    """The index of every block of items, sent to the tasks; a block has about ``block_words`` words at most."""
    queries = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    # A word and what ends it take two bytes at least.
    total = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(total / block_words)
    for block in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else queries
        rows = [(r.item, r.text) for r in part.collect()]
        if rows:
            yield items.sparkSession.sparkContext.broadcast(Index(rows))


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(id_col, item_col, first_word, n_words, n_equal): every stretch of a document that repeats an item.

    Words are counted from 0; ``n_equal`` of the ``n_words`` words are the item's. Documents without a
    leak give no row. Null, empty and wordless texts of either side match nothing; a repeated document
    or item gives its rows again, stretches of one row are reported once. Other columns are not looked
    at, so names may clash. Empty tables give an empty result.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    item_kind = items.schema[item_col].dataType
    schema = f"id {texts.schema['id'].dataType.simpleString()}, item {item_kind.simpleString()}, first_word long, n_words long, n_equal long"
    found = docs.sparkSession.createDataFrame([], schema)
    for shared in _indexes(items, item_col, item_text_col, block_words):
        found = found.unionByName(texts.mapInArrow(_find(shared, to_arrow_type(item_kind)), schema))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def without_leaks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs`` that repeat no item, with all their columns; rows are judged alone and nothing is shuffled."""
    at = docs.columns.index(text_col)
    for shared in _indexes(items, item_col, item_text_col, block_words):
        docs = docs.mapInArrow(_clean(shared, at), docs.schema)
    return docs
