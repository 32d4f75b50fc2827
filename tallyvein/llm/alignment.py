"""Alignment of two tokenizers over the bytes of a corpus.

Both tokenizers cover the same bytes, a space and the text. The tokenizers library gives each token of A a
range of characters, sentencepiece gives each piece of B a range of bytes. These ranges are coarse cuts: tokens
that share one character have the same range, byte-fallback pieces have empty ones. Where a range does
not say where its token ends, the token's own decoded bytes do.

Texts are looked at in segments, cut at each single space between two other characters. No token of
either vocabulary goes over such a place (``Aligner`` checks the pieces of B), so the segments' tokens in a
row are the text's. A segment is aligned once per worker, many at a time as arrays, and kept in a bounded
table; a text is then a row of numbers into that table.

Work over the corpus: one pass tokenizes, and writes for each row its numbers and its linked id pairs with
how often it has them. The pairs are added up, task by task and then by a shuffle of counts. A last pass over the
written rows looks the counts up: those of the frequent pairs travel as one array of at most ``FREQUENT``
entries, a row's other pairs leave it as rows and meet their counts in a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvein.session import Scratch

#: Most id pairs whose counts are broadcast: 16 MB.
FREQUENT = 1 << 20
#: A worker's table of segments starts anew when it has so many segments or links.
KEEP, KEEP_LINKS = 800_000, 8_000_000
#: Characters that are split at a time: of many short texts, or of a part of a long one.
STRETCH = 1 << 19
#: An id pair is one number, id of A times this plus id of B.
PAIR = 1 << 20
#: Segments that are encoded together.
TOGETHER = 4_000
_SPAN = attrgetter("id", "begin", "end")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str) -> Iterator[list[str]]:
    """The text's segments in lists of bounded length; joined by spaces they are the text."""
    start = 0
    while len(text) - start > STRETCH:
        cut = _CUT.search(text, start + STRETCH)
        if cut is None:
            break
        yield _CUT.split(text[start : cut.start()])
        start = cut.end()
    yield _CUT.split(text[start:])


def byte_level() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones are themselves, others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Tokenizers A (a byte-level file of the tokenizers library) and B (a sentencepiece model with byte fallback).

    The table of segments: ``index`` numbers them, ``groups`` has their groups as written, each with ``;`` behind
    it, ``sizes`` their tokens of A and of B and their groups, and ``pairs`` their links from ``starts`` on. The arrays
    have room beyond what is in use, so that adding to them does not copy them each time.
    A segment whose tokens' bytes differ from a space and itself has ``sizes`` of -1.
    """

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        level = byte_level()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab(with_added_tokens=False).items():
            if all(c in level for c in piece):
                self.bytes_a[i] = bytes(level[c] for c in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.piece_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("a piece of B has a space after other characters: texts can't be cut at spaces")
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in enumerate(pieces)
        ]
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # A token of A as it is written inside a group and at the end of its side; then those of B.
        self.written = [f"{i}," for i in range(len(self.bytes_a))] + [f"{i}|" for i in range(len(self.bytes_a))]
        self.written += [f"{i}," for i in range(len(pieces))] + [f"{i};" for i in range(len(pieces))]
        self.lengths_written = np.array([len(x) for x in self.written], np.int64)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_pairs = 0
        self.sizes = np.zeros((TOGETHER, 3), np.int64)
        self.starts = np.zeros(TOGETHER + 1, np.int64)
        self.pairs = np.zeros(TOGETHER, np.int64)

    def learn(self, words: Iterable[str]) -> None:
        """Align the segments that are not in the table yet."""
        index = self.index
        new = [word for word in words if word not in index]
        for first in range(0, len(new), TOGETHER):
            self._keep(new[first : first + TOGETHER])

    def _keep(self, words: list[str]) -> None:
        """Add new segments. Those without white space at an edge are encoded as one text, with a space between each two; others, and all where that fails, one by one."""
        plain, edged = [], []
        for word in words:
            (plain if word and word == word.strip() else edged).append(word)
        together = self._align(plain) if plain else None
        parts, order = ([together], plain) if together else ([], [])
        single = edged if together else words
        none = [""], np.full((1, 3), -1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
        parts += [self._align([word]) or none for word in single]
        first, last = len(self.index), len(self.index) + len(words)
        self.index.update(zip([*order, *single], range(first, last)))
        self.groups += chain.from_iterable(part[0] for part in parts)
        links = np.concatenate([part[3] for part in parts])
        self.sizes, self.starts = _room_for(self.sizes, last), _room_for(self.starts, last + 1)
        self.pairs = _room_for(self.pairs, self.n_pairs + len(links))
        self.sizes[first:last] = np.concatenate([part[1] for part in parts])
        self.starts[first + 1 : last + 1] = self.n_pairs + np.cumsum(np.concatenate([part[2] for part in parts]))
        self.pairs[self.n_pairs : self.n_pairs + len(links)] = links
        self.n_pairs += len(links)

    def _align(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray] | None:
        """(groups, sizes, links per segment, links) of segments in a row; None if their tokens' bytes differ from a space before each."""
        text = " ".join(words)
        raw = (" " + text).encode()
        encoding = self.a.encode(" " + text, add_special_tokens=False)
        pieces = np.fromiter(chain.from_iterable(map(_SPAN, self.b.encode(text, return_type="proto").pieces)), np.int64).reshape(-1, 3)
        ids_a, ids_b = encoding.ids, pieces[:, 0].tolist()
        if not b"".join(map(self.bytes_a.__getitem__, ids_a)) == raw == b"".join(map(self.bytes_b.__getitem__, ids_b)):
            return None
        lengths = np.array([1 + len(word) if word.isascii() else 1 + len(word.encode()) for word in words], np.int64)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        flat_a, flat_b = np.array(ids_a, np.int64), pieces[:, 0]
        spans_a = np.fromiter(chain.from_iterable(encoding.offsets), np.int64).reshape(-1, 2)
        spans_b = pieces[:, 1:]
        ends_a = _ends(_byte_places(raw)[spans_a], self.lengths_a[flat_a])
        ends_b = _ends(1 + spans_b, self.lengths_b[flat_b])
        of_a, of_b = (np.searchsorted(bounds, ends, "left") - 1 for ends in (ends_a, ends_b))
        n_a, n_b = (np.bincount(of, minlength=len(words)) for of in (of_a, of_b))
        # Between two neighbouring ends of either side lies exactly one link.
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        pairs = flat_a[at_a] * PAIR + flat_b[at_b]
        counts = np.bincount(of_a[at_a], minlength=len(words))
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.bincount(np.searchsorted(bounds, common) - 1, minlength=len(words))
        # Tokens in order of their groups, those of A first; the last of a side has its own sign behind it.
        in_a, in_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last_a, last_b = common[in_a] == ends_a, common[in_b] == ends_b
        codes_a = flat_a + last_a * len(self.bytes_a)
        codes_b = flat_b + last_b * len(self.bytes_b) + 2 * len(self.bytes_a)
        order = np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")
        codes = np.concatenate([codes_a, codes_b])[order]
        written = "".join(map(self.written.__getitem__, codes.tolist()))
        stops = np.concatenate([[0], np.cumsum(self.lengths_written[codes])])[np.cumsum(n_a + n_b)].tolist()
        groups = [written[start:stop] for start, stop in zip([0, *stops], stops)]
        return groups, np.stack([n_a, n_b, n_groups], axis=1), counts, pairs


def _room_for(rows: np.ndarray, n: int) -> np.ndarray:
    """The array, or a copy with room for ``n`` rows and more."""
    if n <= len(rows):
        return rows
    out = np.zeros((n + n // 2, *rows.shape[1:]), rows.dtype)
    out[: len(rows)] = rows
    return out


def _byte_places(data: bytes) -> np.ndarray:
    """Where each character of UTF-8 starts, and the end."""
    values = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((values & 0xC0) != 0x80), len(values))


def _ends(spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where tokens end, from the byte ranges that a tokenizer gives and the lengths of their decoded bytes.

    A range is a clear cut if it is not empty and the next range is not empty and starts at its end. Other
    tokens end where their decoded bytes do.
    """
    full = spans[:, 1] > spans[:, 0]
    follows = np.ones(len(spans), bool)
    follows[:-1] = full[1:] & (spans[1:, 0] == spans[:-1, 1])
    return np.where(full & follows, spans[:, 1], np.cumsum(lengths))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(file_a: str, file_b: str) -> Aligner:
    """This process's aligner for two files; its table of segments lives as long as the process."""
    if (file_a, file_b) not in _ALIGNERS:
        _ALIGNERS[file_a, file_b] = Aligner(file_a, file_b)
    return _ALIGNERS[file_a, file_b]


class Aligned:
    """What is known of a text after some of its stretches."""

    def __init__(self):
        self.good, self.sizes, self.digest, self.parts = True, np.zeros(3, np.int64), hashlib.sha256(), []
        self.first = True

    def add(self, both: Aligner, words: list[str]) -> None:
        at = np.fromiter(map(both.index.__getitem__, words), np.int64, len(words))
        sizes = both.sizes[at]
        if not self.good or sizes[:, 0].min() < 0:
            self.good = False
            return
        self.sizes += sizes.sum(axis=0)
        text = "".join(map(both.groups.__getitem__, at.tolist()))
        self.digest.update((text[:-1] if self.first else ";" + text[:-1]).encode())
        self.first = False
        starts, counts = both.starts[at], both.starts[at + 1] - both.starts[at]
        # Links of all segments in a row: each segment's start, and on from there.
        steps = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        self.parts.append(both.pairs[np.repeat(starts, counts) + steps])

    def row(self) -> tuple:
        """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, times)."""
        if not self.good or self.first:
            return 0, 0, 0, 0, "", [], []
        links = np.concatenate(self.parts)
        pairs, times = np.unique(links, return_counts=True)
        return (*self.sizes.tolist(), len(links), self.digest.hexdigest(), pairs, times)


def align_texts(both: Aligner, texts: list[str | None]) -> Iterator[Aligned]:
    """Texts in turn; segments of many short ones are learned together."""
    waiting: list[list[list[str]]] = []
    size = 0

    def flush():
        both.learn(set(chain.from_iterable(words for parts in waiting for words in parts)))
        for parts in waiting:
            out = Aligned()
            for words in parts:
                out.add(both, words)
            yield out

    for text in texts:
        if text and "▁" not in text and len(text) > STRETCH:
            yield from flush()
            waiting, size = [], 0
            out = Aligned()
            for words in segments(text):
                both = _room(both)
                both.learn(set(words))
                out.add(both, words)
                if not out.good:
                    break
            yield out
            continue
        waiting.append(list(segments(text)) if text and "▁" not in text else [])
        size += len(text or "")
        if size > STRETCH:
            yield from flush()
            waiting, size = [], 0
            _room(both)
    yield from flush()


def _room(both: Aligner) -> Aligner:
    if len(both.index) > KEEP or both.n_pairs > KEEP_LINKS:
        both.clear()
    return both


def align_text(both: Aligner, text: str | None) -> tuple[str, list[int]]:
    """(groups as they are written, linked id pairs in order) of one text; both empty without tokens."""
    groups, pairs = [], []
    if not text or "▁" in text:
        return "", []
    for words in segments(text):
        both.learn(set(words))
        at = [both.index[word] for word in words]
        if any(both.sizes[i, 0] < 0 for i in at):
            return "", []
        groups += [both.groups[i] for i in at]
        pairs += [pair for i in at for pair in both.pairs[both.starts[i] : both.starts[i + 1]].tolist()]
    return "".join(groups)[:-1], pairs


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_LISTS = ("pairs", "times")


def _tokenize(batches: Iterable[pa.RecordBatch], file_a: str, file_b: str) -> Iterator[pa.RecordBatch]:
    both = aligner(file_a, file_b)
    for batch in batches:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            rows = [x.row() for x in align_texts(_room(both), part.column(1).to_pylist())]
            columns = list(zip(*rows))
            bounds = pa.array([0, *accumulate(len(x) for x in columns[5])], pa.int32())
            lists = [
                pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.asarray(x, kind) for x in column]) if column else [], pa.from_numpy_dtype(kind)))
                for column, kind in ((columns[5], np.int64), (columns[6], np.int32))
            ]
            arrays = [pa.array(column, pa.int64()) for column in columns[:4]]
            yield pa.RecordBatch.from_arrays([part.column(0), *arrays, pa.array(columns[4], pa.string()), *lists], ["id", *_NUMBERS, "groups_sha256", *_LISTS])


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's counts of pairs; a part leaves early if very many pairs have come together."""

    def fold(parts):
        pairs, inverse = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        return [(pairs, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64))]

    parts, size = [], 0
    for batch in batches:
        parts.append((batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy().astype(np.int64)))
        size += len(parts[-1][0])
        if size > 1 << 21:
            parts = fold(parts)
            size = len(parts[0][0])
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, parts[0])), ["pair", "links"])
                parts, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, fold(parts)[0])), ["pair", "links"])


def tokenized(docs: DataFrame, file_a: str, file_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, groups_sha256, and its linked id pairs with how often it has them."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'{n} long' for n in _NUMBERS)}, groups_sha256 string, pairs array<long>, times array<int>"
    return rows.mapInArrow(lambda batches: _tokenize(batches, file_a, file_b), schema)


def link_counts(rows: DataFrame) -> DataFrame:
    """(pair, id_b, links): how many links of the corpus hold each linked pair of ids, from tokenized rows."""
    counted = rows.select(*_LISTS).mapInArrow(_add_up, "pair long, links long")
    return counted.groupBy("pair").agg(F.sum("links").alias("links")).select("pair", (F.col("pair") % PAIR).alias("id_b"), "links")


class _Counts:
    """Counts of the frequent pairs and each B id's highest count, as arrays."""

    def __init__(self, pairs: np.ndarray, links: np.ndarray, best: np.ndarray):
        order = np.argsort(pairs)
        self.pairs, self.links, self.best = pairs[order], links[order], best


def _row_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def _describe(batches: Iterable[pa.RecordBatch], counts: _Counts) -> Iterator[pa.RecordBatch]:
    """n_best and count_sum of the frequent pairs, and a row's other pairs as a list."""
    for batch in batches:
        pairs, times = (batch.column(name).flatten().to_numpy() for name in _LISTS)
        sizes = np.diff(batch.column("pairs").offsets.to_numpy())
        row = np.repeat(np.arange(batch.num_rows), sizes)
        if len(counts.pairs):
            at = np.minimum(np.searchsorted(counts.pairs, pairs), len(counts.pairs) - 1)
            known, links = counts.pairs[at] == pairs, counts.links[at]
        else:
            known, links = np.zeros(len(pairs), bool), np.zeros(len(pairs), np.int64)
        links = np.where(known, links, 0)
        best = counts.best[pairs % PAIR]
        total, n_best = (_row_sums(values, sizes) for values in (links * times, np.where(known & (links == best), times, 0)))
        rare = pa.StructArray.from_arrays(
            [pa.array(pairs[~known]), pa.array(times[~known].astype(np.int64)), pa.array(best[~known])], ["pair", "times", "best"]
        )
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row[~known], minlength=batch.num_rows))]).astype(np.int32)
        kept = [batch.column(name) for name in ("id", *_NUMBERS, "groups_sha256")]
        out = [*kept, pa.array(n_best), pa.array(total), pa.ListArray.from_arrays(pa.array(bounds), rare)]
        yield pa.RecordBatch.from_arrays(out, ["id", *_NUMBERS, "groups_sha256", "n_best", "count_sum", "rare"])


def align_corpus(
    docs: DataFrame, file_a: str, file_b: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A group lies between neighbouring byte offsets where tokens of both end; a link is a pair of tokens
    whose byte ranges overlap. ``n_best`` counts links whose id pair is the most frequent one of its B id over
    the corpus, ties included, ``count_sum`` adds up the corpus counts of all links. ``frequent`` bounds the
    broadcast and has no influence on the result.

    * A null or empty text, and a text for which a tokenizer's bytes differ from a space and the text (with
      U+2581 in it), has no tokens: zeros and an empty digest, and its links count nowhere.
    * A long text is split and aligned in stretches; a stretch without a single space is one segment.
    * Rows are independent: repeated and null ids come back as often as they are there, and equal texts count
      as often as they stand.
    * An empty table gives no rows. Other columns of ``docs`` are not read, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    rows = tokenized(docs, file_a, file_b, id_col, text_col)
    rows.write.option("compression", "zstd").parquet(scratch.path("rows"))
    rows = scratch.read("rows", rows.schema)
    pairs = scratch.write(link_counts(rows), "pairs")
    least = _least_count(pairs, frequent)
    common = pairs.where(F.col("links") >= least).select("pair", "links").toArrow()
    # One row per id of B: bounded by its vocabulary.
    best = pairs.groupBy("id_b").agg(F.max("links").alias("links")).toArrow()
    highest = np.zeros(int(max(best["id_b"].to_pylist(), default=0)) + 1, np.int64)
    highest[best["id_b"].to_numpy()] = best["links"].to_numpy()
    counts = spark.sparkContext.broadcast(_Counts(common["pair"].to_numpy(), common["links"].to_numpy(), highest))

    kept = rows.schema.fields[: len(_NUMBERS) + 2]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    schema += ", n_best long, count_sum long, rare array<struct<pair long, times long, best long>>"
    described = rows.mapInArrow(lambda batches: _describe(batches, counts.value), schema)
    rare = pairs.where(F.col("links") < least).select("pair", "links")
    if not rare.isEmpty():
        described = _with_rare(scratch, described, rare)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return described.select(F.col("id").alias(id_col), *names)


def _least_count(pairs: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` pairs reach."""
    sizes = pairs.groupBy(F.floor(F.log2("links")).cast("int").alias("power")).count().collect()
    power, kept = 64, 0
    for row in sorted(sizes, key=lambda r: -r.power):
        if kept + row["count"] > most:
            break
        power, kept = row.power, kept + row["count"]
    return 1 << min(power, 62)


def _with_rare(scratch: Scratch, described: DataFrame, rare: DataFrame) -> DataFrame:
    """Add what the rare pairs bring to their documents."""
    rows = scratch.write(described.withColumn("row", F.monotonically_increasing_id()), "described")
    single = rows.select("row", F.explode("rare").alias("of")).select("row", "of.pair", "of.times", "of.best")
    met = single.join(rare, "pair")
    own = met.groupBy("row").agg(
        F.sum(F.col("links") * F.col("times")).alias("more"),
        F.sum(F.when(F.col("links") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
    )
    joined = rows.join(own, "row", "left")
    add = {"count_sum": "more", "n_best": "more_best"}
    return joined.withColumns({name: F.col(name) + F.coalesce(F.col(extra), F.lit(0)) for name, extra in add.items()})
