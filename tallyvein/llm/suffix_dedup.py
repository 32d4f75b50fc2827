"""Removal of repeated byte strings by sorting a difference cover of the corpus.

A string of ``LENGTH`` bytes is repeated if it starts anywhere else too, in any text. Comparing all
suffixes is not needed to find them:

1. Sample. A local difference cover: in every run of LENGTH / 2 + 1 starts the ones with the smallest
   hash of their next LENGTH / 2 bytes are sampled. The choice depends on the bytes alone, so equal
   strings have samples at equal offsets, as a difference cover guarantees for any two suffixes, but
   with about one sample in fifty bytes instead of one in eleven for a cover by residues.
2. Sort the samples by their LENGTH / 2 bytes and name them. A unique name ends here.
3. Recurse on the names once, to twice the length on each side: samples of one name are told apart by
   the bytes around them, LENGTH / 2 to the left and to the right. Equal surroundings are repeated
   wherever they stand, one of them goes on for all.
4. Merge the other starts. Where samples of one name have different surroundings, the strings around
   each such sample are sorted together, and equal neighbours are repeated.

Sorting means shuffling by name; nothing is kept per suffix but for the starts of step 4. Names are
64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyvein.llm.words import _POWERS, mix, prefix_hashes, text_slices
from tallyvein.session import Scratch

LENGTH = 200
_SLICE = 1 << 18
_LEFT, _RIGHT = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over values[i : i + width], for each i where that fits."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = pick(out[:-reach], out[reach:])
        reach *= 2
    return pick(out[: len(values) - width + 1], out[width - reach : width - reach + len(values) - width + 1])


class Sampled:
    """The samples of consecutive texts: ``at`` are their places in ``data``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.half, self.length = length // 2, length
        self.running = prefix_hashes(data)
        n, half = len(data), self.half
        self.at = np.zeros(0, np.int64)
        if n < length:
            return
        places = n - half + 1
        names = mix((self.running[half:] - self.running[:places]) * _POWERS.down[:places])
        # Windows of starts, of which none may reach over its text's end.
        least = _sliding(names, half + 1, np.minimum)
        start_of = np.repeat(offsets[:-1], np.diff(offsets))
        end_of = np.repeat(offsets[1:], np.diff(offsets))
        fits = np.arange(len(least)) + length <= end_of[: len(least)]
        self.least = np.where(fits, least, np.uint64(0))
        around = np.concatenate((np.zeros(half, np.uint64), self.least, np.zeros(half, np.uint64)))
        self.names = names
        self.at = np.flatnonzero((_sliding(around, half + 1, np.maximum) == names) & (names > 0))
        self.start, self.end = start_of[self.at], end_of[self.at]

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.running[b] - self.running[a]) * _POWERS.down[a])

    def surroundings(self) -> np.ndarray:
        a, b = np.maximum(self.at - self.half, self.start), np.minimum(self.at + self.length, self.end)
        return mix(self.span(a, b) + (self.at - a).astype(np.uint64) * _LEFT + (b - self.at).astype(np.uint64) * _RIGHT)


def _samples(length: int):
    """(text_id, text) to (name, around, text_id, pos); of equal texts a task passes on the first."""

    def run(batches):
        seen = set()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, data, offsets in text_slices(batch.column(1), _SLICE):
                s = Sampled(data, offsets, length)
                if not len(s.at):
                    continue
                fresh = np.zeros(len(offsets) - 1, bool)
                for t, name in enumerate(ids[first : first + len(fresh)].tolist()):
                    if name not in seen:
                        fresh[t] = True
                        seen.add(name)
                text = np.searchsorted(offsets, s.at, "right") - 1
                take = fresh[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.names[s.at][take].view(np.int64)), pa.array(s.surroundings()[take].view(np.int64)),
                        pa.array(ids[first + text[take]]), pa.array((s.at - s.start)[take], pa.int64()),
                    ],
                    ["name", "around", "text_id", "pos"],
                )

    return run


def _starts(length: int):
    """(text_id, text, places of open samples) to (string, text_id, pos): the starts whose sample is one of them."""

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                wanted = batch.column(2)[i]
                if not wanted.is_valid or not len(wanted.values):
                    continue
                data = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8)
                s = Sampled(data, np.array([0, len(data)]), length)
                found = []
                for p in np.sort(wanted.values.to_numpy()).tolist():
                    i0 = np.arange(max(0, p - s.half), min(p, len(data) - length) + 1)
                    found.append(i0[s.least[i0] == s.names[p]])
                at = np.unique(np.concatenate(found))
                names = s.span(at, at + length).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(np.full(len(at), batch.column(0)[i].as_py(), np.int64)), pa.array(at, pa.int64())], ["string", "text_id", "pos"]
                )

    return run


def _cut(length: int):
    """Texts with their repeated strings and surroundings to what is removed and the digest of what stays."""

    def run(batches):
        for batch in batches:
            out = []
            for name, text, strings, around in zip(*(batch.column(i) for i in range(4))):
                data = text.as_buffer().to_pybytes()
                n, half = len(data), length // 2
                p = around.values.to_numpy() if around.is_valid else np.zeros(0, np.int64)
                q = strings.values.to_numpy() if strings.is_valid else np.zeros(0, np.int64)
                starts = np.concatenate((np.maximum(p - half, 0), q))
                ends = np.concatenate((np.minimum(p + length, n), q + length))
                order = np.argsort(starts, kind="stable")
                spans: list[list[int]] = []
                for a, b in zip(starts[order].tolist(), ends[order].tolist()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((name.as_py(), sum(b - a for a, b in spans), [{"start": a, "end": b} for a, b in spans], digest.hexdigest()))
            names, removed, spans, digests = zip(*out) if out else ((), (), (), ())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(digests, pa.string())],
                ["text_id", "n_removed", "spans", "kept_sha256"],
            )

    return run


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id_col, n_bytes, n_removed, spans, kept_sha256) of every row of ``docs``.

    A byte is removed if a string of ``length`` bytes (an even number) that covers it starts anywhere
    else in the corpus, the same text included. Spans (start, end) are the maximal removed runs in
    bytes, the end exclusive. Every row is a text of its own, so repeated rows of ``length`` bytes or
    more are removed whole. Null texts count as empty, null ids stay null, other columns are not looked
    at, and an empty table gives an empty result.
    """
    if length < 2 or length % 2:
        raise ValueError("the length is an even number of bytes")
    scratch = Scratch(docs.sparkSession, "repeated")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("text_id", F.xxhash64("text"))
    rows = texts.select("id", "text_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"))
    rows = scratch.write(rows, "rows")
    samples = texts.where(F.octet_length("text") >= length).select("text_id", "text")
    samples = samples.mapInArrow(_samples(length), "name long, around long, text_id long, pos long")
    of_name, of_place = Window.partitionBy("name"), Window.partitionBy("name", "around")
    sorted_samples = samples.withColumns({
        "copies": F.count("*").over(of_place), "nth": F.row_number().over(of_place.orderBy("text_id", "pos")),
        "open": F.min("around").over(of_name) < F.max("around").over(of_name),
    })
    repeated = sorted_samples.where("open OR copies > 1").select("text_id", "pos", (F.col("copies") > 1).alias("whole"), (F.col("open") & (F.col("nth") == 1)).alias("goes_on"))
    repeated = scratch.write(repeated.where("whole OR goes_on"), "repeated")
    # Texts that go on, each once: the only ones whose bytes are shuffled again.
    per_text = repeated.groupBy("text_id").agg(
        F.collect_list(F.when(F.col("goes_on"), F.col("pos"))).alias("goes_on"), F.collect_list(F.when(F.col("whole"), F.col("pos"))).alias("around")
    )
    single = texts.where(F.octet_length("text") >= length).select("text_id", "text").dropDuplicates(["text_id"])
    chosen = scratch.write(single.join(per_text, "text_id").select("text_id", "text", "goes_on", "around"), "chosen")
    strings = chosen.select("text_id", "text", "goes_on").mapInArrow(_starts(length), "string long, text_id long, pos long")
    strings = strings.withColumn("n", F.count("*").over(Window.partitionBy("string"))).where("n > 1")
    strings = strings.groupBy("text_id").agg(F.collect_list("pos").alias("strings"))
    cut = chosen.select("text_id", "text", "around").join(strings, "text_id", "left").select("text_id", "text", "strings", "around")
    cut = cut.where("size(strings) > 0 OR size(around) > 0")
    cut = scratch.write(cut.mapInArrow(_cut(length), "text_id long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"), "cut")
    copies = scratch.write(rows.groupBy("text_id").agg(F.count("*").alias("copies")), "copies")
    for name in ("repeated", "chosen"):
        scratch.drop(name)
    joined = rows.join(copies, "text_id").join(cut, "text_id", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    none = F.expr("cast(array() as array<struct<start:long,end:long>>)")
    every = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return joined.select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, every).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )
