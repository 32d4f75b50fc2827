"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where its top bits are zero, with a stricter
mask before the usual chunk length and a looser one after it, so that lengths stay near the usual one.
Boundaries depend on the 32 bytes before them only: an insertion moves text but changes few chunks. The
fingerprint is the set of chunk digests with their lengths; likeness is the share of a text's bytes, in
distinct chunks, that the other text's chunks contain.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvein.llm.words import _POWERS, mix, prefix_hashes, text_slices

LEAST, USUAL, MOST = 32, 96, 384
STRICT_BITS, LOOSE_BITS = 8, 5
_GEAR = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x67656172)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash over the last 32 bytes at each byte, by doubling the window."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each text the ends of its chunks. A hash that looks back over a text's start is not used: chunks have 32 bytes at least."""
    h = gear_hashes(data)
    loose = np.flatnonzero(h >> np.uint32(32 - LOOSE_BITS) == 0)
    strict = loose[h[loose] >> np.uint32(32 - STRICT_BITS) == 0]
    loose_list, strict_list = loose.tolist(), strict.tolist()
    loose_list.append(len(data) + MOST)
    strict_list.append(len(data) + MOST)
    out, a, b = [], 0, 0
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        ends, at = [], start
        while end - at > LEAST:
            first, usual, last = at + LEAST - 1, at + USUAL - 1, min(at + MOST, end) - 1
            while strict_list[a] < first:
                a += 1
            if strict_list[a] < min(usual, last):
                at = strict_list[a] + 1
            else:
                while loose_list[b] < usual:
                    b += 1
                at = min(loose_list[b], last) + 1
            ends.append(at)
        if at < end:
            ends.append(end)
        out.append(ends)
    return out


def fingerprints_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(digests, lengths) of the distinct chunks of each text, by digest."""
    out = []
    for _, data, offsets in text_slices(column):
        running = prefix_hashes(data)
        for start, ends in zip(offsets[:-1].tolist(), chunk_ends(data, offsets)):
            ends = np.array(ends, np.int64)
            starts = np.concatenate(([start], ends[:-1])) if len(ends) else ends
            lengths = ends - starts
            digests = mix((running[ends] - running[starts]) * _POWERS.down[starts] + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if len(ends) else np.zeros(0, np.uint64)
            digests, first = np.unique(digests, return_index=True)
            out.append((digests, lengths[first]))
    return out


def likeness(own: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of the first fingerprint's bytes that the second contains; two empty ones are alike."""
    total = own[1].sum()
    if not total:
        return 1.0 if not len(other[0]) else 0.0
    return float(own[1][np.isin(own[0], other[0])].sum() / total)


def written(print_: tuple[np.ndarray, np.ndarray]) -> str:
    """Digest and length of every distinct chunk in hexadecimal, by digest; empty for an empty text."""
    return "".join(f"{d:016x}{n:03x}" for d, n in zip(print_[0].tolist(), print_[1].tolist()))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint) of every row. Null texts count as empty; equal texts have equal fingerprints."""
    columns = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = columns.dtypes[0][1]

    def run(batches):
        for batch in batches:
            prints = [written(p) for p in fingerprints_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], [id_col, "fingerprint"])

    return columns.mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def _ranges(ids: DataFrame) -> Bucketizer | None:
    """Splits of the ids into about as many ranges as the session has shuffle partitions."""
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(ids.approxQuantile("id", [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    return Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="id_number", outputCol="part") if bounds else None


def _edit(batches):
    """Rows by range and falling id, each range followed by the row that comes next, to the results."""
    waiting: list[tuple] = []  # rows of one id until the next document is met
    key = None
    for batch in batches:
        done = []
        prints = fingerprints_of(batch.column(3))
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)), prints)
        for part, lent, name, text, print_ in rows:
            if name is None:
                done.append((name, text, print_, "", None))
                continue
            if (part, lent, name) != key:
                if key is not None and key[0] == part:
                    done += [(*row, text, print_) for row in waiting]
                    waiting = []
                key = (part, lent, name)
            if not lent:
                waiting.append((name, text, print_))
        edited = [text[: len(text) - len(text) // 3] + following[: len(text) // 3] for _, text, _, following, _ in done]
        new = fingerprints_of(pa.array(edited, pa.large_string()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d[0] for d in done], pa.int64()), pa.array([len(d[1]) for d in done], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([written(d[2]) for d in done], pa.string()), pa.array(map(written, new), pa.string()),
                pa.array([likeness(d[2], n) for d, n in zip(done, new)], pa.float64()),
                pa.array([0.0 if d[4] is None else likeness(d[2], d[4]) for d in done], pa.float64()),
            ],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third the start of the next document replaces.

    The next document has the next smaller id; after the smallest comes the largest. Columns: id_col,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Ids are longs and
    name documents: every row gives a row, and of different texts of one id the first in order is the one
    that others meet as the next document. A row without an id has no next document: nothing replaces its
    last third and near_next is 0. Null texts count as empty. Other columns are not looked at. The
    likeness of two empty texts is 1, of an empty and another one 0.

    The texts are shuffled once, by range of ids, and stream through their tasks in order. Each range ends
    with a copy of the row that the range below begins with, so no task needs another one's rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    split = _ranges(rows.select("id").where("id IS NOT NULL"))

    def placed(df: DataFrame) -> DataFrame:
        if split is None:
            return df.withColumn("part", F.lit(0))
        numbered = df.withColumn("id_number", F.coalesce(F.col("id").cast("double"), F.lit(0.0)))
        return split.transform(numbered).withColumn("part", F.col("part").cast("int")).drop("id_number")

    tops = placed(rows.select("id").where("id IS NOT NULL")).groupBy("part").agg(F.max("id").alias("top")).orderBy("part").collect()  # a row per range
    edges = [(tops[i - 1].top, r.part) for i, r in enumerate(tops)]
    following = F.broadcast(spark.createDataFrame(edges, "id long, part int"))
    order = ["part", "lent", "id", "text"]
    stream = placed(rows).select("part", F.lit(False).alias("lent"), "id", "text").unionByName(
        rows.join(following, "id").select("part", F.lit(True).alias("lent"), "id", "text")
    )
    stream = stream.repartition("part").sortWithinPartitions("part", "lent", F.desc("id"), "text").select(order)
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return stream.mapInArrow(_edit, schema).withColumnRenamed("id", id_col)
